"""Chat records: construction, gates with reasons, and counts of what was accepted and rejected."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import cites, cites_in, has_text, normalize, strip, usefulness, word_count

#: Fixed value: how the tutor is introduced.
TUTOR = "You are a helpful tutor grounded in source material."


@dataclass(frozen=True)
class Limits:
    """Least scores, and whether a citation must stand in the page."""

    grounding: float = 0.55
    usefulness: float = 0.5
    citation: bool = True


def chat_record(question: Column, answer: Column, metadata: dict[str, Column], profile: str = "") -> Column:
    """Struct of messages (system, user, assistant; texts as they are) and metadata."""
    system = TUTOR + (f" Tailor style for this user profile: {profile}" if profile else "")
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.struct(F.array(turn("system", F.lit(system)), turn("user", question), turn("assistant", answer)).alias("messages"), F.struct(*(c.alias(n) for n, c in metadata.items())).alias("metadata"))


def page_pairs(pages: DataFrame) -> DataFrame:
    """One row per accepted pair of a page: the page's keys, text, ``qa_index`` and the pair's fields. What ``gated`` needs of the
    text is worked out once per page: ``_page`` and ``_has_text``."""
    own = ["artifact_id", "run_id", "source_book", "source_page", "page_text", "_page", "_has_text"]
    worked = pages.withColumns({"_page": normalize(F.col("page_text")), "_has_text": has_text(F.col("page_text"))})  # not in the next select, which has a row per pair
    return worked.select(*own, F.posexplode("accepted_qas").alias("qa_index", "qa")).select(*own, "qa_index", "qa.*")


def local_records(pairs: DataFrame, profile: str = "") -> DataFrame:
    """``artifact_id, qa_index, messages, metadata`` of page pairs; missing texts become '', source_pages the page itself."""
    none = F.lit("")
    metadata = {
        "source_book": F.col("source_book"), "source_page": F.col("source_page"), "source_pages": F.array("source_page"),
        "question_type": F.coalesce("question_type", none), "difficulty": F.coalesce("difficulty", none), "citation_quote": F.coalesce("citation_quote", none),
        "evidence_quotes": F.array().cast("array<struct<page:int,quote:string>>"), "synthesis_type": none, "record_level": F.lit("local"), "pack_id": none, "run_id": F.col("run_id"),
    }
    return pairs.select("artifact_id", "qa_index", chat_record(F.col("question"), F.col("answer"), metadata, profile).alias("r")).select("artifact_id", "qa_index", "r.*")


def cross_records(items: DataFrame, profile: str = "") -> DataFrame:
    """``pack_id, item_index, messages, metadata`` of items of several pages; the metadata are those of ``local_records``."""
    none = F.lit("")
    page = F.coalesce(F.try_element_at("source_pages", F.lit(1)), F.try_element_at("pack_pages", F.lit(1)), F.lit(1))
    metadata = {
        "source_book": F.col("source_book"), "source_page": page, "source_pages": F.when(F.size("source_pages") > 0, F.col("source_pages")).otherwise(F.array(page)),
        "question_type": F.coalesce("question_type", none), "difficulty": F.coalesce("difficulty", none), "citation_quote": none,
        "evidence_quotes": F.coalesce("evidence_quotes", F.array().cast("array<struct<page:int,quote:string>>")), "synthesis_type": F.coalesce("synthesis_type", none),
        "record_level": F.lit("cross_page"), "pack_id": F.col("pack_id"), "run_id": F.col("run_id"),
    }
    return items.select("pack_id", "item_index", chat_record(F.col("question"), F.col("answer"), metadata, profile).alias("r")).select("pack_id", "item_index", "r.*")


def _reasons(*tests: tuple[Column, str]) -> Column:
    return F.filter(F.array(*(F.when(test, reason) for test, reason in tests)), lambda r: r.isNotNull())


def gated(pairs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Adds grounding_score, usefulness_score, reasons (in order) and accepted to pairs (question, answer, citation_quote,
    page_text). Grounding starts at 1 and usefulness at the heuristic score; where a verdict column (a struct of grounding_score,
    usefulness_score, grounded, useful, error) is there, scores it has count instead, and a failed call scores 0."""
    judged = "verdict" in pairs.columns
    v = F.col("verdict") if judged else None
    failed = v["error"].isNotNull() if judged else F.lit(False)
    start = usefulness(F.col("question"), F.col("answer"))
    ground = F.when(failed, 0.0).otherwise(F.coalesce(v["grounding_score"], F.lit(1.0))) if judged else F.lit(1.0)
    useful = F.when(failed, 0.0).otherwise(F.coalesce(v["usefulness_score"], start)) if judged else start
    if "_page" in pairs.columns:
        uncited = F.col("_has_text") & ~cites_in(F.col("_page"), F.col("citation_quote"))
    else:
        uncited = has_text(F.col("page_text")) & ~cites(F.col("page_text"), F.col("citation_quote"))
    uncited = uncited if limits.citation else F.lit(False)
    scored = pairs.withColumns({"_uncited": uncited, "grounding_score": F.when(uncited, F.least(ground, F.lit(0.2))).otherwise(ground), "usefulness_score": useful})
    reasons = _reasons(
        (failed, "critique_call_failed"),
        (~failed & ~F.coalesce(v["grounded"], F.lit(True)) if judged else F.lit(False), "model_marked_not_grounded"),
        (~failed & ~F.coalesce(v["useful"], F.lit(True)) if judged else F.lit(False), "model_marked_not_useful"),
        (F.col("_uncited"), "citation_not_found_in_page_text"),
        (F.col("grounding_score") < limits.grounding, "grounding_score_below_threshold"),
        (F.col("usefulness_score") < limits.usefulness, "usefulness_score_below_threshold"),
    )
    return scored.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0).drop("_uncited", "_page", "_has_text")


def cross_gated(items: DataFrame, grounding: float = 0.6, usefulness_least: float = 0.55, multi_page: float = 0.6) -> DataFrame:
    """As ``gated``, for items of several pages with a verdict struct (grounding_score, usefulness_score, multi_page_score,
    grounded, useful, truly_multi_page) and a boolean ``quotes_found``."""
    score = lambda n: F.coalesce(F.col("verdict")[n], F.lit(0.0))
    flag = lambda n: ~F.coalesce(F.col("verdict")[n], F.lit(True))
    reasons = _reasons(
        (flag("grounded"), "model_marked_not_grounded"), (flag("useful"), "model_marked_not_useful"), (flag("truly_multi_page"), "model_marked_not_truly_multi_page"),
        (~F.col("quotes_found"), "evidence_quote_not_found_in_pack_text"), (score("grounding_score") < grounding, "cross_page_grounding_below_threshold"),
        (score("usefulness_score") < usefulness_least, "cross_page_usefulness_below_threshold"), (score("multi_page_score") < multi_page, "multi_page_score_below_threshold"),
    )
    return items.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)


def reason_counts(judged: DataFrame) -> DataFrame:
    """``reason, n``; a pair with several reasons counts for each."""
    return judged.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def answer_words(answer: Column) -> Column:
    """Words of an answer without white space around; a missing one has none."""
    return word_count(strip(answer))
