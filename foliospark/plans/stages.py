"""The two stages of a run, as plans: pages to artifacts with accepted pairs, and packs of pages to records."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import signature, strip
from foliospark.operators import dedup, packs, pages, records
from foliospark.plans.config import Settings
from foliospark.plans.providers import CROSS_QA, QA, VERDICT, Provider, called
from foliospark.sources.tables import cut

SYNTHESIS = f"struct<pack_status:string,pack_status_reason:string,items:array<{CROSS_QA}>>"
PAYLOAD = f"struct<page_status:string,page_status_reason:string,items:array<{QA}>,_corrupt_record:string>"


def _said(x: object) -> str:
    return json.dumps(x, ensure_ascii=False)


def page_prompt(s: Settings, book: str, page: int) -> dict[str, str]:
    """Prompts for a page as a model gets them."""
    head, tail = _prompt_parts(s)
    return {"system_prompt": s.prompts.system, "user_prompt": f"{head}Book: {book}\nPage: {page}\n{tail}"}


def _prompt_parts(s: Settings) -> tuple[str, str]:
    lines = [f"Reader: {s.dataset.user_profile}", f"Variety: {_said(s.dataset.variety)}", f"Citations: {_said(s.dataset.citation)}",
             "Say first whether the page is usable, blank, unreadable, index_only or image_only; a blank or unreadable page has no pairs."]
    return f"Write {s.dataset.qas_per_page} different question and answer pairs from this page only.\n", "\n".join(lines)


def with_prompts(todo: DataFrame, s: Settings) -> DataFrame:
    """Adds system_prompt and user_prompt to pages; what the settings say is rendered once."""
    head, tail = _prompt_parts(s)
    return todo.withColumns({"system_prompt": F.lit(s.prompts.system), "user_prompt": F.concat(F.lit(f"{head}Book: "), "source_book", F.lit("\nPage: "), F.col("source_page").cast("string"), F.lit(f"\n{tail}"))})


def data_url(image: Column) -> Column:
    """A PNG as a model takes it; null for none."""
    return F.when(F.length(image) > 0, F.concat(F.lit("data:image/png;base64,"), F.regexp_replace(F.base64(image), r"[\r\n]", "")))


def generate(todo: DataFrame, provider: Callable[[], Provider], s: Settings, render: Callable[[dict, int], str] | None = None) -> DataFrame:
    """Artifacts of pages (source_book, source_page, page_text, perhaps path and image): status, items as pairs, and the
    calls' attempts. ``render`` makes the image of a second attempt."""
    told = [F.col("source_book").alias("book"), F.col("source_page").alias("page"), F.col("page_text").alias("text"), F.lit(s.runtime.model).alias("model"), F.lit(s.runtime.temperature).alias("temperature"), "system_prompt", "user_prompt"]
    told += [F.col("path")] if "path" in todo.columns else []
    told += [data_url(F.col("image")).alias("image")] if "image" in todo.columns else []
    kept = [c for c in todo.columns if c != "image"]
    requests = with_prompts(todo, s).withColumn("request", F.to_json(F.struct(*told))).select(*kept, "request")
    answered = cut(called(requests, provider, retries=s.runtime.max_unusable_retries, dpis=(s.runtime.dpi, s.runtime.retry_dpi), pause=s.runtime.sleep_seconds_between_requests, render=render))
    # a payload that isn't such JSON gives a page without a status, and the call an error
    parsed = answered.withColumn("p", F.from_json("payload", PAYLOAD, {"columnNameOfCorruptRecord": "_corrupt_record"}))
    error = F.coalesce("error", F.when(F.col("p._corrupt_record").isNotNull(), "malformed payload"))
    return parsed.select(*kept, F.coalesce("p.page_status", F.lit("unreadable")).alias("page_status"), F.coalesce("p.page_status_reason", F.lit("")).alias("page_status_reason"),
                         F.coalesce("p.items", F.array().cast(f"array<{QA}>")).alias("items"), "attempts", error.alias("error"))


def critiqued(items: DataFrame, provider: Callable[[], Provider], request: Column, s: Settings) -> DataFrame:
    """Adds verdict (scores, flags and error) and critique_attempts to items; one call each."""
    asked = cut(called(items.withColumn("request", request), provider, retries=0, workers=s.runtime.parallel_critique_workers, patience=s.runtime.parallel_future_timeout_seconds)).withColumn("v", F.from_json("payload", VERDICT))
    verdict = F.struct("v.grounding_score", "v.usefulness_score", "v.multi_page_score", "v.grounded", "v.useful", "v.truly_multi_page", "error")
    return asked.withColumn("verdict", verdict).withColumnRenamed("attempts", "critique_attempts").drop("request", "payload", "error", "v")


def _apart(rows: DataFrame, earlier: DataFrame, order: list[str], threshold: float) -> DataFrame:
    """Duplicates among rows (signature, passes, unit) and of what was accepted before: one unit that comes first."""
    before = earlier.select("signature").distinct().select("signature", F.lit(0).alias("level"), F.lit(True).alias("passes"), F.lit("").alias("unit"))
    both = rows.withColumn("level", F.lit(1)).unionByName(before, allowMissingColumns=True)
    return cut(dedup.greedy_duplicates(both, ["level", *order, "signature"], ["unit"], threshold)).where("level = 1").drop("level")


DUPLICATE = "duplicate_or_near_duplicate"


def stage_one(book_pages: DataFrame, done: DataFrame, provider: Callable[[], Provider], s: Settings, run_id: str, earlier: DataFrame | None = None, render: Callable[[dict, int], str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``artifacts`` and ``decisions`` of the pages that aren't done yet.

    book_pages: source_book, source_page, page_text; done: source_book, source_page; earlier: signature of pairs accepted
    before. Pages beyond the cap and done ones are left out before any call. A decision per generated pair: duplicate, accepted,
    reasons, scores; with use_model_self_critique each pair is judged by a call first, duplicates too.
    """
    todo = pages.not_done(pages.capped(book_pages, s.runtime.max_pages_per_book), done).withColumn("run_id", F.lit(run_id))
    made = cut(generate(todo, provider, s, render))
    pairs = made.where(~pages.is_unusable(F.col("page_status"))).select("run_id", "source_book", "source_page", "page_text", F.posexplode("items").alias("qa_index", "qa")).select(
        "run_id", "source_book", "source_page", "page_text", "qa_index", "qa.*")
    if s.quality.enabled and s.quality.use_model_self_critique:
        item = F.struct("question", "answer", "question_type", "difficulty", "citation_quote")
        pairs = critiqued(pairs, provider, F.to_json(F.struct(F.lit("critique").alias("kind"), F.lit(s.quality.critique_model).alias("model"), F.col("page_text").alias("text"), item.alias("item"))), s)
    limits = records.Limits(s.quality.min_grounding_score, s.quality.min_usefulness_score, s.quality.enabled and s.quality.require_citation_match_if_text_available)
    judged = records.gated(pairs, limits).withColumns({"passes": F.col("accepted"), "signature": signature(F.col("question"), F.col("answer")), "unit": F.concat_ws("#", "source_book", "source_page")})
    earlier = judged.sparkSession.createDataFrame([], "signature string") if earlier is None else earlier
    decided = _apart(judged, earlier, ["source_book", "source_page", "qa_index"], s.quality.duplicate_similarity_threshold)
    nil = lambda c: F.when(F.col("duplicate"), 0.0).otherwise(F.col(c))
    decided = decided.withColumns({"reasons": F.when(F.col("duplicate"), F.array(F.lit(DUPLICATE))).otherwise(F.col("reasons")), "accepted": F.col("kept"), "grounding_score": nil("grounding_score"), "usefulness_score": nil("usefulness_score")}).drop("passes", "unit")
    kept = decided.where("kept").groupBy("source_book", "source_page").agg(
        F.array_sort(F.collect_list(F.struct("qa_index", F.struct("question", "answer", "question_type", "difficulty", "citation_quote").alias("qa")))).alias("k"))
    accepted = kept.select("source_book", "source_page", F.transform("k", lambda x: x["qa"]).alias("accepted_qas"))
    artifacts = pages.page_artifacts(made.drop("items").join(accepted, ["source_book", "source_page"], "left").withColumn("accepted_qas", F.coalesce("accepted_qas", F.array().cast(f"array<{QA}>"))))
    return artifacts, decided


def stage_two(artifacts: DataFrame, done_packs: DataFrame, s: Settings) -> DataFrame:
    """Packs that aren't done yet, with the request for each."""
    made = packs.evidence_packs(artifacts, s.cross_page.min_pages_per_pack, s.cross_page.max_pages_per_pack, s.cross_page.pack_overlap_window)
    todo = pages.not_done(made, done_packs, ("pack_id",))
    hints = F.slice("accepted_local_qas", 1, 8) if s.cross_page.use_local_qas_as_hints else F.slice("accepted_local_qas", 1, 0)
    texts = F.transform("page_texts", lambda p: F.struct(p["page"].alias("page"), F.substring(p["text"], 1, 4000).alias("text")))
    return todo.withColumn("request", F.to_json(F.struct(F.lit("synthesis").alias("kind"), F.lit(s.cross_page.synthesis_model).alias("model"), F.lit(s.cross_page.synthesis_temperature).alias("temperature"), F.lit(s.cross_page.max_cross_page_qas_per_pack).alias("most_items"), F.lit(s.cross_page.max_evidence_quotes_per_item).alias("most_quotes"), "pack_id", "source_pages", "shared_terms", "heading_candidates", texts.alias("page_texts"), hints.alias("hints"))))


def stage_two_records(artifacts: DataFrame, done_packs: DataFrame, earlier: DataFrame, provider: Callable[[], Provider], s: Settings, run_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``records`` across pages, ``decisions``, and ``packs`` with what became of them, of the packs that aren't done yet.

    earlier: signature of pairs across pages accepted before. A pack that isn't usable has one decision without a question. An
    item that repeats an accepted pair of a page, an earlier one or an item before it is a duplicate; others are gated by quotes and
    a critique.
    """
    c = s.cross_page
    packed = cut(stage_two(artifacts, done_packs, s)).select("source_book", "pack_id", F.col("source_pages").alias("pack_pages"), "page_texts", "request")
    made = cut(called(packed.select("pack_id", "request"), provider, retries=0)).withColumn("p", F.from_json("payload", SYNTHESIS))
    status = F.when(F.col("error").isNotNull(), "call_failed").otherwise(F.coalesce("p.pack_status", F.lit("insufficient_evidence")))
    answered = cut(packed.drop("request").join(made.select("pack_id", status.alias("status"), F.col("p.pack_status_reason").alias("why"), "p.items", "attempts"), "pack_id").withColumn("run_id", F.lit(run_id)))
    keys = ["run_id", "source_book", "pack_id", "pack_pages"]
    why = F.when(F.coalesce("why", F.lit("")) != "", F.col("why")).otherwise(F.concat(F.lit("pack_status_"), F.col("status")))
    refused = answered.where("status != 'usable'").select(*keys, F.array(why).alias("reasons"), F.lit(False).alias("accepted"), F.lit(False).alias("duplicate"))
    items = answered.where("status = 'usable'").select(*keys, "page_texts", F.posexplode("items").alias("item_index", "i")).select(*keys, "page_texts", "item_index", "i.*")
    items = items.withColumns({"question": F.coalesce(strip(F.col("question")), F.lit("")), "answer": F.coalesce(strip(F.col("answer")), F.lit(""))})
    told = F.struct("question", "answer", "question_type", "difficulty", "source_pages", "evidence_quotes", "synthesis_type")
    texts = F.transform("page_texts", lambda p: F.struct(p["page"].alias("page"), F.substring(p["text"], 1, 2000).alias("text")))
    request = F.to_json(F.struct(F.lit("critique").alias("kind"), F.lit(c.synthesis_model).alias("model"), texts.alias("page_texts"), told.alias("item")))
    judged = critiqued(items.select("pack_id", "item_index", request.alias("r")), provider, F.col("r"), s).drop("r")
    found = packs.quotes_match(F.col("evidence_quotes"), F.col("page_texts")) if c.require_quote_match_if_text_available else F.lit(True)
    gated = records.cross_gated(items.join(judged, ["pack_id", "item_index"]).withColumn("quotes_found", found).drop("page_texts"), c.min_cross_page_grounding_score, c.min_cross_page_usefulness_score, c.min_multi_page_score)
    fresh = gated.withColumns({"passes": F.col("accepted"), "signature": signature(F.col("question"), F.col("answer")), "unit": F.concat_ws("#", "pack_id", "item_index")})
    local = artifacts.select(F.explode("accepted_qas").alias("qa")).select(signature(F.col("qa.question"), F.col("qa.answer")).alias("signature"))
    decided = _apart(fresh, local.unionByName(earlier.select("signature")), ["source_book", "pack_pages", "item_index"], s.quality.duplicate_similarity_threshold)
    decided = decided.withColumn("reasons", F.when(F.col("duplicate"), F.array(F.lit(DUPLICATE))).otherwise(F.col("reasons"))).withColumn("accepted", F.col("kept")).drop("passes", "unit")
    whole = cut(decided.unionByName(refused, allowMissingColumns=True))
    counts = whole.groupBy("pack_id").agg(F.count("item_index").alias("n_items"), F.count_if("duplicate").alias("n_duplicates"))
    done = answered.select("run_id", "source_book", "pack_id", "pack_pages", "status", "attempts").join(counts, "pack_id", "left").select(
        "run_id", "source_book", "pack_id", F.size("pack_pages").alias("n_pages"), F.try_element_at("pack_pages", F.lit(1)).alias("first_page"), "status", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_duplicates", F.lit(0)).alias("n_duplicates"), "attempts")
    return records.cross_records(whole.where("kept"), s.dataset.user_profile), whole, done


def sinks(local: DataFrame, across: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """What goes to the final dataset and to the one across pages: (messages, metadata)."""
    local, across = local.select("messages", "metadata"), across.select("messages", "metadata")
    return (local.unionByName(across) if s.cross_page.merge_into_final_dataset else local), across
