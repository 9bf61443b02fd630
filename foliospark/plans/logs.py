"""What a run tells about itself: calls, prompts, decisions, skipped pages and events, as rows of one schema each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.operators import pages
from foliospark.operators.metrics import call_cost
from foliospark.plans.config import Settings
from foliospark.plans.providers import QA
from foliospark.plans.stages import with_prompts

MESSAGES = "array<struct<role:string,content:string>>"
METADATA = (
    "struct<source_book:string,source_page:int,source_pages:array<int>,question_type:string,difficulty:string,citation_quote:string,"
    "evidence_quotes:array<struct<page:int,quote:string>>,synthesis_type:string,record_level:string,pack_id:string,run_id:string>"
)
RECORD = f"messages {MESSAGES}, metadata {METADATA}"
ARTIFACT = (
    f"run_id string, source_book string, source_page int, page_status string, page_status_reason string, page_text string, accepted_qas array<{QA}>, "
    "heading_candidate string, first_non_empty_lines array<string>, keywords array<string>, question_type_distribution map<string,bigint>"
)
SKIPPED = "run_id string, source_book string, source_page int, status string, reason string, attempt_dpi int, timestamp_epoch bigint"
CALL = (
    "run_id string, timestamp_epoch bigint, call_type string, source_book string, source_page int, attempt int, model string, latency_ms bigint, "
    "input_tokens bigint, output_tokens bigint, estimated_cost_usd double"
)
PROMPT = "run_id string, timestamp_epoch bigint, source_book string, source_page int, attempt int, dpi int, system_prompt string, user_prompt string"
DECISION = "run_id string, timestamp_epoch bigint, source_book string, source_page int, accepted boolean, reasons array<string>, grounding_score double, usefulness_score double, question string"
CROSS_DECISION = "run_id string, source_book string, pack_id string, question string, accepted boolean, reasons array<string>, grounding_score double, usefulness_score double, multi_page_score double"
EVENT = "value string"
#: What later steps of a run need of its pairs, and of its packs.
CANDIDATE = "signature string, accepted boolean, duplicate boolean, reasons array<string>"
PACK = "run_id string, source_book string, pack_id string, n_pages int, first_page int, status string, n_items bigint, n_duplicates bigint"


def names(ddl: str) -> list[str]:
    """Columns of a schema."""
    out, depth, word = [], 0, ""
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(word.split()[0])
            word = ""
        else:
            word += c
    return [*out, word.split()[0]]


def _now() -> Column:
    return F.unix_timestamp().alias("timestamp_epoch")


def calls(rows: DataFrame, attempts: str, kind: str, page: Column, model: str, rates: tuple[float, float]) -> DataFrame:
    """A row per attempt of rows (run_id, source_book, and attempts in an array): tokens, latency and what it cost."""
    a = F.col("a")
    cost = F.round(call_cost(a["input_tokens"], a["output_tokens"], *rates), 8)
    return rows.select("run_id", "source_book", page.alias("source_page"), F.explode(attempts).alias("a")).select(
        "run_id", a["timestamp_epoch"].alias("timestamp_epoch"), F.lit(kind).alias("call_type"), "source_book", "source_page", a["attempt"].alias("attempt"), F.lit(model).alias("model"),
        a["latency_ms"].alias("latency_ms"), a["input_tokens"].alias("input_tokens"), a["output_tokens"].alias("output_tokens"), cost.alias("estimated_cost_usd"))


def generation_rates(s: Settings) -> tuple[float, float]:
    return s.runtime.generation_input_cost_per_1m_tokens_usd, s.runtime.generation_output_cost_per_1m_tokens_usd


def judge_rates(s: Settings) -> tuple[float, float]:
    return s.runtime.judge_input_cost_per_1m_tokens_usd, s.runtime.judge_output_cost_per_1m_tokens_usd


def page_calls(artifacts: DataFrame, decided: DataFrame, s: Settings) -> DataFrame:
    """Calls for pages and for the critique of their pairs."""
    page = F.col("source_page")
    made = calls(artifacts, "attempts", "generation", page, s.runtime.model, generation_rates(s))
    return made.unionByName(calls(decided, "critique_attempts", "critique", page, s.quality.critique_model, judge_rates(s))) if "critique_attempts" in decided.columns else made


def pack_calls(packs: DataFrame, decided: DataFrame, s: Settings) -> DataFrame:
    """Calls for packs and for the critique of their items; the page is a pack's first."""
    made = calls(packs, "attempts", "synthesis", F.col("first_page"), s.cross_page.synthesis_model, generation_rates(s))
    return made.unionByName(calls(decided, "critique_attempts", "cross_page_critique", F.try_element_at("pack_pages", F.lit(1)), s.cross_page.synthesis_model, judge_rates(s)))


def prompts(artifacts: DataFrame, s: Settings) -> DataFrame:
    """A row per attempt at a page."""
    told = with_prompts(artifacts, s).select("run_id", "source_book", "source_page", "system_prompt", "user_prompt", F.explode("attempts").alias("a"))
    return told.select("run_id", "a.timestamp_epoch", "source_book", "source_page", "a.attempt", "a.dpi", "system_prompt", "user_prompt")


def skipped(artifacts: DataFrame) -> DataFrame:
    """Rows of unusable pages with the resolution of the last attempt."""
    left = artifacts.where(pages.is_unusable(F.col("page_status")))
    return left.select("run_id", "source_book", "source_page", F.col("page_status").alias("status"), F.col("page_status_reason").alias("reason"), F.try_element_at("attempts", F.lit(-1))["dpi"].alias("attempt_dpi"), _now())


def decisions(decided: DataFrame) -> DataFrame:
    return decided.select("run_id", _now(), "source_book", "source_page", "accepted", "reasons", "grounding_score", "usefulness_score", "question")


def cross_decisions(decided: DataFrame) -> DataFrame:
    """Decisions on packs and items; duplicates have none."""
    score = lambda n: F.when(F.col("question").isNotNull(), F.coalesce(F.col("verdict")[n], F.lit(0.0))).alias(n)
    return decided.where("not duplicate").select("run_id", "source_book", "pack_id", "question", "accepted", "reasons", score("grounding_score"), score("usefulness_score"), score("multi_page_score"))


def event(rows: DataFrame, name: str, **payload: Column) -> DataFrame:
    """A line of JSON per row (run_id): time, run, event and what the event tells."""
    told = F.struct(F.unix_timestamp().alias("timestamp_epoch"), "run_id", F.lit(name).alias("event"), *(c.alias(k) for k, c in payload.items()))
    return rows.select(F.to_json(told, {"ignoreNullFields": "false"}).alias("value"))


def page_events(artifacts: DataFrame, decided: DataFrame, made: DataFrame, before: tuple[int, int, int]) -> DataFrame:
    """Events of a step over pages: calls (``made``, rows of CALL), pages skipped and processed, pairs accepted and rejected. The
    counts of a processed page go on from those of the steps before (records, skipped pages, pairs rejected)."""
    rejected = decided.where("not duplicate and not accepted").groupBy("source_book", "source_page").agg(F.count("*").alias("n_rejected"))
    counted = pages.running_counts(artifacts.join(rejected, ["source_book", "source_page"], "left"), n_rejected=F.coalesce("n_rejected", F.lit(0)), page_status=F.col("page_status"))
    so_far = {"records_so_far": F.col("accepted_pairs") + before[0], "skipped_pages_so_far": F.col("skipped_pages") + before[1], "quality_rejected_so_far": F.col("n_rejected") + before[2]}
    where = {"book": F.col("source_book"), "page": F.col("source_page")}
    told = {c: F.col(c) for c in ("latency_ms", "input_tokens", "output_tokens", "estimated_cost_usd")}
    left = pages.is_unusable(F.col("page_status"))
    parts = [
        event(made.where("call_type = 'generation'"), "generation_call_success", **where, attempt=F.col("attempt"), **told), event(made.where("call_type = 'critique'"), "critique_call_success", **where, **told),
        event(artifacts.where(left), "page_skipped", **where, status=F.col("page_status"), reason=F.col("page_status_reason")),
        event(decided.where("duplicate"), "record_rejected_duplicate", **where, question=F.substring("question", 1, 120)),
        event(decided.where("not duplicate and not accepted"), "record_rejected_quality", **where, reasons=F.col("reasons"), grounding_score=F.col("grounding_score"), usefulness_score=F.col("usefulness_score")),
        event(decided.where("accepted"), "record_accepted", **where, question_type=F.coalesce("question_type", F.lit("unknown")), difficulty=F.coalesce("difficulty", F.lit("unknown"))),
        event(counted.where(~left), "page_processed", **where, **so_far),
    ]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole
