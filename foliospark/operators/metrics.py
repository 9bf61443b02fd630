"""Totals of calls, and the one-row report of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.operators.pages import is_unusable
from foliospark.operators.records import answer_words
from foliospark.sources.tables import message, once_per


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0.0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def call_group(call_type: Column) -> Column:
    """Synthesis counts as generation, critique of several pages as critique."""
    return F.when(call_type.isin("generation", "synthesis"), "generation").when(call_type.isin("critique", "cross_page_critique"), "critique").otherwise("other")


def call_cost(tokens_in: Column, tokens_out: Column, rate_in: float, rate_out: float) -> Column:
    """Cost by rates per million tokens; null tokens count as none."""
    return F.coalesce(tokens_in, F.lit(0)) / 1e6 * rate_in + F.coalesce(tokens_out, F.lit(0)) / 1e6 * rate_out


def token_stats(calls: DataFrame) -> DataFrame:
    """``call_group, calls, input_tokens, output_tokens, latency_ms`` per group and in total (group ``totals``).

    Repeated rows of a metric_id count once; nulls and latencies under 0 count as 0.
    """
    rows = once_per(calls.select("metric_id", "call_type", "input_tokens", "output_tokens", "latency_ms"), "metric_id")
    grouped = rows.withColumn("call_group", call_group(F.col("call_type"))).rollup("call_group").agg(
        F.count("*").alias("calls"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
        F.coalesce(F.sum(F.greatest("latency_ms", F.lit(0).cast("long"))), F.lit(0)).alias("latency_ms"), F.grouping("call_group").alias("_all"))
    return grouped.select(F.when(F.col("_all") == 1, "totals").otherwise(F.col("call_group")).alias("call_group"), "calls", "input_tokens", "output_tokens", "latency_ms")


def histogram(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))


def as_map(counts: DataFrame, name: str, key: str = "key") -> DataFrame:
    """A histogram (``key``, n) as one row with one map; for report columns, whose keys are few or one per book."""
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(key), F.lit("unknown")).alias("key"), "n")))).alias(name))


def rendered(counts: Column) -> Column:
    """A map as one string, its keys in order."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(counts)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|")


def _named(value: str) -> Column:
    return F.when(F.coalesce(F.col(value), F.lit("")) == "", "unknown").otherwise(F.col(value))


def reason_histogram(decided: DataFrame) -> DataFrame:
    """``key, n`` of reasons; a decision with several reasons counts for each."""
    return histogram(decided.select(F.explode("reasons").alias("reason")), F.col("reason"))


#: Digits that a written report keeps.
DIGITS = {
    "average_answer_length_words": 2, "duplicate_rate": 4, "unusable_page_rate": 4, "api_average_latency_ms": 2, "api_average_input_tokens_per_call": 2, "api_average_output_tokens_per_call": 2,
    "estimated_total_cost_usd": 6, "average_pages_per_evidence_pack": 2, "cross_page_duplicate_rate": 4,
}


def report(pages: DataFrame, candidates: DataFrame, records: DataFrame, packs: DataFrame, across: DataFrame, calls: DataFrame) -> DataFrame:
    """The report of a run as one row of 31 columns (all but the run's id), not rounded; histograms are maps.

    pages: page_status. candidates: accepted, duplicate, reasons of all pairs of pages. records: messages and metadata, those of
    several pages too. packs: n_pages, n_items, n_duplicates. across: reasons of rejected packs and items. calls: call_type, latency_ms,
    input_tokens, output_tokens, estimated_cost_usd. Each is aggregated to one row before the rows are put side by side;
    ratios of nothing are 0. Distributions, yield and answer lengths are those of accepted records of one page.
    """
    seen = pages.agg(F.count("*").alias("total_pages_seen"), F.count_if(is_unusable(F.col("page_status"))).alias("skipped_pages"))
    tried = candidates.agg(
        F.count("*").alias("local_candidates"), F.count_if(F.col("duplicate")).alias("duplicates_filtered"), F.count_if(~F.col("accepted") & ~F.col("duplicate")).alias("quality_rejected"))
    told = records.select("metadata.*", message("assistant").alias("answer"))
    local = told.where("record_level = 'local'")
    made = told.agg(
        F.count_if(F.col("record_level") == "local").alias("local_accepted"), F.count_if(F.col("record_level") == "cross_page").alias("cross_page_accepted"),
        F.coalesce(F.avg(F.when(F.col("record_level") == "local", answer_words(F.col("answer")))), F.lit(0.0)).alias("average_answer_length_words"))
    none = F.lit(0).cast("long")
    wide = packs.agg(
        F.coalesce(F.sum("n_items"), none).alias("cross_page_candidates"), F.coalesce(F.sum("n_duplicates"), none).alias("cross_page_duplicates_filtered"),
        F.coalesce(F.avg("n_pages"), F.lit(0.0)).alias("average_pages_per_evidence_pack"))
    group = call_group(F.col("call_type"))
    total = lambda c, of=None: F.coalesce(F.sum(F.greatest(F.col(c), F.lit(0)) if of is None else F.when(of, F.greatest(F.col(c), F.lit(0)))), F.lit(0))
    called = calls.agg(
        F.count("*").alias("api_calls_total"), F.count_if(group == "generation").alias("api_calls_generation"), F.count_if(group == "critique").alias("api_calls_critique"),
        total("latency_ms").alias("_latency"), total("input_tokens").alias("api_total_input_tokens"), total("output_tokens").alias("api_total_output_tokens"), total("estimated_cost_usd").cast("double").alias("estimated_total_cost_usd"))
    maps = [
        as_map(histogram(local, _named("question_type")), "question_type_distribution"), as_map(histogram(local, _named("difficulty")), "difficulty_distribution"),
        as_map(histogram(local, F.coalesce("source_book", F.lit(""))), "per_book_yield"), as_map(reason_histogram(candidates), "local_rejection_reasons"), as_map(reason_histogram(across), "cross_rejection_reasons"),
        as_map(histogram(told.where("record_level = 'cross_page'"), _named("synthesis_type")), "synthesis_type_distribution"),
    ]
    whole = seen
    for one in (tried, made, wide, called, *maps):  # single rows
        whole = whole.crossJoin(one)
    c = F.col
    return whole.withColumns({
        "total_records": c("local_accepted") + c("cross_page_accepted"), "total_candidate_qas": c("local_candidates"), "duplicate_rate": ratio(c("duplicates_filtered"), c("local_candidates")),
        "unusable_page_rate": ratio(c("skipped_pages"), c("total_pages_seen")), "api_average_latency_ms": ratio(c("_latency"), c("api_calls_total")),
        "api_average_input_tokens_per_call": ratio(c("api_total_input_tokens"), c("api_calls_total")), "api_average_output_tokens_per_call": ratio(c("api_total_output_tokens"), c("api_calls_total")),
        "cross_page_duplicate_rate": ratio(c("cross_page_duplicates_filtered"), c("cross_page_candidates")),
    }).drop("_latency")


def rounded(row: dict) -> dict:
    """A report as it is written: ratios, means and costs rounded from their exact binary values."""
    return {k: round(v, DIGITS[k]) if k in DIGITS and v is not None else v for k, v in row.items()}


def expected_pairs(pages: int, pairs_per_page: int, written: int = 0, candidates: int = 0, prior: float = 0.4) -> int:
    """Pairs to expect of pages at the acceptance rate so far, or the prior."""
    rate = written / candidates if candidates else 0.0
    return int(pages * pairs_per_page * (rate or prior))
