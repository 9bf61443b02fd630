"""Queries of the core library over a directory of tables, and the SQL that they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.text import STOPWORDS, cites, first_lines, has_text, heading, normalize, signature, strip, usefulness, word_count
from foliospark.operators import dedup, metrics, packs, pages, records
from foliospark.plans.config import Runtime
from foliospark.sources.tables import message, once_per, spread, table


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Page artifacts, each once."""
    return once_per(table(spark, d, "page_artifacts"), "artifact_id")


def _per_page(spark: SparkSession, d: str, *columns: Column | str) -> DataFrame:
    """Columns worked out for each page, each page once. Repeated rows have the same content, so they are worked out before they are
    shuffled, and no page text is."""
    return once_per(table(spark, d, "page_artifacts").select("artifact_id", *columns), "artifact_id")


def _per_pair(spark: SparkSession, d: str, columns: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """As ``_per_page``, for the pairs of pages."""
    return once_per(columns(records.page_pairs(spread(table(spark, d, "page_artifacts")))), "artifact_id", "qa_index")


def _chats(spark: SparkSession, d: str) -> DataFrame:
    return once_per(table(spark, d, "chatml_dataset"), "record_id")


def _per_chat(spark: SparkSession, d: str, *columns: Column | str) -> DataFrame:
    """As ``_per_page``, for chat records."""
    return once_per(table(spark, d, "chatml_dataset").select("record_id", *columns), "record_id")


def page_keywords(spark: SparkSession, d: str) -> DataFrame:
    # repeated rows have the same keywords, so only those are shuffled
    made = pages.page_artifacts(spread(table(spark, d, "page_artifacts").select("artifact_id", "page_text", "accepted_qas")))
    return once_per(made.select("artifact_id", F.array_join("keywords", "|").alias("keywords")), "artifact_id")


def page_headings(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce("page_text", F.lit(""))
    made = table(spark, d, "page_artifacts").select("artifact_id", heading(text).alias("heading"), F.array_join(first_lines(text), "|").alias("first_lines"))
    return once_per(made, "artifact_id")


def page_question_types(spark: SparkSession, d: str) -> DataFrame:
    made = table(spark, d, "page_artifacts").select("artifact_id", F.explode(pages.question_types(F.col("accepted_qas"))).alias("question_type", "n"))
    return once_per(made, "artifact_id", "question_type")


def normalized_pages(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("artifact_id", normalize(F.col("page_text")).alias("text"), F.length(strip(F.col("page_text"))).alias("stripped_length"), word_count(F.col("page_text")).alias("n_words"))


def usefulness_scores(spark: SparkSession, d: str) -> DataFrame:
    scored = _per_pair(spark, d, lambda p: p.select("artifact_id", "qa_index", usefulness(F.col("question"), F.col("answer")).alias("score")))
    return scored.groupBy("score").agg(F.count("*").alias("n"))


def citation_matches(spark: SparkSession, d: str) -> DataFrame:
    return _per_pair(spark, d, lambda p: p.select("artifact_id", "qa_index", cites(F.col("page_text"), F.col("citation_quote")).alias("cited"), has_text(F.col("page_text")).alias("has_text")))


def gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    return records.reason_counts(_per_pair(spark, d, lambda p: records.gated(p).select("artifact_id", "qa_index", "reasons")))


def gate_decisions(spark: SparkSession, d: str) -> DataFrame:
    return _per_pair(spark, d, _decided)


def _decided(pairs: DataFrame) -> DataFrame:
    return records.gated(pairs).select("artifact_id", "qa_index", "accepted", F.array_join("reasons", "|").alias("reasons"), "grounding_score", "usefulness_score")


def critique_gate(spark: SparkSession, d: str) -> DataFrame:
    """The gate with verdicts: made ones, some without scores or flags and some of failed calls."""

    def judged(pairs: DataFrame) -> DataFrame:
        a, q = F.col("artifact_id"), F.col("qa_index")
        tenth = lambda x, m: F.when(x % m < m - 1, (x % m) / F.lit(10.0))
        flag = lambda x, m: F.when(x % m < m - 1, x % m > 0)
        verdict = F.struct(tenth(a * 7 + q * 3, 12).alias("grounding_score"), tenth(a * 5 + q, 12).alias("usefulness_score"), flag(a + q, 9).alias("grounded"), flag(a + q * 2, 8).alias("useful"),
                           F.when(a % 13 == 0, F.lit("timeout")).alias("error"))
        return _decided(pairs.withColumn("verdict", verdict))

    return _per_pair(spark, d, judged)


def cross_gate(spark: SparkSession, d: str) -> DataFrame:
    """The gate of records of several pages, with made verdicts and the quotes as they are."""
    r = F.col("record_id")
    tenth = lambda x, m: F.when(x % m < m - 1, (x % m) / F.lit(10.0))
    flag = lambda x, m: F.when(x % m < m - 1, x % m > 0)
    verdict = F.struct(tenth(r, 12).alias("grounding_score"), tenth(r * 5, 12).alias("usefulness_score"), tenth(r * 7, 12).alias("multi_page_score"), flag(r, 9).alias("grounded"), flag(r, 8).alias("useful"), flag(r, 7).alias("truly_multi_page"))
    items = pack_quotes(spark, d).withColumnRenamed("found", "quotes_found").withColumn("verdict", verdict)
    return records.cross_gated(items).select("record_id", "accepted", F.array_join("reasons", "|").alias("reasons"))


def chat_records(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: pairs of pages that pass the gate, as chat records, flattened."""
    made = records.local_records(records.gated(records.page_pairs(spread(table(spark, d, "page_artifacts")))).where("accepted"))
    made = once_per(made, "artifact_id", "qa_index")
    turn = lambda k: F.element_at("messages", k)["content"]
    return made.select("artifact_id", "qa_index", turn(1).alias("system"), turn(2).alias("question"), turn(3).alias("answer"), "metadata.source_book", "metadata.source_page",
                       F.array_join(F.col("metadata.source_pages").cast("array<string>"), "-").alias("source_pages"), "metadata.question_type", "metadata.difficulty", "metadata.citation_quote", "metadata.record_level", "metadata.run_id")


def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    chats = _per_chat(spark, d, signature(message("user"), message("assistant")).alias("signature"))
    return dedup.exact_duplicates(chats, ["record_id"]).select("record_id", "duplicate")


def near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    judged = _per_pair(spark, d, lambda p: records.gated(p).select(
        "artifact_id", "source_book", "source_page", "qa_index", signature(F.col("question"), F.col("answer")).alias("signature"), F.col("accepted").alias("passes")))
    done = dedup.greedy_duplicates(judged, ["source_book", "source_page", "artifact_id", "qa_index"], ["source_book", "source_page"])
    return done.select("artifact_id", "qa_index", "passes", "duplicate", "kept")


def _one_run(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Pages of each book with all runs as one: the last reading of a page counts. Readings are ranked by their keys alone, and
    ``columns`` (or all) joined after."""
    rows = table(spark, d, "page_artifacts")
    rows = rows.select("artifact_id", "run_id", "source_book", "source_page", *columns) if columns else rows
    keys = once_per(rows.select("artifact_id", "run_id", "source_book", "source_page"), "artifact_id")
    last = pages.last_attempts(keys, ["source_book", "source_page"], "run_id", "artifact_id").select("artifact_id")
    return once_per(rows.join(last, "artifact_id", "left_semi"), "artifact_id")


def latest_pages(spark: SparkSession, d: str) -> DataFrame:
    return _one_run(spark, d, "page_status").select("source_book", "source_page", "artifact_id", "run_id", "page_status")


def evidence_packs(spark: SparkSession, d: str) -> DataFrame:
    made = packs.evidence_packs(_one_run(spark, d))
    return made.select("pack_id", "source_book", F.array_join(F.col("source_pages").cast("array<string>"), "-").alias("source_pages"), "pack_strategy", F.array_join("shared_terms", "|").alias("shared_terms"),
                       F.size("accepted_local_qas").alias("n_pairs"), F.array_join("evidence_snippets", "|").alias("snippets"), F.array_join("heading_candidates", "|").alias("headings"))


def pack_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Whether the quotes of each cross-page record stand in the pages they name."""
    wide = _chats(spark, d).where("metadata.record_level != 'local'").select("record_id", F.substring_index("metadata.pack_id", "::", 1).alias("source_book"), F.col("metadata.evidence_quotes").alias("quotes"))
    asked = wide.select("record_id", "source_book", F.explode_outer("quotes").alias("q")).select("record_id", "source_book", F.col("q.page").alias("source_page"), "q")
    texts = _one_run(spark, d, "page_text").select("source_book", "source_page", "page_text")
    paired = asked.join(texts, ["source_book", "source_page"], "left").groupBy("record_id").agg(
        F.collect_list("q").alias("quotes"), F.collect_list(F.when(F.col("page_text").isNotNull(), F.struct(F.col("source_page").alias("page"), F.col("page_text").alias("text")))).alias("texts"))
    return paired.select("record_id", packs.quotes_match(F.col("quotes"), F.col("texts")).alias("found"))


def skipped_pages(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "page_artifacts").select("artifact_id", "run_id", "source_book", "source_page", "page_status", "page_status_reason")
    return pages.skipped(once_per(left, "artifact_id"))


def skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "skipped_pages").dropDuplicates().groupBy("status", F.when(strip(F.col("reason")) == "", "unknown").otherwise(F.coalesce("reason", F.lit("unknown"))).alias("reason")).agg(F.count("*").alias("n"))


def resume_pages(spark: SparkSession, d: str) -> DataFrame:
    """Usable pages from which no local record was written yet."""
    todo = table(spark, d, "page_artifacts").where("page_status = 'usable'").select("source_book", "source_page").distinct()
    done = table(spark, d, "chatml_dataset").where("metadata.record_level = 'local'").select("metadata.source_book", "metadata.source_page")
    return pages.not_done(todo, done)


def capped_pages(spark: SparkSession, d: str) -> DataFrame:
    return pages.capped(_per_page(spark, d, "source_book", "source_page"), 10).groupBy("source_book").agg(F.count("*").alias("n_pages"), F.max("source_page").alias("last_page"))


def running_counts(spark: SparkSession, d: str) -> DataFrame:
    return pages.running_counts(_per_page(spark, d, "run_id", "source_book", "source_page", "page_status", "accepted_qas"))


def token_stats(spark: SparkSession, d: str) -> DataFrame:
    return metrics.token_stats(table(spark, d, "api_metrics"))


def call_costs(spark: SparkSession, d: str) -> DataFrame:
    """Calls and what they cost at the default rates, per kind of call."""
    r = Runtime(model="")
    rows = once_per(table(spark, d, "api_metrics").select("metric_id", "call_type", "input_tokens", "output_tokens"), "metric_id")
    made = metrics.call_cost(F.col("input_tokens"), F.col("output_tokens"), r.generation_input_cost_per_1m_tokens_usd, r.generation_output_cost_per_1m_tokens_usd)
    judged = metrics.call_cost(F.col("input_tokens"), F.col("output_tokens"), r.judge_input_cost_per_1m_tokens_usd, r.judge_output_cost_per_1m_tokens_usd)
    cost = F.when(metrics.call_group(F.col("call_type")) == "critique", judged).otherwise(made)
    return rows.groupBy("call_type").agg(F.count("*").alias("calls"), F.round(F.sum(cost), 6).alias("usd"))


def last_calls(spark: SparkSession, d: str) -> DataFrame:
    """The last attempt of each generation call."""
    calls = once_per(table(spark, d, "api_metrics"), "metric_id").where("call_type = 'generation'")
    return pages.last_attempts(calls, ["run_id", "source_book", "source_page"], "attempt", "timestamp_epoch", "metric_id").select("run_id", "source_book", "source_page", "attempt", "metric_id")


def book_yield(spark: SparkSession, d: str) -> DataFrame:
    return _per_chat(spark, d, "metadata").where("metadata.record_level = 'local'").groupBy(F.coalesce("metadata.source_book", F.lit("")).alias("source_book")).agg(F.count("*").alias("n"))


def distributions(spark: SparkSession, d: str) -> DataFrame:
    """Histograms of question type, difficulty, synthesis type and level, one below the other."""
    one = _per_chat(spark, d, "metadata")
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.coalesce(F.col(f"metadata.{k}"), F.lit("unknown")).alias("value")) for k in ("question_type", "difficulty", "synthesis_type", "record_level"))))
    return one.select(kinds.alias("k")).groupBy("k.kind", "k.value").agg(F.count("*").alias("n"))


def all_records(spark: SparkSession, d: str) -> DataFrame:
    """Local and cross-page records as one set."""
    one = _per_chat(spark, d, F.col("metadata.record_level").alias("level"), F.col("metadata.run_id").alias("run_id"))
    both = one.where("level = 'local'").unionByName(one.where("level != 'local'"))
    return both.groupBy("level", "run_id").agg(F.count("*").alias("n"))


def run_report(spark: SparkSession, d: str) -> DataFrame:
    """The report over all runs as one: pages and their pairs as gated, records, packs with the records made of them, and calls at
    the default rates. Means and ratios are rounded, histograms are written out."""
    pairs = _per_pair(spark, d, lambda p: records.gated(p).select("artifact_id", "qa_index", "accepted", "reasons", F.lit(False).alias("duplicate")))
    chats = _chats(spark, d)
    sizes = packs.pack_sizes(_one_run(spark, d, "page_status", "accepted_qas"))
    items = _per_chat(spark, d, F.col("metadata.pack_id").alias("pack_id")).where("pack_id != ''").groupBy("pack_id").agg(F.count("*").alias("n_items"))
    made = sizes.join(items, "pack_id", "left").select("n_pages", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.lit(0).cast("long").alias("n_duplicates"))
    across = pack_quotes(spark, d).select(F.when(F.col("found"), F.array().cast("array<string>")).otherwise(F.array(F.lit("evidence_quote_not_found_in_pack_text"))).alias("reasons"))
    r = Runtime(model="")
    calls = once_per(table(spark, d, "api_metrics").select("metric_id", "call_type", "latency_ms", "input_tokens", "output_tokens"), "metric_id").withColumn(
        "estimated_cost_usd", metrics.call_cost(F.col("input_tokens"), F.col("output_tokens"), r.generation_input_cost_per_1m_tokens_usd, r.generation_output_cost_per_1m_tokens_usd))
    whole = metrics.report(_per_page(spark, d, "page_status"), pairs, chats, made, across, calls)
    return whole.select(*(metrics.rendered(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "map" else F.round(f.name, metrics.DIGITS[f.name]).alias(f.name) if f.name in metrics.DIGITS else F.col(f.name) for f in whole.schema.fields))


def synthesis_inputs(spark: SparkSession, d: str) -> DataFrame:
    """What a prompt for a pack takes of it: texts and pairs, each cut."""
    made = packs.evidence_packs(_one_run(spark, d))
    cut_texts = F.transform("page_texts", lambda p: F.concat(F.lit("Page "), p["page"].cast("string"), F.lit(":\n"), F.substring(p["text"], 1, 4000)))
    return made.select("pack_id", F.length(F.array_join(cut_texts, "\n\n")).alias("prompt_chars"), F.least(F.size("accepted_local_qas"), F.lit(8)).alias("n_hints"))


_ALL = (
    page_keywords, page_headings, page_question_types, normalized_pages, usefulness_scores, citation_matches, gate_reasons, gate_decisions, critique_gate, cross_gate, chat_records, exact_duplicates, near_duplicates,
    latest_pages, evidence_packs, pack_quotes, skipped_pages, skip_reasons, resume_pages, capped_pages, running_counts, token_stats, call_costs, last_calls, book_yield, distributions,
    all_records, run_report, synthesis_inputs,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


# White space as the text functions see it, in RE2.
_B = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_PAGES = "pages AS (SELECT * FROM page_artifacts QUALIFY row_number() OVER (PARTITION BY artifact_id) = 1)"
_CHATS = "chats AS (SELECT * FROM chatml_dataset QUALIFY row_number() OVER (PARTITION BY record_id) = 1)"
_CALLS = "calls AS (SELECT * FROM api_metrics QUALIFY row_number() OVER (PARTITION BY metric_id) = 1)"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_B}+|{_B}+$', '', 'g')"


def _normalize(x: str) -> str:
    return f"regexp_replace({_strip(f'lower({x})')}, '{_B}+', ' ', 'g')"


def _words(x: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, '[^\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]+')), 0)"


def _say(role: str) -> str:
    return f"(list_filter(messages, lambda m: m.role = '{role}')[1]).content"


_LINES = f"""filled AS (SELECT artifact_id, i, {_strip('line')} AS line FROM (
    SELECT artifact_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT artifact_id, string_split_regex(coalesce(page_text, ''), '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]') AS l FROM pages))
    WHERE {_strip('line')} <> '')"""
_PAIRS = """pairs AS (SELECT artifact_id, run_id, source_book, source_page, page_text, i - 1 AS qa_index, qa.question, qa.answer, qa.question_type, qa.difficulty, qa.citation_quote
    FROM (SELECT *, unnest(accepted_qas) AS qa, generate_subscripts(accepted_qas, 1) AS i FROM pages))"""
_SCORE = f"""CASE WHEN {_words('question')} < 4 OR {_words('answer')} < 8 THEN 0.25::DOUBLE WHEN {_words('question')} < 6 OR {_words('answer')} < 15 THEN 0.5::DOUBLE WHEN {_words('answer')} > 120 THEN 0.7::DOUBLE ELSE 0.85::DOUBLE END"""
_CITED = f"coalesce(length({_normalize('citation_quote')}) >= 8 AND contains({_normalize('page_text')}, {_normalize('citation_quote')}), false)"
_HAS = f"coalesce(length({_strip('page_text')}) > 20, false)"
_GATED = f"""gated AS (SELECT *, CASE WHEN uncited THEN 0.2::DOUBLE ELSE 1.0::DOUBLE END AS grounding_score FROM (
    SELECT *, {_SCORE} AS usefulness_score, {_HAS} AND NOT {_CITED} AS uncited FROM pairs)),
    judged AS (SELECT *, list_filter([CASE WHEN uncited THEN 'citation_not_found_in_page_text' END, CASE WHEN grounding_score < 0.55 THEN 'grounding_score_below_threshold' END,
        CASE WHEN usefulness_score < 0.5 THEN 'usefulness_score_below_threshold' END], lambda r: r IS NOT NULL) AS reasons FROM gated)"""
_LATEST = "latest AS (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY source_book, source_page ORDER BY run_id DESC, artifact_id DESC) = 1)"
_UNUSABLE = "coalesce(page_status, 'unreadable') IN ('blank', 'unreadable')"
_PACKS = f"""fit AS (SELECT *, row_number() OVER (PARTITION BY source_book ORDER BY coalesce(source_page, 0)) - 1 AS i FROM latest WHERE page_status = 'usable' AND len(accepted_qas) > 0),
    placed AS (SELECT fit.*, w FROM fit, LATERAL (SELECT unnest(generate_series(greatest(0, ceil((i - 2) / 2.0)::BIGINT), i // 2)) AS w)),
    packed AS (SELECT source_book, w, list(source_page ORDER BY i) AS pages_, list(coalesce(keywords, []) ORDER BY i) AS keys, list(coalesce(heading_candidate, '') ORDER BY i) AS headings,
        list(coalesce(first_non_empty_lines, [])[1:2] ORDER BY i) AS lines_, list(accepted_qas ORDER BY i) AS qas, list(coalesce(page_text, '') ORDER BY i) AS texts FROM placed GROUP BY source_book, w HAVING count(*) >= 2),
    packs AS (SELECT *, source_book || '::' || array_to_string(pages_, '-') AS pack_id,
        CASE WHEN len(list_filter(keys, lambda k: len(k) > 0)) = 0 THEN []::VARCHAR[] ELSE list_sort(list_reduce(list_filter(keys, lambda k: len(k) > 0), lambda a, b: list_intersect(a, b)))[1:20] END AS shared,
        list_transform(list_filter(headings, lambda h: h <> ''), lambda h: {_normalize('h')}) AS hs FROM packed)"""

_QUOTED = f"""wide AS (SELECT record_id, split_part(metadata.pack_id, '::', 1) AS source_book, metadata.evidence_quotes AS quotes FROM chats WHERE metadata.record_level <> 'local'),
    asked AS (SELECT record_id, source_book, q.page AS source_page, q.quote AS quote FROM (SELECT record_id, source_book, unnest(quotes) AS q FROM wide)),
    told AS (SELECT record_id, bool_and(coalesce({_strip('quote')} <> '' AND contains(lower(page_text), lower({_strip('quote')})), false)) AS found FROM asked LEFT JOIN latest USING (source_book, source_page) GROUP BY 1),
    quoted AS (SELECT record_id, coalesce(found, false) AS found FROM wide LEFT JOIN told USING (record_id))"""


def _histogram(key: str, rows: str) -> str:
    return f"(SELECT coalesce(string_agg(k || '=' || n, '|' ORDER BY k), '') FROM (SELECT {key} AS k, count(*) AS n FROM {rows} GROUP BY 1))"


def oracle_sql() -> dict[str, str]:
    stop = ", ".join(f"'{w}'" for w in STOPWORDS)
    return {
        "page_keywords": f"""WITH {_PAGES}, t AS (SELECT artifact_id, list_filter(regexp_extract_all(lower(coalesce(page_text, '') || chr(10) || coalesce(array_to_string(
                list_transform(accepted_qas, lambda q: coalesce(q.question, '') || ' ' || coalesce(q.answer, '')), ' '), '')), '[a-z]{{3,}}'), lambda w: w NOT IN ({stop})) AS ws FROM pages),
            e AS (SELECT artifact_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM t), c AS (SELECT artifact_id, w, count(*) AS n, min(i) AS p FROM e GROUP BY ALL),
            r AS (SELECT *, row_number() OVER (PARTITION BY artifact_id ORDER BY n DESC, p) AS k FROM c)
            SELECT pages.artifact_id, coalesce(string_agg(w, '|' ORDER BY k), '') AS keywords FROM pages LEFT JOIN r ON r.artifact_id = pages.artifact_id AND k <= 20 GROUP BY pages.artifact_id""",
        "page_headings": f"""WITH {_PAGES}, {_LINES}, h AS (SELECT artifact_id, arg_min(line, i) AS heading FROM filled WHERE length(line) <= 120 GROUP BY 1),
            f AS (SELECT artifact_id, string_agg(substring(line, 1, 200), '|' ORDER BY i) AS first_lines FROM (SELECT *, row_number() OVER (PARTITION BY artifact_id ORDER BY i) AS k FROM filled) WHERE k <= 3 GROUP BY 1)
            SELECT pages.artifact_id, coalesce(heading, '') AS heading, coalesce(first_lines, '') AS first_lines FROM pages LEFT JOIN h USING (artifact_id) LEFT JOIN f USING (artifact_id)""",
        "page_question_types": f"WITH {_PAGES}, {_PAIRS} SELECT artifact_id, coalesce(question_type, 'unknown') AS question_type, count(*) AS n FROM pairs GROUP BY ALL",
        "normalized_pages": f"WITH {_PAGES} SELECT artifact_id, {_normalize('page_text')} AS text, length({_strip('page_text')})::INT AS stripped_length, {_words('page_text')}::INT AS n_words FROM pages",
        "usefulness_scores": f"WITH {_PAGES}, {_PAIRS} SELECT {_SCORE} AS score, count(*) AS n FROM pairs GROUP BY 1",
        "citation_matches": f"WITH {_PAGES}, {_PAIRS} SELECT artifact_id, qa_index::INT AS qa_index, {_CITED} AS cited, {_HAS} AS has_text FROM pairs",
        "gate_reasons": f"WITH {_PAGES}, {_PAIRS}, {_GATED} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM judged) GROUP BY 1",
        "gate_decisions": f"WITH {_PAGES}, {_PAIRS}, {_GATED} SELECT artifact_id, qa_index::INT AS qa_index, len(reasons) = 0 AS accepted, array_to_string(reasons, '|') AS reasons, grounding_score, usefulness_score FROM judged",
        "critique_gate": f"""WITH {_PAGES}, {_PAIRS}, v AS (SELECT *, artifact_id * 7 + qa_index * 3 AS g, artifact_id * 5 + qa_index AS u, artifact_id + qa_index AS gf, artifact_id + qa_index * 2 AS uf, artifact_id % 13 = 0 AS failed,
                {_HAS} AND NOT {_CITED} AS uncited FROM pairs),
            w AS (SELECT *, CASE WHEN failed THEN 0::DOUBLE WHEN g % 12 < 11 THEN (g % 12) / 10.0::DOUBLE ELSE 1::DOUBLE END AS ground, CASE WHEN failed THEN 0::DOUBLE WHEN u % 12 < 11 THEN (u % 12) / 10.0::DOUBLE ELSE {_SCORE} END AS usefulness_score FROM v),
            x AS (SELECT *, CASE WHEN uncited THEN least(ground, 0.2::DOUBLE) ELSE ground END AS grounding_score FROM w),
            y AS (SELECT *, list_filter([CASE WHEN failed THEN 'critique_call_failed' END, CASE WHEN NOT failed AND gf % 9 = 0 THEN 'model_marked_not_grounded' END, CASE WHEN NOT failed AND uf % 8 = 0 THEN 'model_marked_not_useful' END,
                CASE WHEN uncited THEN 'citation_not_found_in_page_text' END, CASE WHEN grounding_score < 0.55 THEN 'grounding_score_below_threshold' END, CASE WHEN usefulness_score < 0.5 THEN 'usefulness_score_below_threshold' END], lambda r: r IS NOT NULL) AS reasons FROM x)
            SELECT artifact_id, qa_index::INT AS qa_index, len(reasons) = 0 AS accepted, array_to_string(reasons, '|') AS reasons, grounding_score, usefulness_score FROM y""",
        "cross_gate": f"""WITH {_PAGES}, {_LATEST}, {_CHATS}, {_QUOTED}, y AS (SELECT record_id, list_filter([CASE WHEN record_id % 9 = 0 THEN 'model_marked_not_grounded' END, CASE WHEN record_id % 8 = 0 THEN 'model_marked_not_useful' END,
                CASE WHEN record_id % 7 = 0 THEN 'model_marked_not_truly_multi_page' END, CASE WHEN NOT found THEN 'evidence_quote_not_found_in_pack_text' END,
                CASE WHEN record_id % 12 < 6 OR record_id % 12 = 11 THEN 'cross_page_grounding_below_threshold' END, CASE WHEN record_id * 5 % 12 < 6 OR record_id * 5 % 12 = 11 THEN 'cross_page_usefulness_below_threshold' END,
                CASE WHEN record_id * 7 % 12 < 6 OR record_id * 7 % 12 = 11 THEN 'multi_page_score_below_threshold' END], lambda r: r IS NOT NULL) AS reasons FROM quoted)
            SELECT record_id, len(reasons) = 0 AS accepted, array_to_string(reasons, '|') AS reasons FROM y""",
        "chat_records": f"""WITH {_PAGES}, {_PAIRS}, {_GATED} SELECT artifact_id, qa_index::INT AS qa_index, '{records.TUTOR}' AS system, question, answer, source_book, source_page, source_page::VARCHAR AS source_pages,
            coalesce(question_type, '') AS question_type, coalesce(difficulty, '') AS difficulty, coalesce(citation_quote, '') AS citation_quote, 'local' AS record_level, run_id FROM judged WHERE len(reasons) = 0""",
        "exact_duplicates": f"""WITH {_CHATS}, s AS (SELECT record_id, {_normalize(f"coalesce({_strip(_say('user'))}, '') || ' || ' || coalesce({_strip(_say('assistant'))}, '')")} AS signature FROM chats)
            SELECT record_id, record_id > min(record_id) OVER (PARTITION BY signature) AS duplicate FROM s""",
        "latest_pages": f"WITH {_PAGES}, {_LATEST} SELECT source_book, source_page, artifact_id, run_id, page_status FROM latest",
        "evidence_packs": f"""WITH {_PAGES}, {_LATEST}, {_PACKS} SELECT pack_id, source_book, array_to_string(pages_, '-') AS source_pages,
            'adjacent_window' || CASE WHEN len(shared) > 0 THEN '+lexical_overlap' ELSE '' END || CASE WHEN len(list_distinct(hs)) < len(hs) THEN '+heading_continuity' ELSE '' END AS pack_strategy,
            array_to_string(shared, '|') AS shared_terms, len(flatten(qas))::INT AS n_pairs, array_to_string(flatten(lines_)[1:8], '|') AS snippets, array_to_string(headings, '|') AS headings FROM packs""",
        "synthesis_inputs": f"""WITH {_PAGES}, {_LATEST}, {_PACKS} SELECT pack_id, (list_sum(list_transform(texts, lambda t: least(length(t), 4000))) + list_sum(list_transform(pages_, lambda p: length(p::VARCHAR) + 7)) + 2 * (len(pages_) - 1))::INT AS prompt_chars,
            least(len(flatten(qas)), 8)::INT AS n_hints FROM packs""",
        "pack_quotes": f"WITH {_PAGES}, {_LATEST}, {_CHATS}, {_QUOTED} SELECT * FROM quoted",
        "skipped_pages": f"WITH {_PAGES} SELECT run_id, source_book, source_page, coalesce(page_status, 'unreadable') AS status, coalesce(page_status_reason, '') AS reason FROM pages WHERE {_UNUSABLE}",
        "skip_reasons": f"SELECT status, CASE WHEN reason IS NULL OR {_strip('reason')} = '' THEN 'unknown' ELSE reason END AS reason, count(*) AS n FROM (SELECT DISTINCT * FROM skipped_pages) GROUP BY ALL",
        "resume_pages": f"""WITH {_PAGES} SELECT DISTINCT source_book, source_page FROM pages WHERE page_status = 'usable' AND NOT EXISTS (
            SELECT 1 FROM chatml_dataset c WHERE c.metadata.record_level = 'local' AND c.metadata.source_book = pages.source_book AND c.metadata.source_page = pages.source_page)""",
        "capped_pages": f"WITH {_PAGES} SELECT source_book, count(*) AS n_pages, max(source_page) AS last_page FROM pages WHERE source_page <= 10 GROUP BY 1",
        "running_counts": f"""WITH {_PAGES} SELECT run_id, source_book, source_page, count(*) OVER w AS pages_seen, count(*) FILTER ({_UNUSABLE}) OVER w AS skipped_pages, (sum(coalesce(len(accepted_qas), 0)) OVER w)::BIGINT AS accepted_pairs
            FROM pages WINDOW w AS (PARTITION BY run_id ORDER BY source_book, source_page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "token_stats": f"""WITH {_CALLS}, g AS (SELECT CASE WHEN call_type IN ('generation', 'synthesis') THEN 'generation' WHEN call_type IN ('critique', 'cross_page_critique') THEN 'critique' ELSE 'other' END AS call_group, * FROM calls)
            SELECT coalesce(call_group, 'totals') AS call_group, count(*) AS calls, coalesce(sum(input_tokens), 0)::BIGINT AS input_tokens, coalesce(sum(output_tokens), 0)::BIGINT AS output_tokens,
            coalesce(sum(greatest(latency_ms, 0)) FILTER (latency_ms IS NOT NULL), 0)::BIGINT AS latency_ms FROM g GROUP BY ROLLUP (call_group)""",
        "call_costs": f"WITH {_CALLS} SELECT call_type, count(*) AS calls, round(sum(coalesce(input_tokens, 0) * 5 + coalesce(output_tokens, 0) * 15) / 1e6, 6) AS usd FROM calls GROUP BY 1",
        "last_calls": f"""WITH {_CALLS} SELECT run_id, source_book, source_page, attempt, metric_id FROM calls WHERE call_type = 'generation'
            QUALIFY row_number() OVER (PARTITION BY run_id, source_book, source_page ORDER BY attempt DESC NULLS LAST, timestamp_epoch DESC NULLS LAST, metric_id DESC) = 1""",
        "book_yield": f"WITH {_CHATS} SELECT coalesce(metadata.source_book, '') AS source_book, count(*) AS n FROM chats WHERE metadata.record_level = 'local' GROUP BY 1",
        "distributions": f"WITH {_CHATS} " + " UNION ALL ".join(f"SELECT '{k}' AS kind, coalesce(metadata.{k}, 'unknown') AS value, count(*) AS n FROM chats GROUP BY ALL" for k in ("question_type", "difficulty", "synthesis_type", "record_level")),
        "all_records": f"WITH {_CHATS} SELECT metadata.record_level AS level, metadata.run_id AS run_id, count(*) AS n FROM chats WHERE metadata.record_level IS NOT NULL GROUP BY ALL",
        "run_report": f"""WITH {_PAGES}, {_PAIRS}, {_GATED}, {_LATEST}, {_PACKS}, {_CHATS}, {_QUOTED}, {_CALLS},
            s AS (SELECT count(*) AS total_pages_seen, count(*) FILTER ({_UNUSABLE}) AS skipped_pages FROM pages),
            t AS (SELECT count(*) AS local_candidates, count(*) FILTER (len(reasons) > 0) AS quality_rejected, 0::BIGINT AS duplicates_filtered FROM judged),
            m AS (SELECT count(*) FILTER (metadata.record_level = 'local') AS local_accepted, count(*) FILTER (metadata.record_level = 'cross_page') AS cross_page_accepted,
                round(coalesce(avg({_words(_strip(_say('assistant')))}) FILTER (metadata.record_level = 'local'), 0.0), 2) AS average_answer_length_words FROM chats),
            i AS (SELECT metadata.pack_id AS pack_id, count(*) AS n FROM chats WHERE metadata.pack_id <> '' GROUP BY 1),
            p AS (SELECT coalesce(sum(n), 0)::BIGINT AS cross_page_candidates, 0::BIGINT AS cross_page_duplicates_filtered, round(coalesce(avg(len(pages_)), 0.0), 2) AS average_pages_per_evidence_pack FROM packs LEFT JOIN i USING (pack_id)),
            c AS (SELECT count(*) AS api_calls_total, count(*) FILTER (call_type IN ('generation', 'synthesis')) AS api_calls_generation, count(*) FILTER (call_type IN ('critique', 'cross_page_critique')) AS api_calls_critique,
                coalesce(sum(greatest(latency_ms, 0)) FILTER (latency_ms IS NOT NULL), 0) AS latency, coalesce(sum(greatest(input_tokens, 0)) FILTER (input_tokens IS NOT NULL), 0)::BIGINT AS api_total_input_tokens,
                coalesce(sum(greatest(output_tokens, 0)) FILTER (output_tokens IS NOT NULL), 0)::BIGINT AS api_total_output_tokens,
                round(sum(greatest(coalesce(input_tokens, 0) * 5 + coalesce(output_tokens, 0) * 15, 0)) / 1e6, 6) AS estimated_total_cost_usd FROM calls),
            l AS (SELECT metadata FROM chats WHERE metadata.record_level = 'local')
            SELECT s.*, t.*, m.*, p.*, c.* EXCLUDE (latency), local_accepted + cross_page_accepted AS total_records, local_candidates AS total_candidate_qas, 0.0::DOUBLE AS duplicate_rate, 0.0::DOUBLE AS cross_page_duplicate_rate,
            round(skipped_pages / total_pages_seen, 4) AS unusable_page_rate, round(latency / api_calls_total, 2) AS api_average_latency_ms, round(api_total_input_tokens / api_calls_total, 2) AS api_average_input_tokens_per_call,
            round(api_total_output_tokens / api_calls_total, 2) AS api_average_output_tokens_per_call, {_histogram("coalesce(nullif(metadata.question_type, ''), 'unknown')", 'l')} AS question_type_distribution,
            {_histogram("coalesce(nullif(metadata.difficulty, ''), 'unknown')", 'l')} AS difficulty_distribution, {_histogram("coalesce(metadata.source_book, '')", 'l')} AS per_book_yield,
            {_histogram('reason', '(SELECT unnest(reasons) AS reason FROM judged)')} AS local_rejection_reasons, {_histogram("'evidence_quote_not_found_in_pack_text'", '(SELECT 1 FROM quoted WHERE NOT found)')} AS cross_rejection_reasons,
            {_histogram("coalesce(nullif(metadata.synthesis_type, ''), 'unknown')", "(SELECT metadata FROM chats WHERE metadata.record_level = 'cross_page')")} AS synthesis_type_distribution FROM s, t, m, p, c""",
    }
