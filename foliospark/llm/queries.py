"""Queries of this subpackage over a directory of tables, and the SQL that some are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import bpe, budget, mixing, near, pairs, personal, quantiles, scans, spans, splits
from foliospark.llm.books import PLACEHOLDERS
from foliospark.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    shared = spans.SharedSpans(spans.texts_of(table(spark, d, "page_artifacts"), table(spark, d, "chatml_dataset")))
    return spans.named(shared.rows()).select("source_table", "row_id")


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    shared = spans.SharedSpans(spans.texts_of(table(spark, d, "page_artifacts"), table(spark, d, "chatml_dataset")))
    return spans.named(shared.shares()).select("source_table", "row_id", "shared_chars", "n_chars")


def p2_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.model_percentiles(table(spark, d, "api_metrics"))


def p2_daily_digests(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.daily_digests(table(spark, d, "api_metrics"))


def p2_measured(spark: SparkSession, d: str) -> DataFrame:
    """Valid measurements per model and measure, against which digests are complete."""
    return quantiles.measured(table(spark, d, "api_metrics")).groupBy("model", "measure").agg(F.sum("count").alias("n"))


def p2_checked(spark: SparkSession, d: str) -> DataFrame:
    """Whether each percentile lies within its stated errors, by the exact ranks of all values."""
    return quantiles.checked(table(spark, d, "api_metrics"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return near.NearRecords(table(spark, d, "chatml_dataset")).pairs()


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return near.NearRecords(table(spark, d, "chatml_dataset")).groups()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defective_pairs(table(spark, d, "page_artifacts"), table(spark, d, "chatml_dataset"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.record_groups(table(spark, d, "chatml_dataset"), table(spark, d, "book_catalog"))


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_records(table(spark, d, "chatml_dataset"), table(spark, d, "book_catalog"))


def p5_whole_groups(spark: SparkSession, d: str) -> DataFrame:
    """Splits that each group of records lies in: one."""
    split = p5_splits(spark, d).where("group_book is not null")
    return split.groupBy("group_book").agg(F.count("*").alias("n_records"), F.count_distinct("split").alias("n_splits"))


def p6_token_cube(spark: SparkSession, d: str) -> DataFrame:
    return budget.token_cube(table(spark, d, "chatml_dataset"), table(spark, d, "book_catalog"))


def p6_record_tokens(spark: SparkSession, d: str) -> DataFrame:
    return budget.record_tokens(table(spark, d, "chatml_dataset"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.noisy_lines(table(spark, d, "page_artifacts"))


def p7_texts(spark: SparkSession, d: str) -> DataFrame:
    return scans.continuous_text(table(spark, d, "page_artifacts"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, d, "documents"))


def p9_copies(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed_copies(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed_copies(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.personal_items(table(spark, d, "documents"), table(spark, d, "given_names")).select("doc_id", "kind", "start_char")


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redacted(table(spark, d, "documents"), table(spark, d, "given_names"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            p1_found, p1_shares, p2_percentiles, p2_daily_digests, p2_measured, p2_checked, p3_found, p3_groups, p4_found, p5_found, p5_splits, p5_whole_groups, p6_token_cube, p6_record_tokens, p7_found, p7_texts, p8_ids, p9_copies, p9_shares, p10_found, p10_redacted,
        )
    }


# White space as Spark's patterns see it, in RE2.
_B = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_CHATS = "chats AS (SELECT * FROM chatml_dataset WHERE record_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY record_id) = 1)"
#: All windows of 200 characters, those that stand in two rows, and the characters they cover.
_SPANS = f"""{_CHATS}, pages AS (SELECT * FROM page_artifacts WHERE artifact_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY artifact_id) = 1),
    said AS (SELECT 'chatml_dataset' AS source_table, record_id AS row_id, i AS part, m.content AS text FROM (SELECT record_id, unnest(messages) AS m, generate_subscripts(messages, 1) AS i FROM chats) WHERE m.role IN ('user', 'assistant')
        UNION ALL SELECT 'page_artifacts', artifact_id, 0, page_text FROM pages),
    texts AS (SELECT source_table, row_id, part, trim(regexp_replace(text, '{_B}+', ' ', 'g')) AS text FROM said WHERE text IS NOT NULL),
    windows AS (SELECT source_table, row_id, part, pos, hash(substring(text, pos, 200)) AS h FROM (SELECT *, unnest(range(1, length(text) - 198)) AS pos FROM texts WHERE length(text) >= 200)),
    shared AS (SELECT h FROM windows GROUP BY h HAVING count(DISTINCT (source_table, row_id)) > 1),
    hits AS (SELECT source_table, row_id, part, pos FROM windows SEMI JOIN shared USING (h))"""
#: All pairs of records by their words, one by one.
_NEAR = f"""{_CHATS}, worded AS (SELECT record_id, list_filter(string_split_regex(lower(coalesce((list_filter(messages, lambda m: m.role = 'user')[1]).content, '') || ' ' ||
        coalesce((list_filter(messages, lambda m: m.role = 'assistant')[1]).content, '')), '{_B}+'), lambda w: w <> '') AS words FROM chats),
    fit AS (SELECT record_id, words, len(words) AS n FROM worded WHERE len(words) >= 45),
    each AS (SELECT record_id, n, w, row_number() OVER (PARTITION BY record_id, w) AS k FROM (SELECT record_id, n, unnest(words) AS w FROM fit)),
    pairs AS (SELECT a.record_id AS record_a, b.record_id AS record_b FROM each a JOIN each b ON a.w = b.w AND a.k = b.k AND a.record_id < b.record_id
        GROUP BY a.record_id, b.record_id, a.n, b.n HAVING 2 * count(*) / (a.n + b.n) >= 0.8)"""


def _plain(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}\x{{200b}}\x{{feff}}_]+', ' ', 'g'))"


def _book(x: str) -> str:
    name = f"CASE WHEN regexp_matches({x}, '%[0-9A-Fa-f]{{2}}') THEN url_decode(replace({x}, '+', '%2B')) ELSE {x} END"
    last = rf"regexp_replace({name}, '^.*[/\\]', '')"
    return rf"nullif(regexp_replace({_plain(last)}, ' ?\.pdf$', ''), '')"


def _related() -> str:
    none = ", ".join(f"'{p}'" for p in PLACEHOLDERS)
    words = f"list_sort(list_filter(string_split_regex(regexp_replace({_plain('author')}, '[,;]+', ' ', 'g'), ' +'), lambda w: w <> ''))"
    return f"""RECURSIVE {_CHATS}, authors AS (SELECT source_book, unnest(authors) AS author FROM book_catalog),
    ties AS (SELECT source_book, 'a:' || array_to_string({words}, ' ') AS tie FROM authors WHERE {_plain('author')} NOT IN ({none}) AND len({words}) > 0
        UNION SELECT source_book, 's:' || {_plain('series')} FROM book_catalog WHERE {_plain('series')} NOT IN ({none})),
    edges AS (SELECT DISTINCT a.source_book AS x, b.source_book AS y FROM ties a JOIN ties b USING (tie)),
    reach AS (SELECT source_book AS x, source_book AS y FROM book_catalog WHERE source_book IS NOT NULL UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y),
    grouped AS (SELECT {_book('x')} AS book, min(y) AS group_book FROM reach GROUP BY 1),
    named AS (SELECT record_id, coalesce({_book('metadata.source_book')}, {_book("split_part(metadata.pack_id, '::', 1)")}) AS book FROM chats),
    related AS (SELECT record_id, coalesce(group_book, book) AS group_book FROM named LEFT JOIN grouped USING (book) WHERE book IS NOT NULL)"""


def oracle_sql() -> dict[str, str]:
    measured = """once AS (SELECT DISTINCT metric_id, model, latency_ms, estimated_cost_usd FROM api_metrics),
            named AS (SELECT CASE WHEN model IS NULL OR trim(model) = '' THEN 'unknown' ELSE lower(trim(model)) END AS model, latency_ms, estimated_cost_usd FROM once),
            counted AS (SELECT model, 'latency_ms' AS measure, count(*) AS n FROM named WHERE latency_ms BETWEEN 1 AND 86400000 GROUP BY ALL
            UNION ALL
            SELECT model, 'estimated_cost_usd' AS measure, count(*) AS n FROM named
            WHERE estimated_cost_usd >= 0 AND NOT isnan(estimated_cost_usd) AND NOT isinf(estimated_cost_usd) GROUP BY ALL)"""
    return {
        "p1_found": f"WITH {_SPANS} SELECT DISTINCT source_table, row_id FROM hits",
        "p1_shares": f"""WITH {_SPANS}, added AS (SELECT source_table, row_id, least(200, coalesce(pos - lag(pos) OVER (PARTITION BY source_table, row_id, part ORDER BY pos), 200)) AS n FROM hits)
            SELECT source_table, row_id, shared_chars, n_chars FROM (SELECT source_table, row_id, sum(n)::BIGINT AS shared_chars FROM added GROUP BY ALL)
            JOIN (SELECT source_table, row_id, sum(length(text))::BIGINT AS n_chars FROM texts GROUP BY ALL) USING (source_table, row_id)""",
        "p2_measured": f"WITH {measured} SELECT * FROM counted",
        "p2_checked": f"WITH {measured} SELECT model, measure, percent::DOUBLE AS percent, n, true AS within FROM counted, (SELECT unnest({quantiles.PERCENTS}) AS percent)",
        "p3_found": f"WITH {_NEAR} SELECT record_a, record_b FROM pairs",
        "p3_groups": f"""WITH RECURSIVE {_NEAR}, edges AS (SELECT record_a AS x, record_b AS y FROM pairs UNION ALL SELECT record_b, record_a FROM pairs),
            reach AS (SELECT record_id AS x, record_id AS y FROM fit UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y)
            SELECT record_id, min(record_id) OVER (PARTITION BY list_sort(words)) AS class_id, group_id, coalesce(n_links, 0) AS n_links
            FROM fit JOIN (SELECT x AS record_id, min(y) AS group_id FROM reach GROUP BY 1) USING (record_id) LEFT JOIN (SELECT x AS record_id, count(*) AS n_links FROM edges GROUP BY 1) USING (record_id)""",
        "p5_found": f"WITH {_related()} SELECT record_id, group_book FROM related",
        "p5_whole_groups": f"WITH {_related()} SELECT group_book, count(*) AS n_records, 1::BIGINT AS n_splits FROM related GROUP BY 1",
    }
