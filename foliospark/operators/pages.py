"""Signals of pages: keywords, headings, first lines, question types."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import first_lines, heading, terms

#: A missing status counts as unreadable.
UNUSABLE = ["blank", "unreadable"]


def is_unusable(status: Column) -> Column:
    return F.coalesce(status, F.lit("unreadable")).isin(UNUSABLE)


def keyword_text(page_text: Column, qas: Column) -> Column:
    """Page text, a line end, and all questions and answers with spaces between; nulls count as empty."""
    said = F.array_join(F.transform(F.coalesce(qas, F.array().cast("array<struct<question:string,answer:string,question_type:string,difficulty:string,citation_quote:string>>")),
                                    lambda q: F.concat(F.coalesce(q["question"], F.lit("")), F.lit(" "), F.coalesce(q["answer"], F.lit("")))), " ")
    return F.concat(F.coalesce(page_text, F.lit("")), F.lit("\n"), said)


def with_top_terms(df: DataFrame, found: Column, name: str = "keywords", n: int = 20) -> DataFrame:
    """Adds the ``n`` most frequent entries of an array, ties by first appearance, without leaving the row. Null gives none.

    Built-in functions on arrays would search the array anew for each entry, which is quadratic in a page; a count by
    hashing is one pass, over batches of arrays.
    """

    @F.pandas_udf("array<string>")
    def top(arrays: pd.Series) -> pd.Series:
        # most_common is stable, and a Counter keeps the order of first appearance
        return pd.Series([[term for term, _ in Counter(x).most_common(n)] if x is not None else [] for x in arrays], dtype=object)

    return df.withColumn(name, top(found))


def question_types(qas: Column) -> Column:
    """Map of question types of a page to their counts; a null type is ``unknown``. An empty map without pairs."""
    types = F.transform(qas, lambda q: F.coalesce(q["question_type"], F.lit("unknown")))
    counts = F.transform(F.array_distinct(types), lambda t: F.struct(t, F.size(F.filter(types, lambda x: x == t)).cast("long")))
    return F.coalesce(F.map_from_entries(counts), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>")))


def page_artifacts(pages: DataFrame) -> DataFrame:
    """Adds heading_candidate, first_non_empty_lines, keywords and question_type_distribution to pages
    (page_text, accepted_qas, and any other columns, which are kept). Null and empty texts give '' and empty
    arrays. One projection without a shuffle."""
    made = pages.withColumns({
        "heading_candidate": heading(F.coalesce("page_text", F.lit(""))),
        "first_non_empty_lines": first_lines(F.coalesce("page_text", F.lit(""))),
        "question_type_distribution": question_types(F.col("accepted_qas")),
    })
    return with_top_terms(made, terms(keyword_text(F.col("page_text"), F.col("accepted_qas"))))


def skipped(pages: DataFrame) -> DataFrame:
    """Rows of unusable pages: ``run_id, source_book, source_page, status, reason``."""
    return pages.where(is_unusable(F.col("page_status"))).select(
        "run_id", "source_book", "source_page", F.coalesce("page_status", F.lit("unreadable")).alias("status"), F.coalesce("page_status_reason", F.lit("")).alias("reason"))


def last_attempts(calls: DataFrame, keys: list[str], attempt: str = "attempt", *ties: str) -> DataFrame:
    """The row of the last attempt per key; ties by the columns ``ties``, descending. Null attempts come last."""
    order = [F.col(attempt).desc_nulls_last(), *(F.col(t).desc_nulls_last() for t in ties)]
    return calls.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def not_done(pages: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("source_book", "source_page")) -> DataFrame:
    """Pages (or packs) that an earlier run hasn't done: an anti-join before any work on them."""
    return pages.join(done.select(*keys).distinct(), list(keys), "left_anti")


def capped(pages: DataFrame, most: int) -> DataFrame:
    """Pages up to the cap of each book; the predicate reaches the scan."""
    return pages.where(F.col("source_page") <= most)


def running_counts(pages: DataFrame, n_rejected: Column | None = None, **kept: Column) -> DataFrame:
    """Per run, in order of books and pages: pages seen, skipped pages and accepted pairs so far (and pairs rejected, where their
    number per page is given).

    A book is the largest thing that is put in order as a whole: what the books before it come to is added up from one row
    per book.
    """
    counts = {"pages_seen": F.lit(1), "skipped_pages": is_unusable(F.col("page_status")).cast("int"), "accepted_pairs": F.greatest(F.coalesce(F.size("accepted_qas"), F.lit(0)), F.lit(0))}
    counts |= {} if n_rejected is None else {"n_rejected": n_rejected}
    rows = pages.select("run_id", "source_book", "source_page", *(c.cast("long").alias(n) for n, c in counts.items()), *(c.alias(n) for n, c in kept.items()))
    books = rows.groupBy("run_id", "source_book").agg(*(F.sum(n).alias(f"_{n}") for n in counts))
    earlier = Window.partitionBy("run_id").orderBy("source_book").rowsBetween(Window.unboundedPreceding, -1)
    before = books.select(F.col("run_id").alias("_run"), F.col("source_book").alias("_book"), *(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in counts))
    so_far = Window.partitionBy("run_id", "source_book").orderBy("source_page").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.join(before, F.col("run_id").eqNullSafe(F.col("_run")) & F.col("source_book").eqNullSafe(F.col("_book")))
    return both.select("run_id", "source_book", "source_page", *((F.sum(n).over(so_far) + F.col(f"_{n}")).alias(n) for n in counts), *kept)
