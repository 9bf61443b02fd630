"""Tokens of records, and their totals by source book, language and domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.books import book_key, record_book_key
from foliospark.llm.bpe import VOCABULARY, token_count
from foliospark.sources.tables import once_per, spread


def record_tokens(records: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(record_id, book, n_tokens)``: exact tokens of all messages of each record.

    Contents are counted one by one, as each is encoded on its own; null and empty contents and null
    messages have none. ``book`` is the key of the named book, null without one. Repeated rows count once.
    """
    texts = F.transform(F.coalesce("messages", F.array().cast("array<struct<role:string,content:string>>")), lambda m: F.coalesce(m["content"], F.lit("")))
    # U+0001 between contents would merge with nothing, but isn't free of tokens: contents are exploded instead
    one = once_per(spread(records.select("record_id", "messages", "metadata")), "record_id")
    parts = one.select("record_id", record_book_key(F.col("metadata")).alias("book"), F.explode_outer(texts).alias("text"))
    counted = parts.select("record_id", "book", token_count(F.col("text"), vocabulary).alias("n"))
    return counted.groupBy("record_id").agg(F.first("book").alias("book"), F.sum("n").alias("n_tokens"))


def token_cube(records: DataFrame, catalog: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(source_book, lang, domain, n_records, n_tokens, is_total)`` for every combination of the three.

    A null in a column whose place in ``is_total`` (bits for book, lang, domain) is 1 stands for all
    values. Books that aren't in the catalogue, missing languages and domains are ``unknown``.
    """
    # a hot book is one row before the catalogue is joined
    books = record_tokens(records, vocabulary).groupBy("book").agg(F.count("*").alias("records"), F.sum("n_tokens").alias("tokens"))
    shelf = catalog.where("source_book is not null").groupBy(book_key(F.col("source_book")).alias("book")).agg(
        F.min_by(F.struct("source_book", "lang", "domain"), "source_book").alias("b"))
    known = lambda c: F.coalesce(F.when(F.trim(c) != "", F.lower(F.trim(c))), F.lit("unknown"))
    named = books.join(shelf, "book", "left").select(
        F.coalesce("b.source_book", F.lit("unknown")).alias("source_book"), known(F.col("b.lang")).alias("lang"), known(F.col("b.domain")).alias("domain"), "records", "tokens")
    return named.cube("source_book", "lang", "domain").agg(
        F.sum("records").alias("n_records"), F.sum("tokens").alias("n_tokens"), F.grouping_id().cast("int").alias("is_total"))
