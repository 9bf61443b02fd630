"""Groups of related books, and splits that keep each group whole."""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.books import book_key, person_key, record_book_key, series_key
from foliospark.llm.graph import components
from foliospark.sources.tables import cut, join_hot, once_per

#: Shares wanted of the records.
SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}
#: Equal bins that the largest-differencing method fills before whole bins go to splits.
BINS = 40
#: Groups (or partial results) that one task combines.
BLOCK = 2000


def book_groups(catalog: DataFrame) -> DataFrame:
    """``(book, source_book, group_book)`` per catalogue row: book is the key of all its spellings, and
    group_book the least source_book tied to it by authors or series, directly or through others.

    Null or empty authors and placeholders tie nothing; repeated catalogue rows count once; rows
    without a source_book are left out.
    """
    books = catalog.select("source_book", "authors", "series").where("source_book is not null")
    ties = books.select("source_book", F.explode(F.array_compact(F.array_append(
        F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.concat(F.lit("a:"), person_key(a))),
        F.concat(F.lit("s:"), series_key(F.col("series"))),
    ))).alias("tie")).distinct()
    # a tie is represented by its least book, so a hub has as many edges as books, not pairs
    hub = ties.groupBy("tie").agg(F.min("source_book").alias("v"), F.count("*").alias("n")).where("n > 1")
    edges = ties.join(hub, "tie").select(F.col("source_book").alias("u"), "v")
    grouped = components(edges).withColumnsRenamed({"node": "source_book", "component": "group_book"})
    return (
        books.select("source_book").distinct().join(grouped, "source_book", "left")
        .select(book_key(F.col("source_book")).alias("book"), "source_book", F.coalesce("group_book", "source_book").alias("group_book"))
    )


def record_groups(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """``(record_id, group_book)`` of each record that names a book.

    A record whose book isn't in the catalogue forms a group with the other records of that book,
    named by the book's key. Records that name no book are left out; repeated rows count once.
    """
    named = records.select("record_id", record_book_key(F.col("metadata")).alias("book")).where("book is not null")
    groups = book_groups(catalog).groupBy("book").agg(F.min("group_book").alias("group_book"))
    # a book may hold a third of all records
    return join_hot(once_per(named, "record_id"), groups, "book", "record_id", "left").select("record_id", F.coalesce("group_book", "book").alias("group_book"))


def differencing(weights: list[tuple[list[float], list[list]]], bins: int) -> tuple[list[float], list[list]]:
    """Largest-differencing balance: of the partial fillings with the greatest spread, two at a time
    are laid together, the fullest bins of one on the emptiest of the other."""
    heap = []
    for k, (sums, members) in enumerate(weights):
        order = sorted(range(bins), key=lambda i: -sums[i])
        heap.append((-(sums[order[0]] - sums[order[-1]]), k, [sums[i] for i in order], [members[i] for i in order]))
    heapq.heapify(heap)
    tick = len(heap)
    while len(heap) > 1:
        _, _, a, am = heapq.heappop(heap)
        _, _, b, bm = heapq.heappop(heap)
        sums = [a[i] + b[bins - 1 - i] for i in range(bins)]
        members = [am[i] + bm[bins - 1 - i] for i in range(bins)]
        order = sorted(range(bins), key=lambda i: -sums[i])
        heapq.heappush(heap, (-(sums[order[0]] - sums[order[-1]]), tick, [sums[i] for i in order], [members[i] for i in order]))
        tick += 1
    return heap[0][2], heap[0][3]


def _fill(bins: int):
    """One block: its items (node, weight, slot) are laid into bins. Items that share a parent are the
    bins of one earlier filling and stay apart."""

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        weights = []
        for _, part in pdf.groupby("parent", sort=True):
            sums, members = [0.0] * bins, [[] for _ in range(bins)]
            for k, (node, w) in enumerate(sorted(zip(part["node"], part["weight"]), key=lambda x: (-x[1], x[0]))):
                sums[k] += w
                members[k].append(node)
            weights.append((sums, members))
        sums, members = differencing(weights, bins)
        block = int(pdf["block"].iloc[0])
        return pd.DataFrame([(n, block, b, float(s)) for b, (s, m) in enumerate(zip(sums, members)) for n in m], columns=["node", "block", "bin", "weight"])

    return fill


def balanced_bins(groups: DataFrame, bins: int = BINS, block: int = BLOCK) -> DataFrame:
    """``(node, bin)`` for items ``(node, weight)``: a tree of largest-differencing steps.

    Blocks of at most about ``block`` items are balanced by themselves; the bins of blocks are then
    items of the next level, until one block is left. Every level divides the number of blocks by
    ``block / bins``, and nothing but a count reaches the driver.
    """
    items = cut(groups.select(F.col("node").cast("string").alias("node"), F.col("weight").cast("double").alias("weight")))
    n = items.count()
    if n == 0:
        return items.select("node", F.lit(0).alias("bin"))
    blocks = max(1, math.ceil(n / block))
    level = items.select("node", "weight", F.col("node").alias("parent"), F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("block"))
    path = None
    while True:
        filled = cut(level.groupBy("block").applyInPandas(_fill(bins), "node string, block long, bin int, weight double"))
        slot = F.concat_ws("/", F.lit(f"b{blocks}"), "block", "bin")
        step = filled.select("node", slot.alias("slot"), "bin")
        path = step.select("node", "slot", "bin") if path is None else path.select(F.col("node").alias("first"), F.col("slot").alias("node")).join(step, "node").select(F.col("first").alias("node"), "slot", "bin")
        if blocks == 1:
            return path.select("node", "bin")
        fewer = max(1, min(math.ceil(blocks * bins / block), blocks // 2))
        level = (
            filled.groupBy("block", "bin").agg(F.first("weight").alias("weight"))
            .select(slot.alias("node"), "weight", F.col("block").cast("string").alias("parent"), F.pmod(F.col("block"), F.lit(fewer)).alias("block"))
        )
        blocks = fewer


def allocate(sums: dict[int, float], shares: dict[str, float] = SHARES) -> dict[int, str]:
    """Whole bins to splits: the heaviest bin left goes to the split that lacks most of its share."""
    total = sum(sums.values())
    lack = {name: share * total for name, share in shares.items()}
    out = {}
    for b, weight in sorted(sums.items(), key=lambda x: (-x[1], x[0])):
        name = max(lack, key=lambda s: (lack[s], -list(shares).index(s)))
        out[b] = name
        lack[name] -= weight
    return out


def split_records(records: DataFrame, catalog: DataFrame, shares: dict[str, float] = SHARES, bins: int = BINS, block: int = BLOCK) -> DataFrame:
    """``(record_id, group_book, split)``: no group is divided, and records are shared out as wanted as
    far as the largest group allows. Records that name no book are groups of their own, with a null group_book.
    """
    every = records.select("record_id").distinct()
    grouped = cut(every.join(record_groups(records, catalog), "record_id", "left").withColumn(
        "node", F.coalesce(F.concat(F.lit("g:"), "group_book"), F.concat(F.lit("r:"), F.col("record_id").cast("string"), F.lit("")), F.lit("r:"))))
    # single records are interchangeable: as blocks of dust they are balanced like all others
    weights = grouped.groupBy("node").agg(F.count("*").alias("weight"))
    placed = cut(balanced_bins(weights, bins, block))
    sums = {r["bin"]: r["w"] for r in placed.join(weights, "node").groupBy("bin").agg(F.sum("weight").alias("w")).collect()}  # at most `bins` rows
    names = allocate(sums, shares)
    label = F.lit(None).cast("string")
    for b, name in names.items():
        label = F.when(F.col("bin") == b, name).otherwise(label)
    return join_hot(grouped, placed.select("node", label.alias("split")), "node", "record_id").select("record_id", "group_book", "split")
