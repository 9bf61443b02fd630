"""Copies of documents so that sources have wanted shares of all tokens."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.bpe import VOCABULARY, token_count
from foliospark.sources.tables import cut, once_per, spread

#: Documents (or residuals of blocks) that one task of the reduction tree rounds.
BLOCK = 4000
SEED = 20


def source_name(source: Column) -> Column:
    """Lower case without blanks around; null for a blank name."""
    name = F.trim(F.regexp_replace(F.lower(source), r"(?U)[\s\x1c-\x1f]+", " "))
    return F.when(name != "", name)


def sized_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, source, n_tokens)``; documents without a source or without tokens can't be mixed and are left out."""
    sized = spread(docs.select("doc_id", "source", "text")).select("doc_id", source_name(F.col("source")).alias("source"), token_count(F.col("text"), vocabulary).alias("n_tokens"))
    return once_per(sized.where("n_tokens > 0 and source is not null"), "doc_id")


def rates(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """``(source, target_share, max_repeats, tokens, rate)`` per listed source; rate is the mean number of
    copies of its documents.

    Without ``total`` the mixture is as large as it can be with every source that has documents at
    its share (shares of listed sources without documents are lost to the others in proportion).
    With ``total`` a source that would exceed its cap stays at the cap and falls short. Targets that
    repeat a source count once; null or negative shares are 0, a null cap is 1.
    """
    wanted = targets.select(source_name(F.col("source")).alias("source"), F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("target_share"),
                            F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats")).where("source is not null").dropDuplicates(["source"])
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
    both = wanted.join(have, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    there = F.when((F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0), F.col("target_share"))
    limits = both.agg(F.sum(there).alias("share"), F.min(F.col("max_repeats") * F.col("tokens") / there).alias("most")).first()  # one row
    share = limits["share"] or 0.0
    size = float(total) if total is not None else (limits["most"] or 0.0) * share
    wanted_tokens = F.col("target_share") * (size / share if share else 0.0)
    rate = F.when(F.col("tokens") > 0, F.least(wanted_tokens / F.col("tokens"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return both.select("source", "target_share", "max_repeats", "tokens", F.coalesce("documents", F.lit(0)).alias("documents"), rate.alias("rate"))


def pivot_round(probability: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Pivotal rounding: the mass of two fractional entries is moved between them at random, keeping
    each expectation, until one is 0 or 1; at most one entry stays fractional."""
    p = probability.astype(float).tolist()
    eps, held = 1e-9, -1
    draws = rng.random(len(p)).tolist()
    for j in range(len(p)):
        if p[j] < eps or p[j] > 1 - eps:
            p[j] = float(round(p[j]))
            continue
        if held < 0:
            held = j
            continue
        a, b = p[held], p[j]
        both = a + b
        if both <= 1:
            if draws[j] * both < a:
                p[held], p[j] = both, 0.0
            else:
                p[held], p[j] = 0.0, both
        elif draws[j] * (2 - both) < 1 - b:
            p[held], p[j] = 1.0, both - 1
        else:
            p[held], p[j] = both - 1, 1.0
        left = held if eps < p[held] < 1 - eps else j if eps < p[j] < 1 - eps else -1
        for k in (held, j):
            if k != left:
                p[k] = float(round(p[k]))
        held = left
    return np.array(p)


def _round_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Neighbours in size trade their mass, so tokens move little."""
    pdf = pdf.sort_values(["n_tokens", "doc_id"], kind="stable")
    seed = int(np.uint64(pd.util.hash_array(np.array([f"{SEED}/{pdf['source'].iloc[0]}/{pdf['level'].iloc[0]}/{pdf['block'].iloc[0]}"], dtype=object))[0]))
    return pdf.assign(p=pivot_round(pdf["p"].to_numpy(), np.random.default_rng(seed)))[["doc_id", "source", "n_tokens", "block", "p"]]


def mixed_copies(docs: DataFrame, targets: DataFrame, total: float | None = None, vocabulary: str = VOCABULARY, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``copies`` (doc_id, source, n_tokens, copies) with at least one copy, and ``report``
    (source, target_share, actual_share, max_repeats, documents, tokens_available, tokens_taken).

    Each document gets its source's rate rounded down, and one copy more by pivotal rounding of the
    rest: blocks of a source first, then the one fractional document that each block leaves, level by
    level. Copies never exceed max_repeats, and the copies of a source differ from rate * documents by less
    than one. Documents of unlisted sources get none. Empty tables give empty results.
    """
    sizes = cut(sized_documents(docs, vocabulary))
    plan = cut(rates(sizes, targets, total))
    most = plan.agg(F.max("documents")).first()[0] or 0
    blocks = max(1, math.ceil(most / block))
    each = sizes.join(F.broadcast(plan) if plan.count() <= 10_000 else plan, "source").select(
        "doc_id", "source", "n_tokens", F.floor("rate").cast("int").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"), "max_repeats")
    level = each.withColumn("level", F.lit(0)).withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(blocks)))
    schema = "doc_id long, source string, n_tokens long, block long, p double"
    settled, depth = None, 0
    now = level.select("doc_id", "source", "n_tokens", "block", "level", "p")
    while True:
        done = cut(now.groupBy("source", "block").applyInPandas(_round_block, schema))
        fixed = done.where("p = 1").select("doc_id")
        settled = fixed if settled is None else settled.unionAll(fixed)
        rest = done.where("p > 0 and p < 1")
        if blocks == 1:
            # the last fractional document of a source is rounded by a draw of its own
            draw = F.pmod(F.xxhash64("source", F.lit(SEED)), F.lit(1 << 30)) / (1 << 30)
            settled = settled.unionAll(rest.where(draw < F.col("p")).select("doc_id"))
            break
        depth += 1
        blocks = max(1, math.ceil(blocks / block))
        now = rest.select("doc_id", "source", "n_tokens", F.pmod("block", F.lit(blocks)).alias("block"), F.lit(depth).alias("level"), "p")
    extra = settled.withColumn("extra", F.lit(1))
    copies = cut(each.join(extra, "doc_id", "left").select(
        "doc_id", "source", "n_tokens", F.least(F.col("whole") + F.coalesce("extra", F.lit(0)), "max_repeats").alias("copies")).where("copies > 0"))
    taken = copies.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("taken"))
    sums = plan.join(taken, "source", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    whole = sums.agg(F.sum("taken")).first()[0] or 0
    share = F.col("taken") / whole if whole else F.lit(0.0)
    report = sums.select("source", "target_share", share.alias("actual_share"), "max_repeats", "documents", F.col("tokens").alias("tokens_available"), F.col("taken").alias("tokens_taken"))
    return copies, report
