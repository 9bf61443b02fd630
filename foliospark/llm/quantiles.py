"""Percentiles from mergeable dyadic-tree digests (q-digests) with a deterministic rank error.

A value is quantized to one of ``2**LEVELS`` ordered cells whose width is a fixed fraction of the
value. A digest is a set of nodes of the binary tree over the cells with a count each; nodes are
numbered as in a heap (the root is 1, the cells ``2**LEVELS + cell``). Digests are merged by adding
counts of equal nodes. With compression factor k a quantile's rank is off by at most
``LEVELS / k`` of the number of values, whatever was merged in whatever order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.sources.tables import once_per

#: Depth of the tree: 262,144 cells, for 256 powers of two.
LEVELS = 18
#: Cells per power of two; values in a cell differ by at most 1/1024 of their size.
STEPS = 1024
#: Compression factor: rank error of at most LEVELS / FACTOR, here 0.1 %.
FACTOR = 18_000
PERCENTS = [1, 5, 10, 25, 50, 75, 90, 95, 99]

#: A call can't have lasted longer than a day.
LONGEST_MS = 86_400_000
#: Measures and the value of their first cell border: smaller values count as 0, and costs from 2**128 on as the last below it.
MEASURES = {"latency_ms": 2.0**-10, "estimated_cost_usd": 2.0**-128}


def model_name(model: Column) -> Column:
    """Lower case without blanks around; null and blank names become ``unknown``."""
    name = F.trim(F.regexp_replace(F.lower(model), r"(?U)[\s\x1c-\x1f]+", " "))
    return F.when(name.isNull() | (name == ""), "unknown").otherwise(name)


def cell(value: Column, unit: Column) -> Column:
    """Ordered cell of a value: 0 for values under the unit (zero included), else one of STEPS linear
    steps inside its power of two. Values beyond the universe fall into the last cell."""
    x = value / unit
    # floor of the binary logarithm, corrected where log2 rounds across a power of two
    guess = F.floor(F.log2(x)).cast("int")
    power = F.when(F.pow(F.lit(2.0), guess) > x, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= x, guess + 1).otherwise(guess)
    step = F.floor((x / F.pow(F.lit(2.0), power) - 1) * STEPS).cast("int")
    index = power * STEPS + F.least(step, F.lit(STEPS - 1)) + 1
    return F.when(x < 1, 0).otherwise(F.least(index, F.lit(2**LEVELS - 1))).cast("int")


def cell_value(index: Column, unit: Column) -> Column:
    """Middle of a cell."""
    power = F.floor((index - 1) / STEPS)
    return F.when(index == 0, F.lit(0.0)).otherwise(unit * F.pow(F.lit(2.0), power) * (1 + (F.pmod(index - 1, F.lit(STEPS)) + 0.5) / STEPS))


def _values(metrics: DataFrame) -> DataFrame:
    """``(log_day, model, measure, value)`` of all valid measurements."""
    rows = once_per(metrics.select("metric_id", "log_day", "model", "latency_ms", "estimated_cost_usd"), "metric_id")
    cost = F.col("estimated_cost_usd")
    return rows.select("log_day", model_name(F.col("model")).alias("model"), F.explode(F.array(
        F.struct(F.lit("latency_ms").alias("measure"), F.when(F.col("latency_ms").between(1, LONGEST_MS), F.col("latency_ms").cast("double")).alias("value")),
        F.struct(F.lit("estimated_cost_usd").alias("measure"), F.when((cost >= 0) & (cost < float("inf")), cost).alias("value")),
    )).alias("m")).where("m.value is not null").select("log_day", "model", "m.*")


def _unit() -> Column:
    return F.when(F.col("measure") == "latency_ms", F.lit(MEASURES["latency_ms"])).otherwise(F.lit(MEASURES["estimated_cost_usd"]))


def measured(metrics: DataFrame) -> DataFrame:
    """``(log_day, model, measure, cell, count)`` of all valid measurements, pre-aggregated.

    Repeated rows of a metric_id count once. Nulls, NaN, infinities, negative values and a latency of
    0 or less or of more than a day are no measurements; a cost of 0 is one. Late rows belong to the day they were logged.
    """
    return _values(metrics).groupBy("log_day", "model", "measure", cell(F.col("value"), _unit()).alias("cell")).agg(F.count("*").alias("count"))


def _compress(nodes: dict[int, int], factor: int) -> dict[int, int]:
    """Sibling pairs that with their parent hold at most n / factor are pushed up into it."""
    limit = sum(nodes.values()) // factor
    if limit < 1:
        return nodes
    levels: dict[int, list[int]] = {}
    for node in nodes:
        levels.setdefault(node.bit_length(), []).append(node)
    for depth in range(max(levels), 1, -1):
        for node in {n & ~1 for n in levels.get(depth, ()) if n in nodes}:
            left, right, up = nodes.get(node, 0), nodes.get(node + 1, 0), nodes.get(node >> 1, 0)
            if 0 < left + right + up <= limit:
                nodes.pop(node, None)
                nodes.pop(node + 1, None)
                if not up:
                    levels.setdefault(depth - 1, []).append(node >> 1)
                nodes[node >> 1] = left + right + up
    return nodes


def _whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches sorted by ``keys``, cut anew so that no group is divided between two."""
    kept: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        last = np.ones(len(pdf), dtype=bool)
        for k in keys:
            last &= (pdf[k] == pdf[k].iloc[-1]).to_numpy()
        closed, open_ = pdf[~last], pdf[last]
        if len(closed) or any((kept[-1][k].iloc[-1] != open_[k].iloc[0]) for k in keys if kept):
            done = pd.concat([*kept, closed], ignore_index=True)
            kept = []
            if len(done):
                yield done
        kept.append(open_)
    if kept:
        yield pd.concat(kept, ignore_index=True)


def _compressor(keys: list[str], factor: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _whole_groups(batches, keys):
            small = pdf.groupby(keys, sort=False)["count"].transform("sum").to_numpy() < factor
            yield pdf[small]  # digests of fewer values than the factor can't be compressed
            for key, part in pdf[~small].groupby(keys, sort=False):
                nodes = _compress(dict(zip(part["node"].tolist(), part["count"].tolist())), factor)
                out = pd.DataFrame({"node": list(nodes), "count": list(nodes.values())}, dtype="int64")
                for k, v in zip(keys, key):
                    out[k] = v
                yield out[[*keys, "node", "count"]]

    return run


def compressed(nodes: DataFrame, keys: list[str], factor: int = FACTOR) -> DataFrame:
    """Adds up equal nodes of each digest and compresses it. One digest has at most 2**(LEVELS+1)
    nodes whatever it summarizes, which bounds the group of a task."""
    summed = nodes.groupBy(*keys, "node").agg(F.sum("count").alias("count"))
    schema = ", ".join(f"`{k}` string" for k in keys) + ", node long, count long"
    together = summed.repartition(*keys).sortWithinPartitions(*keys)
    return together.mapInPandas(_compressor(keys, factor), schema)


def daily_digests(metrics: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``(log_day, model, measure, node, count)``: one digest per day, model and measure, to be stored
    and combined later. A null log_day is a day of its own."""
    leaves = measured(metrics).select(F.coalesce("log_day", F.lit("")).alias("log_day"), "model", "measure", (F.col("cell") + 2**LEVELS).cast("long").alias("node"), "count")
    return compressed(leaves, ["log_day", "model", "measure"], factor)


def merged(digests: DataFrame, keys: list[str], factor: int = FACTOR) -> DataFrame:
    """Digests combined per ``keys`` by addition of equal nodes."""
    return compressed(digests, keys, factor)


def _reader(keys: list[str], percents: list[float], factor: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        top = 2**LEVELS
        rows = []
        for node, count in zip(pdf["node"].tolist(), pdf["count"].tolist()):
            shift = LEVELS + 1 - node.bit_length()
            rows.append((((node + 1) << shift) - 1 - top, -shift, count))  # last cell, small nodes first
        rows.sort(key=lambda r: (r[0], -r[1]))
        n = sum(r[2] for r in rows)
        out, seen, k = [], 0, 0
        for p in sorted(percents):
            target = max(1, -(-n * p // 100))
            while k < len(rows) - 1 and seen + rows[k][2] < target:
                seen += rows[k][2]
                k += 1
            out.append((float(p), int(n), rows[k][0], float(LEVELS / factor)))
        res = pd.DataFrame(out, columns=["percent", "n", "cell", "rank_error"])
        for key in keys:
            res[key] = pdf[key].iloc[0]
        return res[[*keys, "percent", "n", "cell", "rank_error"]]

    return run


def read_percentiles(digests: DataFrame, keys: list[str], percents: list[float] = PERCENTS, factor: int = FACTOR) -> DataFrame:
    """``keys, percent, n, value, rank_error, value_error`` from merged digests.

    value lies within value_error (relative) of a value whose rank differs from the wanted one by at
    most rank_error * n. No digests give no rows.
    """
    schema = ", ".join(f"`{k}` string" for k in keys) + ", percent double, n long, cell int, rank_error double"
    rows = digests.groupBy(*keys).applyInPandas(_reader(keys, percents, factor), schema)
    return rows.select(*keys, "percent", "n", cell_value(F.col("cell"), _unit()).alias("value"), "rank_error", F.lit(1 / STEPS).alias("value_error"))


def model_percentiles(metrics: DataFrame, percents: list[float] = PERCENTS, factor: int = FACTOR) -> DataFrame:
    """Percentiles of latency and cost per model, from digests per day that are then combined."""
    keys = ["model", "measure"]
    return read_percentiles(merged(daily_digests(metrics, factor), keys, factor), keys, percents, factor)


def checked(metrics: DataFrame) -> DataFrame:
    """``(model, measure, percent, n, within)``: whether each percentile keeps its stated errors, by exact ranks."""
    keys = ["model", "measure"]
    values = _values(metrics).groupBy(*keys, "value").agg(F.count("*").alias("count")).withColumnRenamed("value", "v")
    margin = F.col("value") * 2 * F.col("value_error")
    ranked = values.join(model_percentiles(metrics), keys).groupBy(*keys, "percent", "n", "rank_error").agg(
        F.sum(F.when(F.col("v") < F.col("value") - margin, F.col("count")).otherwise(0)).alias("below"), F.sum(F.when(F.col("v") <= F.col("value") + margin, F.col("count")).otherwise(0)).alias("up_to"))
    wanted, slack = F.greatest(F.ceil(F.col("n") * F.col("percent") / 100), F.lit(1)), F.col("n") * F.col("rank_error") + 1
    return ranked.select(*keys, "percent", "n", ((F.col("below") <= wanted + slack) & (F.col("up_to") >= wanted - slack)).alias("within"))
