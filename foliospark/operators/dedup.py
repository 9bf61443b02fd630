"""Exact and near duplicates of earlier accepted pairs, by sequence similarity."""

from __future__ import annotations

import difflib
import functools
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.sources.tables import cut, cut_clean, join_hot

#: Rows of one side of a block of comparisons; a block costs at most CHUNK * CHUNK cheap tests.
CHUNK = 20_000
#: Rows of one side of a product of matrices, and cells that a text's trigrams are counted in.
STRIP, CELLS = 1024, 640


def exact_duplicates(pairs: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``duplicate``: whether a row earlier in ``order`` has the same signature.

    A signature, named by 128 bits, has its first row found by a combined minimum, and only signatures of several rows are joined
    back, hot ones dealt out, so copies of one signature meet in no single task. Rows that agree in the whole order are
    one row to it; null signatures are never duplicates.
    """
    keyed = pairs.withColumn("_key", F.md5("signature"))
    first = keyed.where("_key is not null").groupBy("_key").agg(F.min(F.struct(*order)).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return join_hot(keyed, first, "_key", order[-1], "left").withColumn("duplicate", F.coalesce(F.struct(*order) > F.col("_first"), F.lit(False))).drop("_first", "_key")


def similarity(a: str, b: str) -> float:
    """Share of matching blocks (Ratcliff and Obershelp); ``a`` is the newer text. It isn't symmetric."""
    return difflib.SequenceMatcher(a=a, b=b).ratio()


def _common(a: str, b: str, need: int) -> bool:
    """Whether the longest common subsequence has ``need`` characters or more; ends as soon as it can't."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    mask = row = (1 << len(a)) - 1
    for k, c in enumerate(b):
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & mask
        if k % 32 == 31:
            have = len(a) - row.bit_count()
            if have >= need:
                return True
            if have + len(b) - k - 1 < need:
                return False
    return len(a) - row.bit_count() >= need


def is_similar(a: str, b: str, threshold: float) -> bool:
    """``similarity(a, b) >= threshold``, by upper bounds first: lengths, characters in common, longest common subsequence."""
    if a == b:
        return True
    both = len(a) + len(b)
    need = threshold * both / 2 - 1e-9
    if min(len(a), len(b)) < need:
        return False
    return _common(a, b, math.ceil(need)) and similarity(a, b) >= threshold


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, characters one after another, and the row of each."""
    size = np.array([len(s) for s in texts], dtype=np.int64)
    return size, np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), np.repeat(np.arange(len(texts)), size)


def _trigrams(chars: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-bit names of all runs of three characters inside a text, and the row of each."""
    inside = row[2:] == row[:-2]
    name = chars[:-2] * np.uint32(0x9E3779B1) + chars[1:-1] * np.uint32(0x85EBCA77) + chars[2:] * np.uint32(0xC2B2AE3D)
    return ((name * np.uint32(0x27D4EB2F)) >> np.uint32(16))[inside].astype(np.int64), row[2:][inside]


def _fold(texts: list[str]) -> np.ndarray:
    """The cell of each trigram's name, so that all cells hold about as many trigrams. Any cells give the same pairs in the end;
    even ones exclude most, and some of the texts are enough to know what is frequent."""
    _, chars, row = _codes(texts[:: len(texts) // (2 * STRIP) + 1])
    names = np.bincount(_trigrams(chars, row)[0], minlength=1 << 16)
    cell = (np.arange(1 << 16) * 2654435761 % (1 << 16)) * CELLS >> 16
    cells = [(0, k) for k in range(CELLS)]
    for name in np.argsort(-names, kind="stable")[: 8 * CELLS]:
        held, k = heapq.heappop(cells)
        cell[name] = k
        heapq.heappush(cells, (held + int(names[name]), k))
    return cell


def _blocks(size: np.ndarray, chars: np.ndarray, row: np.ndarray, threshold: float) -> np.ndarray:
    """For each text the most matching blocks that it can have with any text that is similar to it, if it is the older one.

    Between two blocks a character is unmatched. In an older text of 200 characters or more the matcher starts blocks only at
    characters that are rare there (of at most 1 % and one more), so each block holds one, but for one at the start of both texts.
    """
    most = (2 / threshold - 2) * size + 1
    if len(chars):
        have = np.bincount(chars) > 0
        kinds = int(have.sum())
        kind = row * kinds + (np.cumsum(have) - 1)[chars]
        if kinds <= 4096:
            n = np.bincount(kind)
            seen = np.flatnonzero(n)
            n = n[seen]
        else:
            seen, n = np.unique(kind, return_counts=True)
        of = seen // kinds
        rare = np.bincount(of, weights=np.where(n <= size[of] // 100 + 1, n, 0), minlength=len(size))
        most = np.where(size >= 200, np.minimum(most, rare + 1), most)
    return most.astype(np.float32)


class _Sketches:
    """What the bounds need of texts: lengths, blocks, characters in 64 cells, and square roots of trigrams in CELLS cells."""

    def __init__(self, texts: list[str], cell: np.ndarray, threshold: float):
        self.size, chars, row = _codes(texts)
        self.blocks = _blocks(self.size, chars, row, threshold)
        n = len(texts)
        self.letters = np.bincount(row * 64 + (chars & np.uint32(63)), minlength=n * 64).reshape(n, 64).astype(np.int32)
        name, of = _trigrams(chars, row)
        # two more cells make the product of two texts the trigrams in common less half the length that has to match
        self.cells = np.ones((n, CELLS + 2), dtype=np.float32)
        self.cells[:, CELLS + 1] = -threshold / 2 * (1 - 2e-4) * self.size  # sums in single precision are off by less than the last factor
        self.cells[:, :CELLS] = np.sqrt(np.bincount(of * CELLS + cell[name], minlength=n * CELLS).reshape(n, CELLS))

    def turned(self) -> np.ndarray:
        """The cells as the other side of a product: the last two change places."""
        cells = self.cells.copy()
        cells[:, CELLS:] = self.cells[:, : CELLS - 1 : -1]
        return cells


def _pairs(left: list[str], right: list[str] | None, threshold: float) -> Iterator[tuple[int, int]]:
    """Places of texts of ``left`` and of ``right`` (without: of ``left``, the first before the second) that no bound excludes.

    A pair is similar if its blocks have M >= threshold * (n + m) / 2 characters. K blocks have M - 2 K trigrams or more in
    common. For x and y of a trigram in two texts min(x, y) <= sqrt(x y), so products of matrices bound those in common. Both
    lists are sorted by length.
    """
    cell = _fold(left + (right or []))
    old = [(k, _Sketches((right or left)[k : k + STRIP], cell, threshold)) for k in range(0, len(right or left), STRIP)]
    for i in range(0, len(left), STRIP):
        x = old[i // STRIP][1] if right is None else _Sketches(left[i : i + STRIP], cell, threshold)
        turned = x.turned()
        for j, y in old:
            need = threshold / 2 * (x.size[[0, -1]] + y.size[[-1, 0]]) - 1e-6
            if right is None and j < i or y.size[-1] < need[0] or x.size[-1] < need[1]:
                continue
            common = turned @ y.cells.T
            slack = np.maximum(x.blocks[:, None], y.blocks[None])
            slack *= -2
            slack -= 0.05
            at = np.flatnonzero(common >= slack)
            for k in range(0, len(at), 1 << 14):
                p, q = np.divmod(at[k : k + (1 << 14)], len(y.size))
                if right is None and i == j:
                    p, q = p[p < q], q[p < q]
                both = x.size[p] + y.size[q]
                need = threshold * both / 2 - 1e-6
                ok = (np.minimum(x.size[p], y.size[q]) >= need) & (np.minimum(x.letters[p], y.letters[q]).sum(1) >= need)
                p, q, need, both = p[ok], q[ok], need[ok], both[ok]
                most = np.minimum(np.maximum(x.blocks[p], y.blocks[q]), both - 2 * need + 1)
                ok = np.square(np.minimum(x.cells[p, :CELLS], y.cells[q, :CELLS])).sum(1) >= (need - 2 * most) * (1 - 2e-4) - 0.05
                yield from zip((p[ok] + i).tolist(), (q[ok] + j).tolist())


def _compare(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(n=rows["signature"].str.len()).sort_values("n", kind="stable")
        own, other = (rows[rows["side"] == side] for side in (0, 1))
        pos, texts = own["pos"].tolist(), own["signature"].tolist()
        before, old = (other["pos"].tolist(), other["signature"].tolist()) if len(other) else (pos, texts)
        out = []
        for i, j in _pairs(texts, old if len(other) else None, threshold):
            for p, s, q, t in ((pos[i], texts[i], before[j], old[j]), (before[j], old[j], pos[i], texts[i])):
                if is_similar(s, t, threshold):
                    out.append((p, q))
        return pd.DataFrame(out, columns=["pos", "earlier"])

    return run


def similar_pairs(texts: DataFrame, threshold: float, chunk: int = CHUNK) -> DataFrame:
    """``(pos, earlier)`` of all pairs of ``texts`` (pos, signature) that are similar if the text of ``earlier`` is the older one;
    similarity isn't symmetric, so each pair is tried both ways.

    The comparison is a theta join that no hash serves, as similarity counts characters: texts are dealt by length into chunks
    of at most about ``chunk``, and each two chunks whose lengths allow it meet, in one task. Rounds of meetings bound what is
    shuffled at once. Equal signatures should be taken out before.
    """
    step = F.floor(F.log(F.length("signature") + 1) * 200).cast("int")  # 0.5 %: some thousand steps at most
    sized = cut_clean(texts.withColumn("step", step).withColumn("_deal", F.pmod(F.xxhash64("pos"), F.lit(1 << 30)) / (1 << 30)))
    counts = sorted(tuple(r) for r in sized.groupBy("step").agg(F.count("*"), F.min(F.length("signature")), F.max(F.length("signature"))).collect())
    size = max(1, min(chunk, math.ceil(sum(n for _, n, _, _ in counts) / 6)))
    starts, lengths, at = [], {}, 0
    for k, n, low, high in counts:
        starts.append((k, at, n))
        for c in range(at // size, (at + n - 1) // size + 1):
            lengths[c] = (min(low, lengths.get(c, (low, high))[0]), max(high, lengths.get(c, (low, high))[1]))
        at += n
    near = [(a, b) for a in lengths for b in range(a, len(lengths)) if lengths[a][1] >= threshold / 2 * (lengths[a][1] + lengths[b][0]) - 1e-6]
    spark, found = texts.sparkSession, []
    spark.sparkContext.environment["OPENBLAS_NUM_THREADS"] = "1"  # tasks use the cores; Spark lets each product have all of an executor's
    begun = F.broadcast(spark.createDataFrame(starts, "step int, start long, n long"))  # a row per step of length
    dealt = sized.join(begun, "step").withColumn("c", F.floor((F.col("start") + F.floor(F.col("_deal") * F.col("n"))) / size).cast("int")).select("c", "pos", "signature")
    most = 3 * max(1, len(lengths))  # meetings of a round: texts are copied six times at most
    for k in range(0, len(near), most):
        meets = [(c, block, side) for block, (a, b) in enumerate(near[k : k + most]) for c, side in ((a, 0), (b, 1))[: 1 + (a != b)]]
        sent = dealt.join(F.broadcast(spark.createDataFrame(meets, "c int, block int, side int")), "c").select("block", "side", "pos", "signature")
        found.append(cut_clean(sent.repartition(3 * min(most, len(near) - k), "block").groupBy("block").applyInPandas(_compare(threshold), "pos long, earlier long")))
    return functools.reduce(DataFrame.unionAll, found) if found else texts.select("pos", F.col("pos").alias("earlier")).limit(0)


def greedy_duplicates(pairs: DataFrame, order: list[str], unit: list[str], threshold: float = 0.9, max_rounds: int = 50) -> DataFrame:
    """Adds ``duplicate`` and ``kept`` to pairs (signature, passes): as if rows were taken in ``order`` and each was compared
    with the rows accepted before.

    A row is a duplicate if a row of an earlier unit (a page, say) was accepted and is equal or similar to it; it is
    kept if it passes and isn't a duplicate. Rows of the same unit don't see each other. All links are found at
    once, then decided in rounds: a row is decided when its earlier neighbours that pass are. Rounds are
    checkpointed. Null signatures are never duplicates.
    """
    spot = F.struct(*order)
    # after a global sort the ids of partitions and rows increase in order; sorting reads its input twice
    judged = cut_clean(pairs.withColumn("_spot", spot))
    rows = cut_clean(judged.orderBy("_spot").withColumn("pos", F.monotonically_increasing_id()).withColumn("_key", F.md5("signature")))
    first = cut_clean(rows.where("_key is not null").groupBy("_key").agg(F.min("pos").alias("pos")))
    alike = similar_pairs(rows.join(first.select("pos"), "pos", "left_semi").select("pos", "signature"), threshold)
    links = cut(alike.unionAll(first.select("pos", F.col("pos").alias("earlier"))))  # new signature, earlier signature
    ids = cut_clean(rows.join(first.select("_key", F.col("pos").alias("sid")), "_key").select("pos", "sid", "passes", F.struct(*unit).alias("u")))
    old = ids.where("passes").select(F.col("sid").alias("earlier"), F.col("pos").alias("q"), F.col("u").alias("v"))
    edges = cut(ids.join(links.select(F.col("pos").alias("sid"), "earlier"), "sid").join(old, "earlier").where((F.col("q") < F.col("pos")) & (F.col("u") != F.col("v"))).select("pos", "q").distinct())
    state = cut(rows.select("pos", "passes").join(edges.select("pos").distinct().withColumn("_e", F.lit(True)), "pos", "left").select(
        "pos", "passes", F.when(F.col("_e").isNull(), F.lit(False)).alias("duplicate")))
    for _ in range(max_rounds):
        if state.where("duplicate is null").isEmpty():
            break
        known = edges.join(state.select(F.col("pos").alias("q"), F.col("duplicate").alias("_d")), "q")
        verdict = known.groupBy("pos").agg(F.max(F.col("_d") == F.lit(False)).alias("hit"), F.count_if(F.col("_d").isNull()).alias("open"))
        state = cut(state.join(verdict, "pos", "left").select("pos", "passes", F.coalesce("duplicate", F.when(F.coalesce("hit", F.lit(False)), True).when(F.col("open") == 0, False)).alias("duplicate")))
    else:
        raise RuntimeError("duplicates are still undecided")
    return rows.join(state.select("pos", "duplicate"), "pos").withColumn("kept", F.col("passes") & ~F.col("duplicate")).drop("pos", "_spot", "_key")

