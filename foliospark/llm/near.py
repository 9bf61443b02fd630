"""Records that repeat each other with small changes.

One-permutation hashing with optimal densification makes a signature of each record, and bands of it are
buckets. Records that share a bucket are compared by sketches where the bucket lies, in memory: only pairs that may be
similar leave the task, and these are checked exactly. Edges to one centre of a bucket (a star) would bound
the comparisons, but lose the links of copies that resemble each other or their origin, not the centre.

Buckets are dealt out in parts, some bands in each round, and a task compares the buckets of a part. One that is too
large for a task, as of copies that are a third of all rows, passes through it and is compared in blocks of two
times BLOCK records at most.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.graph import components
from foliospark.sources.tables import cut, cut_clean, join_hot, message, spread

THRESHOLD = 0.8
LEAST_WORDS = 45
#: Buckets that two records at the threshold share on average: none with a probability of exp(-MEETINGS), which is 1 in 2,700.
MEETINGS = 7.9
#: Rows of a band: such that of records with a share of CHANCE of their words in common at most CHANCE_MEMBERS meet in a bucket.
CHANCE, CHANCE_MEMBERS, LEAST_ROWS = 0.2, 1700, 4
#: Records of one side of a block of comparisons.
BLOCK = 2000
#: Signatures are POOLS times BINS bytes; a band takes some of them, and no byte is taken again before all were.
POOLS, BINS = 6, 64
#: A bucket is named by the 64 - SHIFT upper bits of a number; the others number the rows of a batch.
SHIFT = 24
#: Bytes that are dealt out in a round: so many for each word, or ROUND in all if that is more. Rows of a part, and bytes of a batch of parts.
ROUND_PER_WORD, ROUND, PART, DEALT = 6, 1 << 29, 500_000, 1 << 25
#: Rows that a task holds before it looks for buckets that are too large, which are those of over WHOLE blocks; buckets up to TINY are
#: compared together, others by tiles.
HELD, TINY, TILE, WHOLE = 2_000_000, 12, 128, 8
#: A sketch has BITS bits for records of up to WORDS words, twice as many for up to twice as many words, and so on, at most LEVELS times.
BITS, WORDS, LEVELS = 256, 100, 5
#: Values (words and bins) of records that are signed at a time.
AT_ONCE = 3_000_000
#: Bytes of texts that are split into words at a time.
TEXT = 300_000
_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)]


def band_shape(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """``(bands, rows)`` for n records: rows grow with the logarithm of n, and bands with them, so that similar records meet
    as surely in any collection, and unlike ones no more often."""
    jaccard = threshold / (2 - threshold)
    rows = max(LEAST_ROWS, math.ceil(math.log(max(n, 1) / CHANCE_MEMBERS) / math.log(1 / CHANCE)))
    return math.ceil(MEETINGS / jaccard**rows), rows


def drawn_bands(bands: int, rows: int) -> tuple[int, int]:
    """Bands of signatures whose bytes serve several bands: a tenth more for each row beyond five, so that similar records miss each other
    no more often than if each band had bytes of its own."""
    return bands + math.ceil(bands * max(0, rows - 5) / 10), rows


def record_text(messages: str = "messages") -> Column:
    """Text of a record: user content, a space, assistant content, lower-cased."""
    return F.lower(F.concat_ws(" ", F.coalesce(message("user", messages), F.lit("")), F.coalesce(message("assistant", messages), F.lit(""))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


#: White space in UTF-8: of one byte, and as it begins and goes on (U+0085, A0, 1680, 2000 to 200A, 2028, 2029, 202F, 205F, 3000).
_BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_LONG_BLANKS = [bytes(c, "utf-8") for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))]
_LEADS = np.isin(np.arange(256), [c[0] for c in _LONG_BLANKS])
#: A word is a polynomial of its bytes' numbers, in an odd number that is 3 modulo 4.
_BYTES = np.random.default_rng(12).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C17


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n, x, dtype=np.uint64)]) for x in (_BASE, pow(_BASE, -1, 1 << 64)))


def _split(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of texts end to end, and how many each text has; ends: where each text begins and the last ends."""
    blank = _BLANK[data]
    lead = np.flatnonzero(_LEADS[data])
    if len(lead):
        more = np.r_[data, np.zeros(2, np.uint8)]
        for c in _LONG_BLANKS:
            at = lead[np.logical_and.reduce([more[lead + k] == x for k, x in enumerate(c)])]
            for k in range(len(c) if len(at) else 0):
                blank[at + k] = True
    cut_here = np.zeros(len(data) + 1, dtype=bool)
    cut_here[ends] = True
    begin = np.flatnonzero(~blank & (np.r_[True, blank[:-1]] | cut_here[:-1]))
    end = np.flatnonzero(~blank & (np.r_[blank[1:], True] | cut_here[1:])) + 1
    power, back = _powers(max(TEXT, 1 << len(data).bit_length()) if len(data) > TEXT else TEXT)
    sums = np.r_[np.uint64(0), np.cumsum(_BYTES[data] * power[: len(data)])]
    return _mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64)), np.diff(np.searchsorted(begin, ends))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of texts (without nulls), split at white space, as 64-bit hashes end to end, and how many each text has."""
    starts, data = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64), texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    with np.errstate(over="ignore"):
        parts = [_split(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]) for a, b in _chunks(np.diff(starts), TEXT)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def elements(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for the k-th occurrence of each (hashed) word in its record, and the record, in order of records: two
    records have as many numbers in common as words, a repeated word counted as often as both have it."""
    order = np.lexsort((words, owner))
    words, owner = words[order], owner[order]
    run = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])])
    nth = np.arange(len(words)) - np.repeat(run, np.diff(np.r_[run, len(words)]))
    return _mix(words + nth.astype(np.uint64) * _MIX[2]), owner


def quick_elements(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``elements``, by 40 bits of each word: as many numbers in common or more, for signatures and sketches. Fewer than 2^24 records."""
    order = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24)))
    run = np.flatnonzero(np.r_[True, order[1:] != order[:-1]])
    nth = np.arange(len(order)) - np.repeat(run, np.diff(np.r_[run, len(order)]))
    return _mix((order & np.uint64((1 << 40) - 1)) + nth.astype(np.uint64) * _MIX[2]), (order >> np.uint64(40)).astype(np.int64)


def binned(element: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Signatures (n x POOLS * BINS bytes). In each pool an element falls into a bin, and a bin keeps a byte of its least hash. Empty bins
    borrow from bins of their pool that are drawn by a hash of the bin until one isn't empty (optimal densification). No record may be empty."""
    keys = np.empty((POOLS, len(element)), dtype=np.uint64)
    for p in range(POOLS):
        h = _mix(element + np.uint64(p + 1) * _MIX[2])
        keys[p] = ((owner * POOLS + p).astype(np.uint64) * np.uint64(BINS) + (h & np.uint64(BINS - 1))) << np.uint64(32) | (h >> np.uint64(32))
    keys = np.sort(keys.ravel())
    slot = (keys >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    out, full = np.zeros(n * POOLS * BINS, dtype=np.uint8), np.zeros(n * POOLS * BINS, dtype=bool)
    out[slot[first]] = keys[first].astype(np.uint8)
    full[slot[first]] = True
    todo, tries = np.flatnonzero(~full), 0
    while len(todo):
        tries += 1
        drawn = (_mix(np.arange(POOLS * BINS, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(tries)) % np.uint64(BINS)).astype(np.int64)
        place = todo % (POOLS * BINS)
        source = todo - place % BINS + drawn[place]
        found = full[source]
        out[todo[found]] = out[source[found]]
        todo = todo[~found]
    return out.reshape(n, POOLS * BINS)


def picked(bands: int, rows: int) -> np.ndarray:
    """Which bytes of a signature a band takes (bands x rows): all bytes in one order after another."""
    rng, size = np.random.default_rng(11), POOLS * BINS
    per = size // rows
    return np.concatenate([rng.permutation(size)[: per * rows].reshape(per, rows) for _ in range(-(-bands // per))])[:bands]


def buckets(signatures: np.ndarray, places: np.ndarray, band: int) -> np.ndarray:
    """Buckets of one band, given signatures by byte (POOLS * BINS x n)."""
    out = np.zeros(signatures.shape[1], dtype=np.uint64)
    for k, place in enumerate(places):
        if k and k % 8 == 0:
            out = _mix(out)
        out = (out << np.uint64(8)) ^ signatures[place]
    return _mix(_mix(out) + np.uint64(band + 1) * _MIX[0])


def levels(n: np.ndarray) -> np.ndarray:
    """How many times the sketch of a record of n words is doubled."""
    return np.clip(np.ceil(np.log2(np.maximum(n, 1) / WORDS)), 0, LEVELS).astype(np.int64)


def sketches(element: np.ndarray, owner: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sketches end to end as numbers of 64 bits, and where each begins. A bit is turned over by each element that falls on it, so two
    records differ in no more bits than there are elements that only one of them has. The halves of a sketch, laid over each
    other, are the sketch of half as many bits."""
    bits = BITS << level
    at = np.r_[0, np.cumsum(bits)]
    hits = np.bincount(at[owner] + (_mix(element + _MIX[0]) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64), minlength=at[-1])
    return np.packbits((hits & 1).astype(np.uint8), bitorder="little").view(np.uint64), at // 64


def _chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most)))
        yield a, b
        a = b


def _values(column: pa.Array, kind: type) -> np.ndarray:
    """Values of a binary column end to end; nulls have none."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8)[ends[column.offset] : ends[column.offset + len(column)]].view(kind) if data else np.zeros(0, kind)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values from numbers; ends: where each begins and the last ends, in numbers."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


_SIGNED = "record_id long, k1 long, k2 long, n int, sketch binary, signature binary"


def _sign(least_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per record of at least so many words: a fingerprint of its words in any order (k1, k2), their number, sketches and signature. Of
    records with the same words in a batch, only the least keeps sketches and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                if batch.num_rows:
                    words, sizes = split_words(batch["text"])
                    long = sizes >= least_words
                    yield from signed(batch["record_id"].to_numpy()[long], words[np.repeat(long, sizes)], sizes[long])

    def signed(record_id: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.r_[0, np.cumsum(sizes)]
        for a, b in _chunks(sizes * POOLS + BITS, AT_ONCE):
            own, n, first = words[starts[a] : starts[b]], b - a, starts[a:b] - starts[a]
            rec = record_id[a:b]
            k1, k2 = (np.add.reduceat(_mix(_mix(own ^ m)), first) for m in _MIX[:2])
            order = np.lexsort((rec, k2, k1))
            lead = order[np.r_[True, (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])]]
            lead.sort()
            kept = np.zeros(n, dtype=bool)
            kept[lead] = True
            size = sizes[a:b][kept]
            element, owner = quick_elements(own[np.repeat(kept, sizes[a:b])], np.repeat(np.arange(len(lead)), size))
            sketch, at = sketches(element, owner, levels(size))
            place = np.where(kept, np.cumsum(kept) - 1, -1)
            yield pa.RecordBatch.from_pydict({
                "record_id": pa.array(rec),
                "k1": pa.array(k1.view(np.int64)),
                "k2": pa.array(k2.view(np.int64)),
                "n": pa.array(sizes[a:b].astype(np.int32)),
                "sketch": _binary(sketch, at).take(pa.array(place, mask=~kept)),
                "signature": _binary(binned(element, owner, len(lead)).ravel(), np.arange(len(lead) + 1) * POOLS * BINS).take(pa.array(place, mask=~kept)),
            })

    return run


_CLASSED = "record_id long, rep long, n int, sketch binary, signature binary"


def _class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (k1, k2, record_id), once each, with the least record_id of their class; only that record keeps sketches and signature."""
    before = None  # k1, k2, record_id of the last row, and its class
    for batch in batches:
        if not batch.num_rows:
            continue
        k1, k2, rec = (batch[c].to_numpy() for c in ("k1", "k2", "record_id"))
        new = np.r_[before is None or (k1[0], k2[0]) != before[:2], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]
        again = ~new & np.r_[before is not None and rec[0] == before[2], rec[1:] == rec[:-1]]
        at = np.maximum.accumulate(np.where(new, np.arange(len(rec)), -1))
        rep = np.where(at < 0, before[3] if before else 0, rec[at])
        before = (k1[-1], k2[-1], rec[-1], rep[-1])
        once = np.flatnonzero(~again)
        place = pa.array(once, mask=~new[once])
        yield pa.RecordBatch.from_pydict({"record_id": pa.array(rec[once]), "rep": pa.array(rep[once]), "n": batch["n"].take(pa.array(once)), "sketch": batch["sketch"].take(place), "signature": batch["signature"].take(place)})


class _Side:
    """Records as they are compared: bucket, rec, number of words, and where in ``bits`` (numbers of 64 bits) the sketch begins."""

    def __init__(self, bucket: np.ndarray, rec: np.ndarray, n: np.ndarray, bits: np.ndarray, start: np.ndarray):
        self.bucket, self.rec, self.n, self.bits, self.start = bucket, rec, n.astype(np.int32), bits, start
        self._at_level: dict[int, np.ndarray] = {}
        self.level = levels(self.n)

    @staticmethod
    def of(bucket: np.ndarray, rec: np.ndarray, n: np.ndarray, sketch: pa.Array) -> "_Side":
        ends = np.frombuffer(sketch.buffers()[1], dtype=np.int32)[sketch.offset : sketch.offset + len(sketch) + 1] // 8
        data = sketch.buffers()[2]
        return _Side(bucket, rec, n, np.frombuffer(data, dtype=np.uint64) if data else np.zeros(0, np.uint64), ends[:-1].astype(np.int64))

    @staticmethod
    def dealt(batch: pa.RecordBatch) -> "_Side":
        n = _values(batch["n"], np.int32)
        width = (BITS << levels(n)) // 64
        return _Side(_values(batch["keys"], np.uint64) >> np.uint64(SHIFT), _values(batch["rec"], np.int64), n, _values(batch["bits"], np.uint64), np.cumsum(width) - width)

    @staticmethod
    def together(sides: list["_Side"]) -> "_Side":
        shift = np.cumsum([0, *(len(x.bits) for x in sides)])
        return _Side(*(np.concatenate([getattr(x, c) for x in sides]) for c in ("bucket", "rec", "n", "bits")), np.concatenate([x.start + k for x, k in zip(sides, shift)])) if len(sides) != 1 else sides[0]

    def __getitem__(self, k: np.ndarray) -> "_Side":
        return _Side(self.bucket[k], self.rec[k], self.n[k], self.bits, self.start[k])

    def __len__(self) -> int:
        return len(self.rec)

    def _packed(self) -> tuple[np.ndarray, np.ndarray]:
        """Sketches without what other records left between them."""
        least = BITS // 64
        width = 1 << self.level  # in least sketches
        start = np.cumsum(width) - width
        places = self.start // least if not self.level.any() else np.repeat(self.start // least - start, width) + np.arange(width.sum())
        return np.take(self.bits.reshape(-1, least), places, axis=0).ravel(), start * least

    def sketches(self) -> pa.Array:
        bits, start = self._packed()
        return pa.Array.from_buffers(pa.binary(), len(self), [None, pa.py_buffer((np.r_[start, len(bits)] * 8).astype(np.int32)), pa.py_buffer(bits)])

    def at_level(self, level: int) -> np.ndarray:
        """Sketches of BITS << level bits, a row for each 64 bits and a column for each record; those of lower levels are empty."""
        if level not in self._at_level:
            width = (BITS << level) // 64
            out = np.zeros((width, len(self)), dtype=np.uint64)
            for own in range(level, LEVELS + 1):
                mine = np.flatnonzero(self.level == own)
                if len(mine):
                    for k in range(width):  # what is laid over each other
                        for part in range(k, width << (own - level), width):
                            out[k, mine] ^= self.bits[self.start[mine] + part]
            self._at_level[level] = out
        return self._at_level[level]


def may_be_similar(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (i of a, j of b) which lengths and sketches allow to be similar.

    Lengths never exclude a similar pair. Sketches exclude one if they differ in more bits than elements may, or by six standard
    deviations more than expected of so many elements (which is less only for records of thousands of words).
    """
    # half a sketch excludes most pairs
    x, y = a.at_level(0), b.at_level(0)
    half = np.bitwise_count(x[0][i] ^ y[0][j]).astype(np.int32) + np.bitwise_count(x[1][i] ^ y[1][j])
    keep = half <= (1 - threshold) * (a.n[i] + b.n[j]) + 1e-6
    i, j = i[keep], j[keep]
    total = a.n[i] + b.n[j]
    keep = 2 * np.minimum(a.n[i], b.n[j]) >= threshold * total - 1e-6
    i, j = i[keep], j[keep]
    alone = (1 - threshold) * total[keep] + 1e-6  # elements that only one of two similar records has
    for level in range(LEVELS + 1):
        both = np.minimum(a.level[i], b.level[j]) >= level
        if not both.any():
            break
        bits = BITS << level
        most = np.minimum(alone, bits / 2 * -np.expm1(-2 * alone / bits) + 3 * math.sqrt(bits))
        most[~both] = bits
        x, y = a.at_level(level), b.at_level(level)
        differ = np.zeros(len(i), dtype=np.int64)
        for k in range(len(x)):
            differ += np.bitwise_count(x[k][i] ^ y[k][j])
            if k % 4 == 3:
                keep = differ <= most
                i, j, alone, most, differ = i[keep], j[keep], alone[keep], most[keep], differ[keep]
    return i, j


class _Candidates:
    """Pairs that half a sketch allows, from tiles of comparisons, and those of them that may be similar."""

    def __init__(self, left: _Side, right: _Side, threshold: float):
        self.sides, self.threshold = (left, right), threshold
        self.x, self.y = left.at_level(0), right.at_level(0)
        self.room_x, self.room_y = (((1 - threshold) * s.n + 0.01).astype(np.float32) for s in (left, right))
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0

    def pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        half = np.bitwise_count(self.x[0][i] ^ self.y[0][j]) + np.bitwise_count(self.x[1][i] ^ self.y[1][j])
        self._hold(*(k[half <= self.room_x[i] + self.room_y[j]] for k in (i, j)))

    def tile(self, a: int, b: int, c: int, d: int) -> None:
        """Rows a to b of the left side with rows c to d of the right one."""
        half = np.bitwise_count(self.x[0][a:b, None] ^ self.y[0][None, c:d])
        half += np.bitwise_count(self.x[1][a:b, None] ^ self.y[1][None, c:d])
        i, j = np.nonzero(half <= self.room_x[a:b, None] + self.room_y[None, c:d])
        i, j = i + a, j + c
        if self.sides[0] is self.sides[1]:
            i, j = i[i < j], j[i < j]
        self._hold(i, j)

    def _hold(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            whole = sum(np.bitwise_count(x[i] ^ y[j]).astype(np.int32) for x, y in zip(self.x, self.y))
            keep = whole <= self.room_x[i] + self.room_y[j]
            self.held.append((i[keep], j[keep]))
            self.n += len(self.held[-1][0])

    def found(self, at_least: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Records of pairs that may be similar, as soon as so many pairs are held."""
        if not self.n or self.n < at_least:
            return
        i, j = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.n = [], 0
        (left, right), step = self.sides, 50_000
        for k in range(0, len(i), step):
            u, p = np.unique(i[k : k + step], return_inverse=True)
            v, q = np.unique(j[k : k + step], return_inverse=True)
            a, b = left[u], right[v]
            p, q = may_be_similar(a, b, p, q, self.threshold)
            yield a.rec[p], b.rec[q]


def _within(side: _Side, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that share a bucket and may be similar, of rows in order of buckets."""
    begin = np.flatnonzero(np.r_[True, side.bucket[1:] != side.bucket[:-1]])
    end = np.r_[begin[1:], len(side)]
    got = _Candidates(side, side, threshold)
    tiny = end - begin <= TINY
    last = np.repeat(np.where(tiny, end, 0), end - begin)
    i = np.flatnonzero(last)
    for d in range(1, TINY):
        i = i[i + d < last[i]]
        got.pairs(i, i + d)
        yield from got.found(200_000)
    for s, e in zip(begin[~tiny].tolist(), end[~tiny].tolist()):
        for a in range(s, e - 1, TILE):
            got.tile(a, min(a + TILE, e), a + 1, e)
        yield from got.found(200_000)
    yield from got.found()


def _across(left: _Side, right: _Side, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    got = _Candidates(left, right, threshold)
    for a in range(0, len(left), TILE):
        got.tile(a, min(a + TILE, len(left)), 0, len(right))
        yield from got.found(200_000)
    yield from got.found()


_MET = "bucket long, a long, b long, n int, sketch binary"
_MET_ARROW = pa.schema([("bucket", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32()), ("sketch", pa.binary())])


def _pairs_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    pairs = pd.DataFrame({"a": low[low != high], "b": high[low != high]}).drop_duplicates()
    n = len(pairs)
    return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.array(pairs["a"].to_numpy()), pa.array(pairs["b"].to_numpy()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=_MET_ARROW)


def _open_batch(side: _Side) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(side.bucket), pa.array(side.rec), pa.nulls(len(side), pa.int64()), pa.array(side.n.astype(np.int32)), side.sketches()], schema=_MET_ARROW)


_DEALT = "part int, keys binary, rec binary, n binary, bits binary"


def _deal(bands: list[int], places: np.ndarray, parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (bucket, rec, n, sketch) of some bands, by ranges of buckets: a part of them of a batch is one row, so that no row of a bucket
    is handled by itself on its way."""
    limits = np.array([-(-(p << 64) // parts) for p in range(1, parts)], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for given in batches:
                if not given.num_rows:
                    continue
                width = (BITS << levels(given["n"].to_numpy())) // 64
                for a, b in _chunks(len(bands) * (20 + 8 * width), DEALT):
                    batch = given.slice(a, b - a)
                    n = batch.num_rows
                    side = _Side.of(*(batch[c].to_numpy() for c in ("rep", "rep", "n")), batch["sketch"])
                    signatures = np.ascontiguousarray(_values(batch["signature"], np.uint8).reshape(n, POOLS * BINS).T)
                    keys = np.empty((len(bands), n), dtype=np.uint64)
                    for k, band in enumerate(bands):
                        keys[k] = buckets(signatures, places[band], band) >> np.uint64(SHIFT) << np.uint64(SHIFT) | np.arange(n, dtype=np.uint64)
                    keys = np.sort(keys.ravel())
                    rows = side[(keys & np.uint64((1 << SHIFT) - 1)).astype(np.int64)]
                    bits, start = rows._packed()
                    ends = np.r_[0, np.searchsorted(keys, limits), len(keys)]
                    full = np.flatnonzero(ends[1:] > ends[:-1])
                    ends = np.r_[ends[full], len(keys)]
                    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), _binary(keys, ends), _binary(rows.rec, ends), _binary(rows.n, ends), _binary(bits, np.r_[start, len(bits)][ends])], names=["part", "keys", "rec", "n", "bits"])

    return run


def _meet(threshold: float, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole parts of ``_deal``: pairs (a, b) that share a bucket and may be similar.

    A bucket of more than WHOLE times ``block`` records isn't compared here: its records come out as they are (b is null). They are found, and leave
    the memory, whenever many rows are held.
    """

    def ordered(side: _Side) -> tuple[_Side, np.ndarray]:
        if len(side) < 1 << SHIFT:
            order = np.sort(side.bucket << np.uint64(SHIFT) | np.arange(len(side), dtype=np.uint64)) & np.uint64((1 << SHIFT) - 1)
            order = order.astype(np.int64)
        else:
            order = np.argsort(side.bucket)
        bucket = side.bucket[order]
        begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        m = np.diff(np.r_[begin, len(bucket)])
        return side[order], np.repeat(m, m)

    def opened(side: _Side) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(side), 20_000):
            yield _open_batch(side[np.arange(k, min(k + 20_000, len(side)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, most, apart = [], 0, HELD, np.zeros(0, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for batch in batches:
                held.append(_Side.dealt(batch))
                rows += len(held[-1])
                if rows >= most:
                    side, m = ordered(_Side.together(held))
                    out = (m > WHOLE * block) | np.isin(side.bucket, apart)
                    apart = np.union1d(apart, side.bucket[out])
                    yield from opened(side[out])
                    held = [rest := side[~out]]
                    rest.bits, rest.start = rest._packed()
                    rows = len(rest)
                    most = max(HELD, 2 * rows)
            if rows:
                side, m = ordered(_Side.together(held))
                out = (m > WHOLE * block) | np.isin(side.bucket, apart)
                yield from opened(side[out])
                side = side[~out & (m > 1)]
                if len(side):
                    side.bits, side.start = side._packed()
                    for a, b in _within(side, threshold):
                        yield _pairs_batch(a, b)

    return run


def _compare(threshold: float) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """A block of comparisons: all of side 0 with all of side 1, or with each other where there is no side 1."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sides = [_Side.of(*(s[c].to_numpy() for c in ("bucket", "a", "n")), pa.array(list(s["sketch"]), pa.binary())) for s in (rows[rows["side"] == 0], rows[rows["side"] == 1])]
        if key[1] == key[2]:
            sides[1] = sides[0]
        a, b = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.int64)), *_across(*sides, threshold)))
        out = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
        return out[out["a"] != out["b"]].drop_duplicates()

    return run


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarity of pairs (a, b, nx, x, ny, y), x and y being the nx and ny hashed words."""
    with np.errstate(over="ignore"):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, y = _values(batch["x"], np.uint64), _values(batch["y"], np.uint64)
            nx, ny = batch["nx"].to_numpy(), batch["ny"].to_numpy()
            ex, ox = elements(x, np.repeat(np.arange(n), nx))
            ey, oy = elements(y, np.repeat(np.arange(n), ny))
            both, owner = np.concatenate([ex, ey]), np.concatenate([ox, oy])
            order = np.lexsort((both, owner))
            both, owner = both[order], owner[order]
            twice = (both[1:] == both[:-1]) & (owner[1:] == owner[:-1])
            common = np.bincount(owner[1:][twice], minlength=n)
            yield pa.RecordBatch.from_pydict({"a": batch["a"], "b": batch["b"], "similarity": pa.array(2 * common / (nx + ny))})


def _word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashed words of records, and their number."""
    for batch in batches:
        if batch.num_rows:
            words, sizes = split_words(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["record_id"], pa.array(sizes.astype(np.int32)), _binary(words, np.r_[0, np.cumsum(sizes)])], names=["record_id", "n", "words"])


class NearRecords:
    """Classes of equal records, and the checked links between their representatives.

    Takes records (record_id, messages); other columns are ignored. Null messages or contents are empty
    texts. Records of fewer than ``least_words`` words don't take part; repeated rows count once. Records with the same
    words in any order are a class, represented by its least record_id.

    Of a class that holds a large part of all records, only ids reach the task that names it, but for one record of each batch; it is dealt
    out where it is joined.
    """

    def __init__(self, records: DataFrame, threshold: float = THRESHOLD, least_words: int = LEAST_WORDS, block: int = BLOCK):
        self.threshold, self.block = threshold, block
        given = records.select("record_id", "messages").where("record_id is not null")
        self._texts = spread(given).select("record_id", record_text().alias("text"))
        self._shape = drawn_bands(*band_shape(given.count(), threshold))
        signed = self._texts.mapInArrow(_sign(max(least_words, 1)), _SIGNED).repartition("k1", "k2")
        classed = cut_clean(signed.sortWithinPartitions("k1", "k2", "record_id", F.isnull("sketch")).mapInArrow(_class, _CLASSED))
        self.members = classed.select("record_id", "rep")
        self.links = self._links(classed.where("sketch is not null").select("rep", "n", "sketch", "signature"))

    def _met(self, own: DataFrame) -> DataFrame:
        """Pairs and open rows of all bands, in rounds: the rows of a round are dealt out when those of the round before are gone."""
        bands, rows = self._shape
        n, words, size = own.agg(F.count("*"), F.sum("n"), F.sum(F.octet_length("sketch") + F.lit(20))).first()
        at_once = max(1, max(ROUND, ROUND_PER_WORD * (words or 0)) // max(size or 0, 1))
        rounds = min(bands, math.ceil(bands / at_once))
        places, spark = picked(bands, rows), own.sparkSession
        met = []
        for r in range(rounds):
            chosen = list(range(bands * r // rounds, bands * (r + 1) // rounds))
            parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n * len(chosen) / PART))
            dealt = own.mapInArrow(_deal(chosen, places, parts), _DEALT).repartitionById(parts, "part")
            met.append(cut_clean(dealt.mapInArrow(_meet(self.threshold, self.block), _MET)))
        return functools.reduce(DataFrame.unionAll, met)

    def _links(self, own: DataFrame) -> DataFrame:
        """``(a, b, similarity)``, a < b, of representatives that are similar enough."""
        met = self._met(own)
        pairs = met.where("b is not null").select("a", "b").unionAll(self._blocks(met.where("b is null"))).distinct()
        pairs = cut(pairs)
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("record_id")).distinct()
        once = self._texts.join(wanted, "record_id", "left_semi").dropDuplicates(["record_id"])
        texts = cut_clean(once.mapInArrow(_word, "record_id long, n int, words binary"))
        x, y = (texts.select(F.col("record_id").alias(a), F.col("n").alias(f"n{w}"), F.col("words").alias(w)) for a, w in (("a", "x"), ("b", "y")))
        checked = pairs.join(x, "a").join(y, "b").select("a", "b", "nx", "x", "ny", "y").mapInArrow(_common, "a long, b long, similarity double")
        return cut(checked.where(F.col("similarity") >= self.threshold))

    def _blocks(self, rows: DataFrame) -> DataFrame:
        """Pairs of the records of buckets that weren't compared where they lay."""
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket", F.ceil(F.col("m") / self.block).cast("int").alias("blocks"))
        dealt = rows.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
        kept = ["bucket", "i", "j", "side", "a", "n", "sketch"]
        left = dealt.select("*", F.col("block").alias("i"), F.lit(0).alias("side"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j")).select(*kept)
        right = dealt.where("block > 0").select("*", F.col("block").alias("j"), F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i")).select(*kept)
        return left.unionAll(right).groupBy("bucket", "i", "j").applyInPandas(_compare(self.threshold), "a long, b long")

    def pairs(self) -> DataFrame:
        """``(record_a, record_b)``, record_a < record_b: all similar pairs, copies included."""
        m = self.members
        a, b = m.select(F.col("record_id").alias("ra"), F.col("rep").alias("a")), m.select(F.col("record_id").alias("rb"), F.col("rep").alias("b"))
        across = self.links.select("a", "b").join(a, "a").join(b, "b").select("ra", "rb")
        within = a.join(b, F.col("a") == F.col("b")).where("ra < rb").select("ra", "rb")
        return across.unionAll(within).select(F.least("ra", "rb").alias("record_a"), F.greatest("ra", "rb").alias("record_b"))

    def groups(self) -> DataFrame:
        """``(record_id, class_id, group_id, n_links)`` of every record that takes part: the least record equal
        to it, the least record of its group, and the number of records similar to it."""
        sizes = self.members.groupBy("rep").agg(F.count("*").alias("n"))
        both = self.links.select("a", "b").unionAll(self.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        across = both.join(sizes.select(F.col("rep").alias("b"), F.col("n").alias("m")), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("m").alias("m"))
        tied = components(self.links.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "rep")
        classes = sizes.join(across, "rep", "left").join(tied, "rep", "left").select(
            "rep", F.coalesce("component", "rep").alias("group_id"), (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"))
        return join_hot(self.members, classes, "rep", "record_id").select("record_id", F.col("rep").alias("class_id"), "group_id", "n_links")
