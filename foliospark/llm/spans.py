"""Long exact spans that stand in more than one record.

1. Anchors: of every window of SPAN characters the phrase of PHRASE characters with the least hash is
   chosen (winnowing), so two rows that share a span share the phrases chosen in it.
2. Phrases chosen in two rows or more are confirmed as text and compiled, by shards, into Aho-Corasick
   automata; the rows that hold phrases of a shard are streamed through its automaton, which finds
   every occurrence.
3. Each window of SPAN characters belongs to the first phrase that occurs in it. Around each occurrence the
   text of its windows is a context; equal contexts are one, and windows of different contexts are
   compared by 128-bit fingerprints. What two rows have in common is exact to the character.

No step compares rows in pairs, and counting is combined before it is shuffled, so a passage that stands in
a third of all rows costs no more than others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.sources.tables import cut, spread

#: Code points that a shared span has at least.
SPAN = 200
PHRASE = 64
#: Characters by which the stretches that select contexts fall short of a window.
STEP = 34
#: Phrases in one automaton (about 64 nodes each), and characters that one task streams through it; a phrase in a text
#: brings the windows around it.
SHARD_PHRASES = 40_000
TASK_CHARACTERS = 4_000_000
AROUND = 2 * SPAN - PHRASE
#: Shards up to which their loads (two numbers each) are broadcast.
MOST_SHARDS = 10_000
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SEED = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
#: White space as code points, fixed by Unicode, with the separators U+001C to U+001F.
BLANKS = r"(?U)[\s\x1c-\x1f]+"


def single_spaced(text: Column) -> Column:
    """Every run of white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def texts_of(pages: DataFrame, records: DataFrame) -> DataFrame:
    """``(tbl, row_id, part, r, text)``: page texts (tbl 0), and the user and assistant messages of records (tbl 1).

    r is one number per row of either table (ids are taken to lie within 62 bits). Texts are single-spaced; part counts the
    texts of a row. Null texts and rows without an id are left out.
    """
    page = pages.select(F.lit(0).alias("tbl"), F.col("artifact_id").alias("row_id"), F.lit(0).alias("part"), F.col("page_text").alias("text"))
    said = records.select(F.lit(1).alias("tbl"), F.col("record_id").alias("row_id"), F.posexplode("messages").alias("part", "m")).where(F.col("m.role").isin("user", "assistant"))
    both = page.unionByName(said.select("tbl", "row_id", "part", F.col("m.content").alias("text")))
    row = (F.shiftleft("row_id", 1) + F.col("tbl")).alias("r")
    return both.where("row_id is not null").select("tbl", "row_id", "part", row, single_spaced(F.col("text")).alias("text")).where("text is not null")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def rolling(codes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Fingerprints of all windows of ``width`` codes, put together from windows of powers of two."""
    h = (codes + np.uint64(11)) * _SEED[which]
    h ^= h >> np.uint64(29)
    h *= _SEED[1 - which]
    h ^= h >> np.uint64(32)
    size, power = 1, _BASE[which]
    out, have = None, 0
    while True:
        if width & size:
            if out is None:
                out, have = h, size
            else:
                n = len(codes) - have - size + 1
                out, have = out[:n] * power + h[have : have + n], have + size
        if size * 2 > width:
            return out
        n = len(h) - size
        h = h[:n] * power + h[size : size + n]
        power = power * power
        size *= 2


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(30))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours."""
    size, least = 1, x
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def anchors_of(joined: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of many texts laid end to end: fingerprint, text number, place in the text.

    Windows that reach across an end are left out.
    """
    width = SPAN - PHRASE + 1
    h = _scrambled(rolling(joined, PHRASE)) >> np.uint64(1)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    least = _sliding_least(h, width)  # by start of a SPAN window
    valid = np.zeros(len(least), dtype=bool)
    for s, n in zip(starts.tolist(), lengths.tolist()):
        valid[s : s + n - SPAN + 1] = True
    # a place is chosen if a valid window that holds it has its fingerprint as the least
    win = np.flatnonzero(valid)
    chosen = win[np.concatenate([[True], (least[win][1:] != least[win][:-1]) | (np.diff(win) != 1)])] if len(win) else win
    value = least[chosen]
    owner = np.searchsorted(starts, chosen, side="right") - 1
    return value.astype(np.int64), owner, chosen - starts[owner]


def _batches(pdf: pd.DataFrame, characters: int = 4_000_000) -> Iterator[tuple[int, int]]:
    size = pdf["text"].str.len().to_numpy()
    a = 0
    while a < len(pdf):
        b = a + max(1, int(np.searchsorted(np.cumsum(size[a:]), characters)))
        yield a, min(b, len(pdf))
        a = b


def _find_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fingerprints of the phrases chosen in each text, once a text."""
    with np.errstate(over="ignore"):
        for pdf in batches:
            for a, b in _batches(pdf):
                part = pdf.iloc[a:b]
                codes = [_codes(t) for t in part["text"]]
                h, owner, _ = anchors_of(np.concatenate(codes), np.array([len(c) for c in codes]))
                yield pd.DataFrame({"h": h, "r": part["r"].to_numpy()[owner]}).drop_duplicates()


def _places(text: str, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the phrases with the wanted fingerprints begin in a text, and their fingerprints."""
    h = (_scrambled(rolling(_codes(text), PHRASE)) >> np.uint64(1)).astype(np.int64)
    at = np.flatnonzero(np.isin(h, wanted))
    return at, h[at]


def _cut_phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Text of the phrases of which each row holds the fingerprint."""
    with np.errstate(over="ignore"):
        for pdf in batches:
            out = []
            for r, text, wanted in zip(pdf["r"], pdf["text"], pdf["hs"]):
                at, h = _places(text, wanted)
                out += [(p, k, r) for k, p in {(k, text[a : a + PHRASE]) for a, k in zip(at.tolist(), h.tolist())}]
            yield pd.DataFrame(out, columns=["phrase", "h", "r"])


def _route(shards: int):
    """Cuts from each text the stretches that hold all windows around phrases of a shard."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with np.errstate(over="ignore"):
            for pdf in batches:
                out = []
                for r, part, text, wanted in zip(pdf["r"], pdf["part"], pdf["text"], pdf["hs"]):
                    at, h = _places(text, wanted)
                    shard = h % shards
                    for s in np.unique(shard).tolist():
                        mine = at[shard == s]
                        a, b = np.maximum(mine - (SPAN - PHRASE), 0), mine + SPAN
                        first = np.r_[True, a[1:] > b[:-1]]
                        last = np.r_[first[1:], True]
                        out += [(s, r, part, x, text[x:y]) for x, y in zip(a[first].tolist(), b[last].tolist())]
                yield pd.DataFrame(out, columns=["shard", "r", "part", "offset", "text"])

    return run


#: Tells whether something stands in two rows, after ``_range``.
_TWO_ROWS = "lo < hi"


def _range(lo: str = "r", hi: str = "r") -> list[Column]:
    return [F.min(lo).alias("lo"), F.max(hi).alias("hi")]


def _stream(key: tuple, phrases: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
    """All phrases of a shard in the texts routed to it: the contexts of their occurrences."""
    columns = ["r", "part", "at", "lead", "context"]
    if phrases.empty or texts.empty:
        return pd.DataFrame([], columns=columns)
    trie = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in phrases["phrase"]:
        trie.add_word(p)
    trie.make_automaton()
    out = []
    for r, part, offset, text in zip(texts["r"], texts["part"], texts["offset"], texts["text"]):
        before = -1
        for end, _ in trie.iter(text):
            at = end - PHRASE + 1
            # windows that begin after the phrase before this one and hold this one
            lead = min(at - before - 1, SPAN - PHRASE)
            before = at
            context = text[at - lead : at + SPAN]
            if len(context) >= SPAN:
                out.append((r, part, offset + at - lead, lead, context))
    return pd.DataFrame(out, columns=columns)


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fingerprints (two of 64 bits) of the windows of each context, and where in it they begin."""
    with np.errstate(over="ignore"):
        for pdf in batches:
            f, g, at, of = [], [], [], []
            for k, (lead, context) in enumerate(zip(pdf["lead"], pdf["context"])):
                codes = _codes(context)
                n = min(lead + 1, len(codes) - SPAN + 1)
                f.append(_scrambled(rolling(codes, SPAN, 0))[:n])
                g.append(rolling(codes, SPAN, 1)[:n])
                at.append(np.arange(n, dtype=np.int32))
                of.append(np.full(n, k))
            if not f:
                continue
            of = np.concatenate(of)
            yield pd.DataFrame({"f": np.concatenate(f).view(np.int64), "g": np.concatenate(g).view(np.int64), "start": np.concatenate(at),
                                **{c: pdf[c].to_numpy()[of] for c in ("c", "d", "lo", "hi", "open")}})


class SharedSpans:
    """Rows of ``texts`` (tbl, row_id, part, r, text) that share spans, and how much of them is shared.

    Rows delivered twice are one row, and a span that recurs only within its own row isn't shared; texts shorter than SPAN
    have none.
    ``occurrences``: (r, part, at, c, d) of recurring phrases, c and d being the 128 bits that name the context; ``contexts``:
    (c, d, lead, context, lo, hi), with the least and greatest row that has it.
    """

    def __init__(self, texts: DataFrame):
        self.every = texts
        texts = spread(texts).where(F.length("text") >= SPAN)
        anchors = cut(texts.select("r", "text").mapInPandas(_find_anchors, "h long, r long"))
        recurring = anchors.groupBy("h").agg(*_range()).where(_TWO_ROWS).select("h")
        met = anchors.join(recurring, "h")
        holders = cut(texts.select("r", "part", "text").join(met.groupBy("r").agg(F.collect_set("h").alias("hs")), "r"))  # of one row
        phrases = holders.select("r", "text", "hs").mapInPandas(_cut_phrases, "phrase string, h long, r long")
        confirmed = cut(phrases.groupBy("phrase", "h").agg(*_range()).where(_TWO_ROWS).select("phrase", "h"))
        # a text meets only the shards that hold a phrase chosen in it, and only with the stretches around those phrases; a
        # shard has as many tasks as its own stretches need, each of which compiles the shard's automaton. So phrases are copied
        # in proportion to the characters they meet: SHARD_PHRASES phrases for TASK_CHARACTERS characters.
        shards = max(1, math.ceil(confirmed.count() / SHARD_PHRASES))
        shard = F.pmod("h", F.lit(shards)).cast("int").alias("shard")
        loads = holders.select(F.explode("hs").alias("h")).groupBy(shard).agg(F.ceil(F.count("*") * AROUND / TASK_CHARACTERS).cast("int").alias("tasks"))
        self.compiled = confirmed.select("phrase", shard).join(loads, "shard").select("phrase", "shard", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"))
        routed = holders.mapInPandas(_route(shards), "shard int, r long, part int, offset int, text string").join(F.broadcast(loads) if shards <= MOST_SHARDS else loads, "shard")
        routed = routed.withColumn("task", F.pmod(F.xxhash64("r", "part"), F.col("tasks")).cast("int")).drop("tasks")
        found = self.compiled.groupBy("shard", "task").cogroup(routed.groupBy("shard", "task")).applyInPandas(_stream, "r long, part int, at int, lead int, context string")
        named = found.withColumns({"c": F.xxhash64("context", "lead"), "d": F.xxhash64(F.lit("second"), "lead", "context")})
        whole = cut(named)
        self.occurrences = whole.select("r", "part", "at", "c", "d").distinct()
        self.contexts = cut(whole.groupBy("c", "d").agg(*_range(), F.min("lead").alias("lead"), F.min("context").alias("context")))

    @staticmethod
    def _meeting(contexts: DataFrame) -> DataFrame:
        """Contexts that may share a window with a different context, one of the two being open.

        Two contexts of one phrase that share a window have in common what reaches from the last multiple of
        STEP before the phrase that the window holds to STEP characters short of its end; that stretch is the key.
        """
        right = F.greatest(F.lit(SPAN - PHRASE - STEP + 1) - F.col("left"), F.lit(0))
        keyed = contexts.select("c", "d", "open", "lead", "context", F.explode(F.sequence(F.lit(0), F.col("lead"), F.lit(STEP))).alias("left")).select(
            "c", "d", "open", F.xxhash64("left", F.substring("context", F.col("lead") - F.col("left") + 1, F.col("left") + PHRASE + right)).alias("key"))
        shared = keyed.groupBy("key").agg(F.min(F.struct("c", "d")).alias("a"), F.max(F.struct("c", "d")).alias("b"), F.bool_or("open").alias("o")).where("o and a < b").select("key")
        return contexts.join(keyed.join(shared, "key").select("c", "d").distinct(), ["c", "d"], "left_semi")

    def _recurring(self, contexts: DataFrame) -> DataFrame:
        """``(c, d, start)`` of the windows of open contexts (a boolean column) that also stand in another row."""
        windows = self._meeting(contexts).mapInPandas(_fingerprints, "f long, g long, start int, c long, d long, lo long, hi long, open boolean")
        twice = windows.groupBy("f", "g").agg(*_range("lo", "hi")).where(_TWO_ROWS).select("f", "g")
        return windows.where("open").select("f", "g", "c", "d", "start").join(twice, ["f", "g"]).select("c", "d", "start")

    def rows(self) -> DataFrame:
        """``(tbl, row_id)`` of rows that share a span.

        A context that two rows have is shared as a whole, which settles most rows; only contexts of the
        others are open, and compared window by window.
        """
        both = self.contexts.where(_TWO_ROWS).select("c", "d")
        settled = cut(self.occurrences.join(both, ["c", "d"]).select("r").distinct())
        marked = self.contexts.join(settled.select(F.col("r").alias("lo"), F.lit(True).alias("_settled")), "lo", "left").withColumn("open", F.col("_settled").isNull()).drop("_settled")
        more = marked.select("c", "d", "lo").join(self._recurring(marked).select("c", "d").distinct(), ["c", "d"]).select(F.col("lo").alias("r"))
        return settled.unionAll(more).distinct().select(F.pmod("r", F.lit(2)).cast("int").alias("tbl"), F.shiftright("r", 1).alias("row_id"))

    def shares(self) -> DataFrame:
        """``(tbl, row_id, shared_chars, n_chars)`` of rows that share a span: characters that lie in a shared span, and
        all characters of the row's texts, short texts included."""
        alone = self._recurring(self.contexts.withColumn("open", F.col("lo") == F.col("hi")))
        last = F.least(F.col("lead"), F.length("context") - SPAN)
        windows = alone.unionAll(self.contexts.where(_TWO_ROWS).select("c", "d", F.explode(F.sequence(F.lit(0), last)).alias("start")))
        starts = self.occurrences.join(windows.groupBy("c", "d").agg(F.collect_set("start").alias("starts")), ["c", "d"])  # at most SPAN starts
        places = starts.select("r", "part", F.explode(F.transform("starts", lambda s: s + F.col("at"))).alias("s")).distinct()
        spans = places.groupBy("r", "part").agg(F.array_sort(F.collect_set("s")).alias("s"))  # of one text
        # a window adds what it doesn't share with the window before it
        covered = F.aggregate(F.sequence(F.lit(1), F.size("s")), F.lit(0), lambda n, k: n + F.when(k == 1, F.lit(SPAN)).otherwise(F.least(F.lit(SPAN), F.element_at("s", k) - F.element_at("s", F.greatest(k - 1, F.lit(1))))))
        shared = spans.select("r", covered.alias("shared")).groupBy("r").agg(F.sum("shared").alias("shared_chars"))
        sizes = self.every.select("r", "part", F.length("text").alias("n")).dropDuplicates(["r", "part"]).groupBy("r").agg(F.sum("n").alias("n_chars"))
        return shared.join(sizes, "r").select(F.pmod("r", F.lit(2)).cast("int").alias("tbl"), F.shiftright("r", 1).alias("row_id"), "shared_chars", "n_chars")


def named(rows: DataFrame) -> DataFrame:
    """``source_table`` in place of tbl."""
    return rows.withColumn("source_table", F.when(F.col("tbl") == 0, "page_artifacts").otherwise("chatml_dataset")).drop("tbl")
