import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliospark.llm import graph, mixing, near, quantiles, spans, splits

MSG = "array<struct<role:string,content:string>>"
CHAT = f"record_id long, messages {MSG}"
META = f"{CHAT}, metadata struct<source_book:string,pack_id:string>"


def chat(user, assistant):
    return [("system", "s"), ("user", user), ("assistant", assistant)]


# spans


def brute_spans(rows):
    first, shared = {}, set()
    for key, text in rows:
        for i in range(len(text) - spans.SPAN + 1):
            g = text[i : i + spans.SPAN]
            if first.setdefault(g, key) != key:
                shared.add(g)
    out = {}
    for key, text in rows:
        cover = bytearray(len(text))
        for i in range(len(text) - spans.SPAN + 1):
            if text[i : i + spans.SPAN] in shared:
                cover[i : i + spans.SPAN] = b"\1" * spans.SPAN
        if any(cover):
            out[key] = out.get(key, 0) + sum(cover)
    return out


@pytest.mark.parametrize("phrases", [spans.SHARD_PHRASES, 2])
def test_spans_equal_brute_force(spark, monkeypatch, phrases):
    monkeypatch.setattr(spans, "SHARD_PHRASES", phrases)
    rng = random.Random(phrases)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    passage = [" ".join(word() for _ in range(70)) for _ in range(4)]
    pages, chats = [], []
    for k in range(24):
        own = " ".join(word() for _ in range(rng.randint(10, 80)))
        p = rng.choice(passage)
        a = rng.randint(0, 60)
        cut = p[a : a + rng.choice([150, 198, 199, 200, 201, 230, 380])]  # just too short, just long enough
        text = f"{own[:90]}{cut}{own[90:]}"
        (pages if k % 2 else chats).append((k, text))
    pages.append((100, passage[0] + "\n \t" + passage[0]))  # within its own row only, if no other has it
    pages.append((101, None))
    pages.append((102, ""))
    page_df = spark.createDataFrame(pages + pages[:3], "artifact_id long, page_text string").withColumn("tbl", F.lit("clash"))
    chat_df = spark.createDataFrame([(k, chat("short", t)) for k, t in chats] + [(200, None), (201, [("user", None)])], CHAT)
    rows = [((0, i), " ".join(t.split())) for i, t in pages if t] + [((1, i), t) for i, t in chats]
    shared = spans.SharedSpans(spans.texts_of(page_df, chat_df))
    want = brute_spans(rows)
    assert {(r["tbl"], r["row_id"]) for r in shared.rows().collect()} == set(want)
    assert {(r["tbl"], r["row_id"]): r["shared_chars"] for r in shared.shares().collect()} == want


def test_spans_phrases_are_copied_in_proportion_to_their_texts(spark, monkeypatch):
    monkeypatch.setattr(spans, "SHARD_PHRASES", 40)
    monkeypatch.setattr(spans, "TASK_CHARACTERS", 10_000)
    rng = random.Random(5)
    copied = {}
    for n in (40, 320):  # every passage stands in two pages, and one in a third of all
        hot = "".join(rng.choice("abcdefghij ") for _ in range(400))
        passage = ["".join(rng.choice("abcdefghij ") for _ in range(600)) for _ in range(n // 2)]
        pages = [(k, passage[k // 2] + (hot if k % 3 == 0 else "")) for k in range(n)]
        shared = spans.SharedSpans(spans.texts_of(spark.createDataFrame(pages, "artifact_id long, page_text string"), spark.createDataFrame([], CHAT)))
        assert shared.rows().count() == n
        copied[n] = shared.compiled.count() / sum(len(t) for _, t in pages)
    assert copied[320] < 1.5 * copied[40]


def test_spans_of_nothing(spark):
    empty = spans.SharedSpans(spans.texts_of(spark.createDataFrame([], "artifact_id long, page_text string"), spark.createDataFrame([], CHAT)))
    assert empty.rows().count() == 0 and empty.shares().count() == 0


def test_spans_in_one_row_only_and_long_text(spark):
    text = "".join(chr(97 + (k * k) % 26) + str(k) for k in range(60_000))
    pages = spark.createDataFrame([(1, text[:900] + " - " + text[:900]), (2, text[1000:]), (3, text[1000:])], "artifact_id long, page_text string")
    got = spans.SharedSpans(spans.texts_of(pages, spark.createDataFrame([], CHAT))).shares().collect()
    assert sorted((r["row_id"], r["shared_chars"], r["n_chars"]) for r in got) == [(2, len(text) - 1000, len(text) - 1000), (3, len(text) - 1000, len(text) - 1000)]
    # short texts of a row count among its characters
    chats = spark.createDataFrame([(1, [("user", " short  text "), ("assistant", text[1000:1500])])], CHAT)
    got = spans.SharedSpans(spans.texts_of(pages.where("artifact_id > 1"), chats)).shares().where("tbl = 1").collect()
    assert [(r["shared_chars"], r["n_chars"]) for r in got] == [(500, 510)]


def test_rolling_and_window_minimum():
    with np.errstate(over="ignore"):
        codes = np.arange(300, dtype=np.uint64) % np.uint64(7)
        h = spans.rolling(codes, 64)
        assert len(h) == 237 and h[0] == h[7] and h[0] != h[1]
    x = np.array([random.Random(k).randint(0, 50) for k in range(90)], dtype=np.uint64)
    assert spans._sliding_least(x, 37).tolist() == [int(min(x[i : i + 37])) for i in range(54)]


# quantiles


def test_percentiles_within_bounds(spark):
    rng = random.Random(2)
    rows = [(k, f"2025-01-0{rng.randint(1, 5)}", rng.choice(["M ", "m", "n"]), int(rng.lognormvariate(7, 1.5)) + 1, rng.random() / 100) for k in range(6000)]
    rows += rows[:500] + [(10_001, None, None, -1, float("nan")), (10_002, "d", " ", None, None), (10_003, "d", "x", 10**12, float("inf")), (10_004, "d", "x", 0, -1.0)]
    df = spark.createDataFrame(rows, "metric_id long, log_day string, model string, latency_ms long, estimated_cost_usd double").withColumn("cell", F.lit("clash"))
    factor = 200
    keys = ["model", "measure"]
    daily = quantiles.daily_digests(df, factor)
    got = quantiles.read_percentiles(quantiles.merged(daily, keys, factor), keys, factor=factor).collect()
    values = {}
    for _, _, model, ms, usd in rows[:6000]:
        values.setdefault((model.strip().lower(), "latency_ms"), []).append(float(ms))
        values.setdefault((model.strip().lower(), "estimated_cost_usd"), []).append(usd)
    assert {(r["model"], r["measure"]) for r in got} == set(values)
    for r in got:
        v = sorted(values[r["model"], r["measure"]])
        assert r["n"] == len(v)
        slack = r["rank_error"] * len(v) + 1
        at = r["percent"] / 100 * len(v)
        low, high = v[max(0, int(at - slack) - 1)], v[min(len(v) - 1, int(at + slack))]
        assert low * (1 - 2 * r["value_error"]) <= r["value"] <= high * (1 + 2 * r["value_error"])
    assert quantiles.checked(df).where("not within").count() == 0
    far = spark.createDataFrame([(k, "d", "m", 5, c) for k, c in enumerate([0.0, 1e-30, 1e-12, 3.0, 1e12, 1e30])], "metric_id long, log_day string, model string, latency_ms long, estimated_cost_usd double")
    assert quantiles.checked(far).where("not within").count() == 0
    # digests of days are combined in any order
    split = quantiles.merged(quantiles.merged(daily.where("log_day < '2025-01-03'"), keys, factor).unionAll(quantiles.merged(daily.where("log_day >= '2025-01-03'"), keys, factor)), keys, factor)
    assert sorted((r["model"], r["measure"], r["n"]) for r in quantiles.read_percentiles(split, keys, [50], factor).collect()) == sorted({(r["model"], r["measure"], r["n"]) for r in got})
    assert quantiles.model_percentiles(df.limit(0)).count() == 0


# near duplicates


def dice(a, b):
    return 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b))


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(400)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(40, 90))] for _ in range(12)]
    rows = {}
    for k in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 2, 6, 10, 16])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        if rng.random() < 0.2:
            rng.shuffle(words)
        rows[k] = words
    data = [(k, chat(" ".join(w[:5]).upper(), "\n".join(w[5:]))) for k, w in rows.items()]
    df = spark.createDataFrame(data + data[:5] + [(500, None), (501, chat(None, None)), (502, [])], CHAT).withColumn("rep", F.lit("clash")).withColumn("words", F.lit("clash"))
    found = near.NearRecords(df)
    kept = [k for k, w in rows.items() if len(w) >= near.LEAST_WORDS]
    want = {(a, b) for a in kept for b in kept if a < b and dice(rows[a], rows[b]) >= 0.8}
    assert {tuple(r) for r in found.pairs().collect()} == want
    links = Counter(x for p in want for x in p)
    assert {r["record_id"]: r["n_links"] for r in found.groups().collect()} == {k: links[k] for k in kept}


def test_near_hot_group_of_edited_copies(spark):
    """1,200 copies of one text, each with 4 to 34 words of 90 replaced by words of its own: only some pairs are alike."""
    rng = np.random.default_rng(5)
    n, words = 1200, 90
    kept = np.ones((n, words), dtype=bool)
    for k in range(n):
        kept[k, rng.choice(words, rng.integers(4, 35), replace=False)] = False
    data = [(k, chat(" ".join(f"t{i}" if kept[k, i] else f"e{k}x{i}" for i in range(words)), "")) for k in range(n)]
    common = kept.astype(int) @ kept.T
    a, b = np.nonzero(np.triu(common / words >= 0.8, 1))
    want = set(zip(a.tolist(), b.tolist()))
    got = [tuple(r) for r in near.NearRecords(spark.createDataFrame(data, CHAT), block=100).pairs().collect()]
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(want) > 10_000 and len(want) - len(got) <= len(want) / 1000


@pytest.mark.parametrize("block", [near.BLOCK, 40])
def test_near_star_chain_and_clique(spark, block):
    """Copies that resemble only their origin, only their neighbours, or all each other, beside each other."""
    rng = random.Random(8)
    new = lambda: f"n{rng.getrandbits(50):x}"

    def edited(words, k):
        places = set(rng.sample(range(len(words)), k))
        return [new() if p in places else w for p, w in enumerate(words)]

    star = [[new() for _ in range(200)]]
    star += [edited(star[0], 36) for _ in range(400)]
    chain = [[new() for _ in range(100)]]
    for _ in range(100):
        chain.append(edited(chain[-1], 19))
    clique = [[new() for _ in range(1000)]]
    clique += [edited(clique[0], 90) for _ in range(30)]
    rows = star + chain + clique
    want = {(a, b) for part in (range(401), range(401, 502), range(502, 533)) for a in part for b in part if a < b and dice(rows[a], rows[b]) >= 0.8}
    assert {(0, k) for k in range(1, 401)} | {(k, k + 1) for k in range(401, 501)} <= want and len(want) >= 400 + 100 + 31 * 30 / 2
    data = [(k, chat(" ".join(w[:9]), " ".join(w[9:]))) for k, w in enumerate(rows)]
    got = {tuple(r) for r in near.NearRecords(spark.createDataFrame(data, CHAT), block=block).pairs().collect()}
    assert got <= want and len(got) >= 0.999 * len(want)


def test_near_sketches_exclude_no_similar_pair():
    rng = np.random.default_rng(9)
    with np.errstate(over="ignore"):
        for n in (45, 99, 130, 420, 900, 4000):
            words = rng.integers(0, 1 << 62, n).astype(np.uint64)
            many = [words.copy() for _ in range(40)]
            for w in many[1:]:
                w[rng.permutation(n)[: n // 5]] = rng.integers(0, 1 << 62, n // 5).astype(np.uint64)
            element, owner = near.elements(np.concatenate(many), np.repeat(np.arange(40), n))
            sketch, at = near.sketches(element, owner, near.levels(np.full(40, n)))
            side = near._Side(np.zeros(40, np.int64), np.arange(40), np.full(40, n), sketch, at[:-1])
            i, _ = near.may_be_similar(side, side, np.zeros(39, np.int64), np.arange(1, 40), 0.8)
            assert len(i) == 39


def test_near_bands_meet_alike_at_every_size():
    for n in (0, 1, 10**4, 10**6, 10**9, 10**12):
        bands, rows = near.band_shape(n)
        assert near.MEETINGS <= bands * (2 / 3) ** rows < near.MEETINGS + 1 and n * near.CHANCE**rows <= near.CHANCE_MEMBERS


@pytest.mark.parametrize("words", [1000, 3000])
def test_near_long_records_of_a_hot_group(spark, words):
    """Every third record is an edited copy of one long text: its shared words are common, the edits are rare."""
    rng = np.random.default_rng(6)
    n = 40
    kept = rng.random((n, words)) >= 0.09 * np.linspace(0.8, 1.3, n)[:, None]
    data = [(k, chat(" ".join(f"t{i}" if kept[k, i] else f"e{k}x{i}" for i in range(words)), "")) for k in range(n)]
    data += [(n + k, chat(" ".join(f"o{k}x{i}" for i in range(60)), "")) for k in range(2 * n)]
    common = kept.astype(int) @ kept.T
    a, b = np.nonzero(np.triu(common / words >= 0.8, 1))
    want = set(zip(a.tolist(), b.tolist()))
    assert len(want) > 300
    assert {tuple(r) for r in near.NearRecords(spark.createDataFrame(data, CHAT)).pairs().collect()} == want


@pytest.mark.parametrize("n", [10**5, 24 * 10**6, 10**9])
def test_near_pairs_at_the_threshold_meet(n):
    """Of pairs with a similarity of 0.8, 1 in 2,700 may share no bucket."""
    bands, rows = near.drawn_bands(*near.band_shape(n))
    rng, places, pairs = np.random.default_rng(16), near.picked(bands, rows), 8000
    words = rng.integers(0, 1 << 63, (pairs, 60)).astype(np.uint64)
    signatures = []
    with np.errstate(over="ignore"):
        for _ in range(2):
            signatures.append(np.ascontiguousarray(near.binned(*near.quick_elements(words.ravel(), np.repeat(np.arange(pairs), 60)), pairs).T))
            words[:, :12] = rng.integers(0, 1 << 63, (pairs, 12)).astype(np.uint64)
        met = sum(near.buckets(signatures[0], places[k], k) == near.buckets(signatures[1], places[k], k) for k in range(bands))
    assert (met == 0).sum() <= 9  # 3 are expected of 1 in 2,700


def test_near_bands_of_a_large_collection(spark, monkeypatch):
    """203 bands of 8 rows, as 24 million records had: a record isn't signed for each row of each band, and what is dealt out at once is bounded."""
    monkeypatch.setattr(near, "band_shape", lambda *_: (203, 8))
    monkeypatch.setattr(near, "ROUND", 50_000_000, raising=False)
    monkeypatch.setattr(near, "ROUND_PER_WORD", 1, raising=False)
    rng = np.random.default_rng(13)
    n, pairs = 12_000, 300
    rows = [rng.integers(0, 3000, k).tolist() for k in rng.integers(50, 110, n)]
    for k in range(pairs):
        copy = list(rows[k])
        for p in rng.choice(len(copy), rng.integers(1, len(copy) // 10 + 1), replace=False):
            copy[p] = int(rng.integers(3000, 6000))
        rows.append(copy)
    data = [(k, chat(" ".join(f"w{x}" for x in w[:9]), " ".join(f"w{x}" for x in w[9:]))) for k, w in enumerate(rows)]
    df = spark.createDataFrame(data, CHAT).repartition(8).cache()
    assert df.count() == n + pairs
    began = time.time()
    got = {tuple(r) for r in near.NearRecords(df).pairs().collect()}
    took = time.time() - began
    assert got == {(k, n + k) for k in range(pairs)}
    assert took < 20  # a second or two for each of several rounds


@pytest.mark.parametrize("n", [150, 6])
def test_near_hot_buckets_leave_their_part(spark, monkeypatch, n):
    """Buckets that are too large to be compared in place, found while rows still come in, and in more than one round."""
    monkeypatch.setattr(near, "HELD", 500)
    monkeypatch.setattr(near, "ROUND", 1)
    monkeypatch.setattr(near, "ROUND_PER_WORD", 10)
    rng = random.Random(14)
    first = [f"t{k}" for k in range(100)]
    rows = [[rng.choice("uvw") + w if rng.random() < 0.09 else w for w in first] for _ in range(n)]
    rows += [list(rows[0]) for _ in range(50)]
    data = [(k, chat(" ".join(w[:9]), " ".join(w[9:]))) for k, w in enumerate(rows)]
    want = {(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if dice(rows[a], rows[b]) >= 0.8}
    found = near.NearRecords(spark.createDataFrame(data, CHAT), block=10)
    got = [tuple(r) for r in found.pairs().collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.999 * len(want)
    assert {r["rep"] for r in found.members.where(f"record_id >= {n}").collect()} == {0}


def test_near_words_are_split_like_by_spark(spark):
    blanks = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"
    rng = random.Random(15)
    texts = ["".join(rng.choice(blanks + "ab\xe9\u00df\u2019\u201c\u200b\u4e2d\u3001\U0001f600") for _ in range(rng.randrange(40))) for _ in range(500)] + ["", "x" * 400_000 + " y", "ab ba"]
    want = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(r"filter(split(t, r'(?U)[\s\x1c-\x1f]+'), w -> w != '')").collect()]
    words, sizes = near.split_words(pa.array(texts)[1:])
    assert sizes.tolist() == [len(w) for w in want[1:]]
    seen = dict(zip([w for t in want[1:] for w in t], words.tolist()))
    assert len(set(seen.values())) == len(seen) == len({(w, h) for w, h in zip([w for t in want[1:] for w in t], words.tolist())})


def test_near_nothing(spark):
    found = near.NearRecords(spark.createDataFrame([], CHAT))
    assert found.pairs().count() == 0 and found.groups().count() == 0


# graph, groups and splits


@pytest.mark.parametrize("few", [graph.FEW, 0])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "HUB", 20)
    rng = random.Random(6)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100), (None, 3), (200, 201), (201, 200)] + [(1000, 1000 + k) for k in range(1, 60)]
    edges += [(rng.randint(300, 360), rng.randint(300, 360)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long"), few=few).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in list(parent)}
    assert graph.components(spark.createDataFrame([], "u long, v long"), few=few).count() == 0


CATALOG = "source_book string, title string, authors array<string>, series string, lang string, domain string"


def test_book_groups_and_records(spark):
    books = [
        ("A one.pdf", "", ["Ann Lee"], None, "en", "x"), ("b two.pdf", "", ["LEE,  ann", "Bo Ray"], None, "en", None), ("C three.pdf", "", ["Various"], "The Set", None, None),
        ("d four.pdf", "", ["bo  ray"], "the  set ", "de", "y"), ("E five.pdf", "", ["n/a"], None, "en", "x"), ("F six.pdf", "", ["Various", None], "", "en", "x"), ("G.pdf", "", None, None, None, None),
    ]
    catalog = spark.createDataFrame(books + books[:2], CATALOG).withColumn("tie", F.lit("clash"))
    groups = {r["source_book"]: r["group_book"] for r in splits.book_groups(catalog).collect()}
    assert groups == {"A one.pdf": "A one.pdf", "b two.pdf": "A one.pdf", "C three.pdf": "A one.pdf", "d four.pdf": "A one.pdf", "E five.pdf": "E five.pdf", "F six.pdf": "F six.pdf", "G.pdf": "G.pdf"}
    named = ["./books/A_one.pdf", "B%20TWO.PDF", "books\\C three.pdf", "  d four.pdf ", "e five.pdf", None, "", None, "else.pdf"]
    packs = ["", "", "", "", "", "G.pdf::1-2", "f six.pdf::3", "", ""]
    recs = spark.createDataFrame([(k, [], (b, p)) for k, (b, p) in enumerate(zip(named, packs))] + [(0, [], (named[0], "")), (99, [], None)], META)
    got = {r["record_id"]: r["group_book"] for r in splits.record_groups(recs, catalog).collect()}
    assert got == {0: "A one.pdf", 1: "A one.pdf", 2: "A one.pdf", 3: "A one.pdf", 4: "E five.pdf", 5: "G.pdf", 6: "F six.pdf", 8: "else"}


@pytest.mark.parametrize("block", [splits.BLOCK, 30])
def test_splits_keep_groups_and_shares(spark, block):
    rng = random.Random(8)
    rows = [(k, [], (f"book {min(int(rng.expovariate(0.03)), 250)}.pdf" if k % 50 else None, "")) for k in range(4000)]
    df = spark.createDataFrame(rows + rows[:9], META)
    got = splits.split_records(df, spark.createDataFrame([], CATALOG), bins=20, block=block).collect()
    assert sorted(r["record_id"] for r in got) == list(range(4000))
    by = {}
    for r in got:
        if r["group_book"]:
            assert by.setdefault(r["group_book"], r["split"]) == r["split"]
    share = Counter(r["split"] for r in got)
    assert abs(share["train"] / 4000 - 0.8) < 0.03 and abs(share["test"] / 4000 - 0.1) < 0.03
    assert splits.split_records(df.limit(0), spark.createDataFrame([], CATALOG)).count() == 0


# mixing


def test_pivot_round_keeps_the_sum():
    rng = np.random.default_rng(1)
    for _ in range(50):
        p = rng.random(41)
        q = mixing.pivot_round(p, rng)
        assert abs(q.sum() - p.sum()) < 1e-6 and ((q > 0) & (q < 1)).sum() <= 1
    mean = np.mean([mixing.pivot_round(np.array([0.2, 0.5, 0.7, 0.9]), rng) for _ in range(4000)], axis=0)
    assert np.abs(mean - [0.2, 0.5, 0.7, 0.9]).max() < 0.04


@pytest.mark.parametrize("block", [mixing.BLOCK, 12])
def test_mix(spark, block):
    rng = random.Random(9)
    docs = [(k, rng.choice(["a", "a", "a", "A ", "b", "c", None, "z"]), " ".join(["word"] * rng.randint(0, 60))) for k in range(900)]
    df = spark.createDataFrame(docs + docs[:4] + [(5000, "a", None)], "doc_id long, source string, text string").withColumn("rate", F.lit("clash"))
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.4, 3), ("c", 0.2, 2), ("none", 0.1, 2), ("b", 0.4, 3)], "source string, target_share double, max_repeats int")
    copies, report = mixing.mixed_copies(df, targets, block=block)
    cap = {"a": 1, "b": 3, "c": 2}
    assert all(0 < r["copies"] <= cap[r["source"]] for r in copies.collect()) and copies.count() == copies.select("doc_id").distinct().count()
    got = {r["source"]: r for r in report.collect()}
    assert got["none"]["actual_share"] == 0.0
    for name, share in (("a", 0.3), ("b", 0.4), ("c", 0.2)):
        assert abs(got[name]["actual_share"] - share / 0.9) < 0.03
    empty, nothing = mixing.mixed_copies(df.limit(0), targets)
    assert empty.count() == 0 and {r["actual_share"] for r in nothing.collect()} == {0.0}
