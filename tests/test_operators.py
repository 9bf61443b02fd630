import difflib
import json
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foliospark.functions.text import signature
from foliospark.operators import dedup, metrics, packs, pages, records
from foliospark.plans.config import settings
from foliospark.plans.providers import OfflineProvider
from foliospark.plans.run import run
from foliospark.plans.stages import page_prompt, sinks, stage_one, stage_two, stage_two_records
from foliospark.sources.books import count_text_pages, list_books, page_of, read_pages, read_text_pages
from foliospark.sources.jsonl import read_json, read_jsonl, write_json, written_or_set_aside
from foliospark.sources.tables import join_hot
from foliospark.streaming.incremental import artifacts_of_arrivals, calls_per_window

QA = "struct<question:string,answer:string,question_type:string,difficulty:string,citation_quote:string>"
PAGE = f"run_id string, source_book string, source_page int, page_status string, page_text string, accepted_qas array<{QA}>, heading_candidate string, first_non_empty_lines array<string>, keywords array<string>"
ONE = [("q", "a", "t", "d", "c")]


def page(n, status="usable", qas=ONE, heading="", keywords=None, text="text"):
    return ("r", "b", n, status, text, qas, heading, [f"l{n}", "m", "n"], keywords or [])


@pytest.mark.parametrize(
    ("args", "want"),
    [((1, 2, 3, 1), []), ((2, 2, 3, 1), ["1-2"]), ((3, 2, 3, 1), ["1-2-3"]), ((4, 2, 3, 1), ["1-2-3", "3-4"]), ((5, 2, 3, 1), ["1-2-3", "3-4-5"]), ((6, 2, 3, 1), ["1-2-3", "3-4-5", "5-6"]),
     ((4, 2, 3, 2), ["1-2-3", "2-3-4", "3-4"]), ((4, 2, 3, 0), ["1-2-3"]), ((5, 3, 2, 1), ["1-2-3", "3-4-5"])],
)
def test_windows(spark, args, want):
    n, least, most, overlap = args
    df = spark.createDataFrame([page(k + 1) for k in range(n)], PAGE)
    assert sorted(r["pack_id"] for r in packs.evidence_packs(df, least, most, overlap).collect()) == [f"b::{w}" for w in want]


def test_windows_over_order_and_strategy(spark):
    rows = [page(2, heading="Ch 1", keywords=["a", "b"]), page(3, status="index_only"), page(5, heading="ch  1"), page(6, qas=[]), page(9, keywords=["b", "c"]), page(11, qas=None)]
    got = packs.evidence_packs(spark.createDataFrame(rows, PAGE)).collect()
    assert [r["pack_id"] for r in got] == ["b::2-5-9"]
    assert got[0]["pack_strategy"] == "adjacent_window+lexical_overlap+heading_continuity" and got[0]["shared_terms"] == ["b"]
    assert got[0]["evidence_snippets"] == ["l2", "m", "l5", "m", "l9", "m"]
    assert packs.evidence_packs(spark.createDataFrame([], PAGE)).count() == 0


@pytest.mark.parametrize(("quotes", "want"), [([(1, "ALPHA"), (2, "delta ")], True), ([(2, "gamma delta")], False), ([(3, "x")], False), ([], False), ([(1, " ")], False), (None, False), ([(1, "last")], True)])
def test_quotes(spark, quotes, want):
    df = spark.createDataFrame([(quotes, [(1, "first"), (1, "Alpha beta last"), (2, "Gamma\ndelta")])], "q array<struct<page:int,quote:string>>, t array<struct<page:int,text:string>>")
    assert df.select(packs.quotes_match(F.col("q"), F.col("t")).alias("x")).first()["x"] is want


def test_gate(spark):
    q6, a15, p = "w " * 6, "w " * 15, "The water cycle moves heat around."
    rows = [(1, q6, a15, "water cycle", p), (2, "w " * 3, "w " * 50, "water cycle", p), (3, q6, a15, "not there at all", p), (4, q6, a15, "not there at all", "short"), (5, None, None, None, None)]
    got = {r["i"]: r for r in records.gated(spark.createDataFrame(rows, "i int, question string, answer string, citation_quote string, page_text string")).collect()}
    assert got[1]["accepted"] and got[2]["reasons"] == ["usefulness_score_below_threshold"]
    assert got[3]["reasons"] == ["citation_not_found_in_page_text", "grounding_score_below_threshold"] and got[3]["grounding_score"] == 0.2
    assert got[4]["accepted"] and got[5]["reasons"] == ["usefulness_score_below_threshold"]
    judged = spark.createDataFrame([(1, q6, a15, "water cycle", p, (0.9, 0.9, False, True, None)), (2, q6, a15, "water cycle", p, (None, None, None, None, "timeout"))],
                                   "i int, question string, answer string, citation_quote string, page_text string, verdict struct<grounding_score:double,usefulness_score:double,grounded:boolean,useful:boolean,error:string>")
    got = {r["i"]: r["reasons"] for r in records.gated(judged).collect()}
    assert got[1] == ["model_marked_not_grounded"] and got[2] == ["critique_call_failed", "grounding_score_below_threshold", "usefulness_score_below_threshold"]
    cross = spark.createDataFrame([((0.6, 0.55, 0.6, True, True, True), True), ((0.5, 0.9, 0.9, True, True, False), False)], "verdict struct<grounding_score:double,usefulness_score:double,multi_page_score:double,grounded:boolean,useful:boolean,truly_multi_page:boolean>, quotes_found boolean")
    assert [r["reasons"] for r in records.cross_gated(cross).collect()] == [[], ["model_marked_not_truly_multi_page", "evidence_quote_not_found_in_pack_text", "cross_page_grounding_below_threshold"]]


def test_similarity_golden():
    assert dedup.similarity("abcd", "bcde") == 0.75 and dedup.similarity("tide", "diet") == 0.25 and dedup.similarity("diet", "tide") == 0.5 and dedup.similarity("", "") == 1.0


def test_bounds_lose_nothing():
    rng = random.Random(1)
    for _ in range(400):
        a = "".join(rng.choice("abcde ") for _ in range(rng.randint(1, 260)))
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 8))):
            b[rng.randrange(len(b))] = rng.choice("abcde xyz")
        b = "".join(b)
        assert dedup.is_similar(a, b, 0.9) == (difflib.SequenceMatcher(a=a, b=b).ratio() >= 0.9)


def greedy(rows, threshold):
    kept, out, at = [], {}, 0
    while at < len(rows):
        unit = [r for r in rows if r[1] == rows[at][1]]
        new = []
        for i, _, text, ok in unit:
            dup = any(t == text or difflib.SequenceMatcher(a=text, b=t).ratio() >= threshold for t in kept)
            out[i] = (dup, ok and not dup)
            if ok and not dup:
                new.append(text)
        kept += new
        at += len(unit)
    return out


def test_greedy_equals_one_by_one(spark):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(70):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(len(t))] = rng.choice("abcdefgh ")
        rows.append((i, i // 3, "".join(t), rng.random() < 0.7))
    df = spark.createDataFrame(rows, "i long, page long, signature string, passes boolean")
    got = {r["i"]: (r["duplicate"], r["kept"]) for r in dedup.greedy_duplicates(df, ["page", "i"], ["page"]).collect()}
    assert got == greedy(rows, 0.9)


def prose(rng, n):
    words = ["".join(rng.choice("eeetaoinshrdlucmfwypvbgkqjxz") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    return [" ".join(rng.choices(words, k=rng.randint(50, 110))) + rng.choice([". 7", "?", "\u2014 \u5b57"]) for _ in range(n)]


def edited(rng, text, share):
    t, way = list(text), rng.randrange(4)
    n = int(len(t) * share)
    if way == 3:
        k = rng.randrange(len(t))
        t[k : k + n] = rng.choices("abcdefgh q", k=n)
    for _ in range(n if way < 3 else 0):
        k = rng.randrange(len(t))
        t[k : k + (way != 2)] = "" if way == 1 else rng.choice("abcdefgh qz,")
    return "".join(t)


def test_products_lose_nothing_and_leave_little():
    rng = random.Random(3)
    base = prose(rng, 60) + ["".join(rng.choice("abc dq") for _ in range(n)) for n in (0, 1, 2, 3, 60, 199, 200, 201)]
    texts = sorted({*base, *(edited(rng, t, rng.uniform(0, 0.13)) for t in base * 6 if t)}, key=len)
    ratio = lambda a, b: difflib.SequenceMatcher(a=a, b=b).ratio()
    alike = {(i, j) for j, t in enumerate(texts) for i, s in enumerate(texts[:j]) if difflib.SequenceMatcher(a=s, b=t).quick_ratio() >= 0.9 and max(ratio(s, t), ratio(t, s)) >= 0.9}
    assert len(alike) > 100 and alike <= set(dedup._pairs(texts, None, 0.9))
    left, right = texts[::2], texts[1::2]
    across = {(i // 2, j // 2) if i % 2 == 0 else (j // 2, i // 2) for i, j in alike if i % 2 != j % 2}
    assert across and across <= set(dedup._pairs(left, right, 0.9))
    many = sorted(prose(rng, 3000), key=len)
    assert len(list(dedup._pairs(many, None, 0.9))) < 3000


def test_near_duplicates_of_thousands_in_time(spark):
    """Texts that aren't alike cost little: before, 10,475 pairs weren't done after 121 s on six cores."""
    rng = random.Random(4)
    texts = prose(rng, 8000)
    rows = [(i, i, t, True) for i, t in enumerate(texts)] + [(9000 + i, 9000 + i, edited(rng, texts[i], 0.02), True) for i in range(0, 300, 3)]
    df = spark.createDataFrame(rows, "i long, page long, signature string, passes boolean")
    began = time.time()
    got = {r["i"] for r in dedup.greedy_duplicates(df, ["page", "i"], ["page"]).where("duplicate").collect()}
    want = {9000 + i for i in range(0, 300, 3) if difflib.SequenceMatcher(a=rows[8000 + i // 3][2], b=texts[i]).ratio() >= 0.9}
    assert got == want and want and time.time() - began < 60


def test_rounds_and_chunks_change_nothing(spark):
    rng = random.Random(5)
    base = prose(rng, 30)
    texts = sorted({*base, *(edited(rng, t, 0.04) for t in base * 3)})
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, signature string")
    whole = {(p, q) for p, s in enumerate(texts) for q, t in enumerate(texts) if p != q and difflib.SequenceMatcher(a=s, b=t).ratio() >= 0.9}
    assert whole and {tuple(r) for r in dedup.similar_pairs(df, 0.9, chunk=9).collect()} == whole
    assert dedup.similar_pairs(df.limit(0), 0.9).count() == 0


def test_exact_duplicates_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "record_id long, signature string")
    got = sorted((r["record_id"], r["duplicate"]) for r in dedup.exact_duplicates(df, ["record_id"]).collect())
    assert got == [(1, False), (2, True), (2, True), (3, False), (4, False), (5, False)]
    assert spark.range(1).select(signature(F.lit(" Q?\n"), F.lit(None).cast("string")).alias("s")).first()["s"] == "q? ||"


def test_pages_and_metrics(spark):
    df = spark.createDataFrame([("r", "b", 1, "blank", None), ("r", "b", 2, None, None), ("r", "b", 3, "usable", [("q", "a", None, "d", "c"), ("q", "a", "f", "d", "c")])], f"run_id string, source_book string, source_page int, page_status string, accepted_qas array<{QA}>")
    df = df.withColumn("page_text", F.lit(None).cast("string")).withColumn("page_status_reason", F.lit(None).cast("string")).withColumn("n", F.lit("clash")).withColumn("_i", F.lit(9))
    assert [r["status"] for r in pages.skipped(df).orderBy("source_page").collect()] == ["blank", "unreadable"]
    made = pages.page_artifacts(df).orderBy("source_page").collect()
    assert made[0]["question_type_distribution"] == {} and made[2]["question_type_distribution"] == {"unknown": 1, "f": 1} and made[0]["keywords"] == []
    assert [(r["pages_seen"], r["skipped_pages"], r["accepted_pairs"]) for r in pages.running_counts(df).orderBy("source_page").collect()] == [(1, 1, 0), (2, 2, 0), (3, 2, 2)]
    assert pages.not_done(df, df.limit(1).select("source_book", "source_page")).count() == 2 and pages.capped(df, 1).count() == 1
    assert metrics.expected_pairs(100, 4) == 160
    calls = spark.createDataFrame([(1, "generation", 10, 5, 7), (1, "generation", 10, 5, 7), (2, "synthesis", None, 1, -1), (3, "critique", 1, 1, None), (4, None, 0, 0, 0)], "metric_id long, call_type string, input_tokens long, output_tokens long, latency_ms long")
    got = {r["call_group"]: tuple(r)[1:] for r in metrics.token_stats(calls).collect()}
    assert got == {"generation": (2, 10, 6, 7), "critique": (1, 1, 1, 0), "other": (1, 0, 0, 0), "totals": (4, 11, 7, 7)}
    assert abs(spark.range(1).select(metrics.call_cost(F.lit(1000), F.lit(500), 5.0, 15.0)).first()[0] - 0.0125) < 1e-12


def test_jsonl(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    (tmp_path / "x.jsonl").write_text('{"a": 1, "b": "é"}\n\nnot json\n{"a": 2}\n{"a": "z"}\n', encoding="utf-8")
    rows = read_jsonl(spark, str(tmp_path / "x.jsonl"), schema)
    assert sorted((r["a"], r["b"]) for r in rows.collect()) == [(1, "é"), (2, None)] and rows.select("b").count() == 2
    assert read_jsonl(spark, str(tmp_path / "missing"), schema).count() == 0
    assert written_or_set_aside(rows, str(tmp_path / "out"), str(tmp_path / "dead"))
    (tmp_path / "file").write_text("x")
    assert not written_or_set_aside(rows, str(tmp_path / "file"), str(tmp_path / "dead"))
    assert spark.read.json(str(tmp_path / "dead")).count() == 2 and spark.read.json(str(tmp_path / "out")).count() == 2
    write_json(spark, {"a": 1}, tmp_path / "d" / "r.json")
    write_json(spark, {"a": "é"}, tmp_path / "d" / "r.json")
    assert read_json(spark, tmp_path / "d" / "r.json") == {"a": "é"} and read_json(spark, tmp_path / "none.json") is None


def test_books_stages_and_resume(spark, tmp_path):
    one = "The water cycle moves heat from the sea into the air every single day. Rain returns the water to the rivers and lakes below the hills again."
    two = "A lighthouse keeper trims the lamp before the fog arrives over the harbour wall. The bell rings twice when boats pass the outer sandbank at night."
    (tmp_path / "books").mkdir()
    (tmp_path / "books" / "a.txt").write_text("\f".join([one, "", two, one]), encoding="utf-8")
    assert [r["source_book"] for r in list_books(spark, str(tmp_path / "books"), "*.txt").collect()] == ["a.txt"]
    with pytest.raises(RuntimeError):
        list_books(spark, str(tmp_path / "books"), "*.pdf")
    with pytest.raises(FileNotFoundError):
        list_books(spark, str(tmp_path / "nowhere"))
    book_pages = read_pages(spark, str(tmp_path / "books"), read_text_pages, "*.txt").select("source_book", "source_page", "page_text")
    s = settings({"input": {"books_dir": "x"}, "runtime": {"model": "m", "dpi": "100", "max_unusable_retries": 1}, "dataset": {"output_path": "o"}})
    assert s.runtime.dpi == 100 and s.quality.duplicate_similarity_threshold == 0.9 and "Page: 3" in page_prompt(s, "b", 3)["user_prompt"]
    done = spark.createDataFrame([], "source_book string, source_page int")
    artifacts, decided = stage_one(book_pages, done, OfflineProvider, s, "run_1")
    rows = {r["source_page"]: r for r in artifacts.collect()}
    assert rows[2]["page_status"] == "blank" and len(rows[2]["attempts"]) == 2 and len(rows[1]["attempts"]) == 1
    assert len(rows[1]["accepted_qas"]) == 2 and rows[4]["accepted_qas"] == []  # page 4 repeats page 1
    assert decided.where("duplicate").count() == 2
    todo = stage_two(artifacts, spark.createDataFrame([], "pack_id string"), s)
    assert [r["pack_id"] for r in todo.collect()] == ["a.txt::1-3"]
    again, _ = stage_one(book_pages, artifacts.select("source_book", "source_page"), OfflineProvider, s, "run_2")
    assert again.count() == 0


def test_both_stages_to_records(spark):
    class Strict(OfflineProvider):
        """Rejects what the page says about lamps, and finds no answer useful across pages."""

        def call(self, request):
            if request.get("kind") == "critique":
                grounded = "lighthouse" not in request["item"]["question"]
                useful = "page_texts" not in request
                return {"grounding_score": 0.9, "usefulness_score": 0.9, "multi_page_score": 0.9, "grounded": grounded, "useful": useful, "truly_multi_page": True}, 1, 1
            return super().call(request)

    one = "The water cycle moves heat from the sea into the air every single day. Rain returns the water to the rivers and lakes below the hills again."
    two = "A lighthouse keeper trims the lamp before the fog arrives over the harbour wall. The bell rings twice when boats pass the outer sandbank at night."
    book = spark.createDataFrame([("b", 1, one), ("b", 2, two)], "source_book string, source_page int, page_text string")
    none = [spark.createDataFrame([], x) for x in ("source_book string, source_page int", "pack_id string", "signature string")]
    s = settings({"input": {"books_dir": "x"}, "runtime": {"model": "m"}, "dataset": {"output_path": "o"}})
    artifacts, _ = stage_one(book, none[0], OfflineProvider, s, "r")
    made, decided, packed = stage_two_records(artifacts, none[1], none[2], OfflineProvider, s, "r")
    assert [(p["n_pages"], p["n_items"], p["status"]) for p in packed.collect()] == [(2, 1, "usable")]
    r = made.collect()
    assert len(r) == 1 and r[0]["pack_id"] == "b::1-2" and r[0]["metadata"]["record_level"] == "cross_page" and r[0]["metadata"]["source_pages"] == [1, 2] and len(r[0]["metadata"]["evidence_quotes"]) == 2
    local = records.local_records(records.page_pairs(artifacts.withColumn("artifact_id", F.lit(1))))
    final, across = sinks(local, made, s)
    assert final.count() == local.count() + 1 == 5 and across.count() == 1
    again, seen, _ = stage_two_records(artifacts, none[1], decided.where("accepted").select("signature"), OfflineProvider, s, "r2")
    assert again.count() == 0 and [x["reasons"] for x in seen.collect()] == [["duplicate_or_near_duplicate"]]
    assert [x["accepted"] for x in stage_two_records(artifacts, decided.select("pack_id"), none[2], OfflineProvider, s, "r3")[1].collect()] == []
    strict, judged = stage_one(book, none[0], Strict, s, "r")
    assert [x["reasons"] for x in judged.where("not accepted").collect()] == [["model_marked_not_grounded"]]
    made, decided, _ = stage_two_records(strict, none[1], none[2], Strict, s, "r")
    assert made.count() == 0 and [x["reasons"] for x in decided.collect()] == [["model_marked_not_grounded", "model_marked_not_useful"]]


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"run_id":"r","source_book":"b","source_page":1,"page_status":"usable","page_text":"Alpha beta alpha"}\n')
    paths = [str(tmp_path / x) for x in ("in", "out", "state")]
    artifacts_of_arrivals(spark, *paths)
    artifacts_of_arrivals(spark, *paths)
    assert [r["keywords"] for r in spark.read.json(paths[1]).collect()] == [["alpha", "beta"]]
    calls = spark.createDataFrame([(0, "g", 5), (10, "g", 6), (4000, "g", 1)], "timestamp_epoch long, call_type string, latency_ms long")
    assert sorted((r["n"], r["latency_ms"]) for r in calls_per_window(calls).collect()) == [(1, 1), (2, 11)]


def test_gate_keeps_start_values_where_a_verdict_has_no_score(spark):
    answer = "The page says that rain returns to the rivers in spring, and that the lakes below the hills fill up with it."
    verdict = "struct<grounding_score:double,usefulness_score:double,grounded:boolean,useful:boolean,error:string>"
    rows = [("q1 what does it say", (None, None, None, None, None)), ("q2 what does it say", (0.5, None, True, None, None)), ("q3 what does it say", (None, 0.1, None, False, None)), ("q4 what does it say", (None, None, None, None, "late")), ("q5 what does it say", None)]
    df = spark.createDataFrame([(q, answer, "", "", v) for q, v in rows], f"question string, answer string, citation_quote string, page_text string, verdict {verdict}")
    got = {r["question"][:2]: (r["grounding_score"], r["usefulness_score"], r["reasons"]) for r in records.gated(df).collect()}
    assert got["q1"] == got["q5"] == (1.0, 0.85 if len(answer.split()) >= 15 else 0.5, []) or got["q1"][2] == got["q5"][2] == []
    assert got["q2"][0] == 0.5 and got["q2"][2] == ["grounding_score_below_threshold"]
    assert got["q3"] == (1.0, 0.1, ["model_marked_not_useful", "usefulness_score_below_threshold"])
    assert got["q4"] == (0.0, 0.0, ["critique_call_failed", "grounding_score_below_threshold", "usefulness_score_below_threshold"])


BOOKS = {
    "a.txt": ["The water cycle moves heat from the sea into the air every single day. Rain returns the water to the rivers and lakes below the hills again.", "",
              "A lighthouse keeper trims the lamp before the fog arrives over the harbour wall. The bell rings twice when boats pass the outer sandbank at night."],
    "b.txt": ["Weavers of the valley dye their wool with roots and bark gathered before the first snow. The cloth is fulled in the mill below the old stone bridge."],
    "c.txt": ["The water cycle moves heat from the sea into the air every single day. Rain returns the water to the rivers and lakes below the hills again.",
              "Copper is smelted in small furnaces built of clay and straw by the river bank. Bellows of goat skin keep the charcoal hot for half a day."],
}


def _run(spark, folder, provider=OfflineProvider, **modes):
    (folder / "books").mkdir(exist_ok=True)
    for name, pages_ in BOOKS.items():
        (folder / "books" / name).write_text("\f".join(pages_), encoding="utf-8")
    at = lambda n: str(folder / "out" / n)
    raw = {
        "input": {"books_dir": str(folder / "books"), "glob": "*.txt"}, "runtime": {"model": "m", "sleep_seconds_between_requests": 0, "prompt_log_path": at("prompts"), "api_metrics_log_path": at("calls"), "process_log_path": at("events"),
        "failed_writes_log_path": at("failed"), "checkpoint_path": at("state.json"), "parallel_critique_workers": 2}, "dataset": {"output_path": at("final"), "skipped_pages_output_path": at("skipped")},
        "quality": {"quality_log_path": at("quality")}, "cross_page": {"output_path": at("cross"), "artifact_path": at("artifacts"), "quality_log_path": at("cross_quality")}, "analytics": {"report_path": at("report.json"), "token_stats_path": at("tokens.json")},
    }
    return run(spark, settings(raw), provider, reader=read_text_pages, counter=count_text_pages, **modes)


def _rows(spark, folder, name):
    return [json.loads(r["value"]) for r in spark.read.text(str(folder / "out" / name)).collect()]


def test_a_run_stops_goes_on_and_repeats_no_record(spark, tmp_path):
    class Breaking(OfflineProvider):
        """Stands for a worker that is lost while it writes questions for the third book."""

        def call(self, request):
            if request.get("book") == "c.txt":
                raise SystemExit("lost")
            return super().call(request)

    (tmp_path / "whole").mkdir()
    want = _run(spark, tmp_path / "whole", run_id="r")
    (tmp_path / "broken").mkdir()
    with pytest.raises(Exception):
        _run(spark, tmp_path / "broken", Breaking, run_id="r", books_per_step=1)
    assert read_json(spark, tmp_path / "broken" / "out" / "state.json")["done"] == ["pages-00000", "pages-00001"]
    got = _run(spark, tmp_path / "broken", resume=True, books_per_step=1)
    assert read_json(spark, tmp_path / "broken" / "out" / "state.json")["status"] == "completed"
    timed = {"api_average_latency_ms"}
    assert {k: v for k, v in got.items() if k not in timed} == {k: v for k, v in want.items() if k not in timed}
    assert len(want) == 32 and want["total_pages_seen"] == 6 and want["skipped_pages"] == 1 and want["duplicates_filtered"] == 2 and want["local_accepted"] == 8 and want["cross_page_accepted"] == 1
    assert want["per_book_yield"] == {"a.txt": 4, "b.txt": 2, "c.txt": 2} and want["local_rejection_reasons"] == {"duplicate_or_near_duplicate": 2}
    for folder in (tmp_path / "whole", tmp_path / "broken"):
        final = sorted(json.dumps(r, sort_keys=True) for r in _rows(spark, folder, "final"))
        assert len(final) == len(set(final)) == 9 and len(_rows(spark, folder, "cross")) == 1 and len(_rows(spark, folder, "artifacts")) == 6
        assert [(r["status"], r["attempt_dpi"]) for r in _rows(spark, folder, "skipped")] == [("blank", 220)] and len(_rows(spark, folder, "quality")) == 10
        kinds = Counter(r["call_type"] for r in _rows(spark, folder, "calls"))
        assert kinds == {"generation": 7, "critique": 10, "synthesis": 1, "cross_page_critique": 1} and len(_rows(spark, folder, "prompts")) == 7
        events = Counter(r["event"] for r in _rows(spark, folder, "events"))
        assert events["page_processed"] == 5 and events["record_accepted"] == 8 and events["record_rejected_duplicate"] == 2 and events["run_completed"] == 1 and events["page_skipped"] == 1
        assert max(r["records_so_far"] for r in _rows(spark, folder, "events") if r["event"] == "page_processed") == 8
        tokens = read_json(spark, folder / "out" / "tokens.json")
        assert tokens["totals"]["calls"] == want["api_calls_total"] == 19 and tokens["critique"]["calls"] == 11
    # nothing is left to do
    assert _run(spark, tmp_path / "whole", resume=True)["total_records"] == 9 and len(_rows(spark, tmp_path / "whole", "final")) == 9


def test_modes_of_a_run(spark, tmp_path):
    dry = _run(spark, tmp_path, run_id="dry", dry_run=True)
    assert dry["total_pages_seen"] == 3 and dry["cross_page_candidates"] == 0
    first = _run(spark, tmp_path, run_id="first", skip_cross_page=True)
    assert first["local_accepted"] == 8 and first["cross_page_accepted"] == 0
    assert _run(spark, tmp_path, resume=True, cross_page_only=True)["cross_page_accepted"] == 1
    assert _run(spark, tmp_path, run_id="other", cross_page_only=True)["total_records"] == 0
    started = [r for r in _rows(spark, tmp_path, "events") if r["event"] == "run_started" and r["run_id"] == "first"][0]
    assert started["remaining_pages_estimate"] == 6 and started["estimated_candidate_samples"] == 36 and started["projected_final_samples"] == 14


def test_single_pages_and_counts():
    assert page_of(b"one\ftwo", 2, 100, read_text_pages)[0] == "two" and count_text_pages(b"one\ftwo") == 2
    for n in (0, 3):
        with pytest.raises(IndexError):
            page_of(b"one\ftwo", n, 100, read_text_pages)


def test_join_hot(spark):
    left = spark.createDataFrame([(k, "hot" if k % 3 == 0 else f"k{k % 900}" if k % 7 else None) for k in range(6000)], "id long, key string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "key string, v int")
    for how in ("inner", "left"):
        want = sorted((r["id"], r["v"] or 0) for r in left.join(right, "key", how).collect())
        assert sorted((r["id"], r["v"] or 0) for r in join_hot(left, right, "key", "id", how, hot=100).collect()) == want
    assert join_hot(left.limit(0), right, "key", "id").count() == 0
