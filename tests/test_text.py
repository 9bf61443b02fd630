import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators.pages import keyword_text, with_top_terms

BLANKS = [" ", "\t", "\n", chr(0xA0), chr(0x3000), chr(0x85), chr(0x2028), chr(0x1C), chr(0x1F)]


def one(spark, expr, **cols):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in cols.items()))
    return df.select(expr.alias("x")).first()["x"]


def random_texts(n=150):
    rng = random.Random(3)
    return ["".join(rng.choice([*"abcABCéß.", *BLANKS, chr(0x200B)]) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_normalize_strip_words_match_python(spark):
    texts = random_texts()
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.normalize(F.col("t")).alias("n"), T.strip(F.col("t")).alias("s"), T.word_count(F.col("t")).alias("w"), T.lines(F.col("t")).alias("l"))
    for r in df.collect():
        assert r["n"] == re.sub(r"\s+", " ", r["t"].lower().strip())
        assert r["s"] == r["t"].strip()
        assert r["w"] == len(r["t"].split())
        assert r["l"] == r["t"].splitlines()


def test_normalize_golden(spark):
    assert one(spark, T.normalize(F.lit("  A\t\nB  c "))) == "a b c"
    assert one(spark, T.normalize(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    ("page", "quote", "want"),
    [("The Water\n Cycle moves heat.", "water   cycle", True), ("The Water Cycle", "cycle", False), ("abcdefgh", "ABCDEFGH", True), ("", "abcdefgh", False),
     ("100% of_it done", "100% of_it", True), ("x abcdefg y", "abcdefg", False), (None, "abcdefgh", False), ("abcdefgh", None, False)],
)
def test_cites(spark, page, quote, want):
    assert one(spark, T.cites(F.lit(page).cast("string"), F.lit(quote).cast("string"))) is want


@pytest.mark.parametrize(("q", "a", "want"), [(3, 50, 0.25), (4, 7, 0.25), (4, 8, 0.5), (5, 200, 0.5), (6, 14, 0.5), (6, 15, 0.85), (6, 120, 0.85), (6, 121, 0.7)])
def test_usefulness(spark, q, a, want):
    assert one(spark, T.usefulness(F.lit("w " * q), F.lit("w " * a))) == want


def test_heading_and_lines(spark):
    text = "\n".join(["", "x" * 121, "  Chapter 1 ", "b", "c"])
    assert one(spark, T.heading(F.lit(text))) == "Chapter 1"
    assert one(spark, T.first_lines(F.lit(text))) == ["x" * 121, "Chapter 1", "b"]
    assert one(spark, T.first_lines(F.lit("y" * 250))) == ["y" * 200]
    assert one(spark, T.heading(F.lit(""))) == ""


def test_keywords_ties_by_first_appearance(spark):
    words = T.terms(keyword_text(F.lit("beta alpha beta gamma alpha the cat of"), F.lit(None).cast("array<struct<question:string,answer:string,question_type:string,difficulty:string,citation_quote:string>>")))
    top = lambda found: with_top_terms(spark.range(1), found).first()["keywords"]
    assert top(words) == ["beta", "alpha", "gamma", "cat"] and top(F.array().cast("array<string>")) == []
    rng = random.Random(5)
    text = " ".join(rng.choice(["aaa", "bbb", "ccc", "ddd", "eee"] + [f"w{chr(97 + k)}x" for k in range(26)]) for _ in range(200))
    want = [w for w, _ in Counter(t for t in re.findall("[a-z]{3,}", text) if t not in T.STOPWORDS).most_common(20)]
    assert top(T.terms(F.lit(text))) == want


def test_very_long_and_empty(spark):
    assert one(spark, T.word_count(F.lit("word " * 200_000))) == 200_000
    assert one(spark, T.word_count(F.lit(None).cast("string"))) == 0
