import random

import pytest
from pyspark.sql import functions as F

from foliospark.llm import bpe, budget, pairs, personal, scans

MSG = "array<struct<role:string,content:string>>"


@pytest.fixture(scope="module")
def automaton():
    return bpe.automaton()


def test_ids_equal_the_public_library(automaton):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab eéinstx \n1'ß漢🙂") for _ in range(rng.randint(0, 70))) for _ in range(3000)]
    texts += ["a" * 3000, " " * 2000, "<|endoftext|> x", "don't WE'LL", "  \x1c\x85 x", "é"]
    for text, want in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert automaton.encode(text) == want.ids
        assert automaton.count(text) == len(want.ids)
        assert automaton.decode(want.ids) == text.encode()


def test_encode_corpus(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  "), (4, "Hello world"), (4, "Hello world")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted((r["doc_id"], r["ids"]) for r in bpe.encode_corpus(df).collect())
    assert got == [(1, []), (2, []), (3, [220, 220]), (4, [15496, 995]), (4, [15496, 995])]
    assert bpe.encode_corpus(df.limit(0)).count() == 0


def test_budget(spark, automaton):
    rows = [(1, [("system", "Be kind."), ("user", "Hi there"), ("assistant", None)], ("A.pdf", "")), (2, None, (None, "")), (3, [None, ("user", "")], ("./A.PDF", ""))]
    recs = spark.createDataFrame(rows + rows[:1], f"record_id long, messages {MSG}, metadata struct<source_book:string,pack_id:string>").withColumn("book", F.lit("clash"))
    catalog = spark.createDataFrame([("A.pdf", "en", None)], "source_book string, lang string, domain string")
    n = automaton.count("Be kind.") + automaton.count("Hi there")
    assert {r["record_id"]: r["n_tokens"] for r in budget.record_tokens(recs).collect()} == {1: n, 2: 0, 3: 0}
    cube = {(r["source_book"], r["lang"], r["domain"], r["is_total"]): (r["n_records"], r["n_tokens"]) for r in budget.token_cube(recs, catalog).collect()}
    assert cube["A.pdf", "en", "unknown", 0] == (2, n) and cube[None, None, None, 7] == (3, n) and cube["unknown", "unknown", "unknown", 0] == (1, 0)


@pytest.mark.parametrize(
    ("q", "a", "want"),
    [
        ("What is it?", None, "empty_answer"), ("What is it?", " ​\n", "empty_answer"), ("What is it?", "[no answer]", "empty_answer"), ("What is it?", "...", "empty_answer"), ("What is it?", "N/A", "empty_answer"),
        ("What is the lamp for?", "I'm sorry, but I can't help with that. Please try another page.", "refusal"), ("Was ist das?", "Diese Frage kann ich leider nicht beantworten.", "refusal"),
        ("Why is the lamp near the old wall so dim?", "Question: WHY IS THE LAMP NEAR THE OLD WALL SO DIM", "copies_question"),
        ("Why is the lamp dim?", "Why is the lamp dim? Because the oil that the keeper bought was of a poor kind and hardly burns.", None),
        ("What did the keeper do with the lamp?", "Der Wächter hat die Lampe und den Docht nicht mit dem Öl aus der Stadt gefüllt.", "other_language"),
        ("What did the keeper do? Please answer in German.", "Der Wächter hat die Lampe und den Docht nicht mit dem Öl aus der Stadt gefüllt.", None),
        ("What did the keeper do?", "The keeper filled the lamp and then walked along the", "truncated_answer"), ("What did he do?", "He filled the lamp, and then …", "truncated_answer"),
        ("What did he do?", "He filled the lamp (", "truncated_answer"), ("What did he do?", "He filled it. (see the note below)", None), ("What did he say?", 'It ends with the word "lamp."', None),
        ("How many?", "Twelve", None), ("What did he do?", "He says he cannot help noticing it, though the keeper was sorry to admit it.", None), (None, "He filled the lamp.", None), ("Which parts?", "- oil\n- wick", None),
    ],
)
def test_defects(q, a, want):
    assert pairs.defect(q, a) == want


def test_defective_pairs(spark):
    qa = "array<struct<question:string,answer:string,question_type:string,difficulty:string,citation_quote:string>>"
    pages = spark.createDataFrame([(1, [("Why?", "Because it is so.", None, None, None), None, ("Why?", "", None, None, None)]), (1, [("Why?", "Because it is so.", None, None, None), None, ("Why?", "", None, None, None)]), (2, None), (3, [])], f"artifact_id long, accepted_qas {qa}")
    recs = spark.createDataFrame([(7, [("user", "Why?")]), (8, None), (9, [("user", "Why?"), ("assistant", "It is so.")]), (None, [("user", "x")])], f"record_id long, messages {MSG}").withColumn("qa_index", F.lit("clash"))
    got = sorted(tuple(r) for r in pairs.defective_pairs(pages, recs).collect())
    assert got == [("chatml_dataset", 7, 0, "empty_answer"), ("page_artifacts", 1, 1, "empty_answer"), ("page_artifacts", 1, 2, "empty_answer")]
    assert pairs.defective_pairs(pages.limit(0), recs.limit(0)).count() == 0


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(100):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 20))] for _ in "ab")
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert pairs.common_subsequence(a, b) == row[-1]


VOCAB = {w: 50 for w in "the water cycle moves heat modern people slowly through valley half-finished half finished and wall behind harbour reader keeps a lamp by every evening".split()}
PAGE = "\n".join([
    "THE WATER CYCLE", "The water cycle moves heat through the val-", "ley and the half-", "finished wall behind the harbour. Modem people", "keep the w@ter slowly by the lamp every evening, and the B12 reader keeps a lamp.", "", "12   1774", "20   1444", "", "The reader keeps", "a lamp by the harbour wall every evening.", "- 14 -",
])


def test_page_noise():
    reader = scans.Reader(VOCAB)
    noise, text = scans.read_page(PAGE, scans.LineModel(), reader)
    assert noise == [(1, "running_header"), (2, "hyphen_break"), (4, "misread"), (5, "misread"), (12, "page_number")]
    assert "through the valley and the half- finished wall" in text.replace("half-finished", "half- finished") and "Modern people" in text and "the water slowly" in text and "WATER" not in text and "14" not in text.split("1444")[1]
    assert scans.read_page(PAGE.replace("\n", "\r\n"), scans.LineModel(), reader)[0] == noise
    opening = "Chapter 2\nThe Half-finished Wall\n\nThe water cycle moves heat through the valley behind the harbour wall."
    assert scans.read_page(opening, scans.LineModel(), reader)[0] == []
    assert scans.read_page(None, scans.LineModel(), reader) == ([], "") and scans.read_page(" \n\n", scans.LineModel(), reader) == ([], "")
    long = scans.read_page("The water cycle moves heat slowly.\n" * 20_000, scans.LineModel(), reader)
    assert long[0] == []


def test_noisy_lines_table(spark):
    clean = "The reader keeps a lamp by the harbour wall every evening and the water moves slowly behind it."
    qa = "array<struct<question:string,answer:string>>"
    rows = [(k, "b.pdf", "usable", f"{clean}\n{clean}\n{k}", None) for k in range(9)] + [(20, None, "usable", "The wat-\ner moves slowly behind the harbour wall every evening.", [("q", clean)]), (21, "b", "blank", "x\n3", None), (22, "b", "usable", None, None)]
    df = spark.createDataFrame(rows + rows[:2], f"artifact_id long, source_book string, page_status string, page_text string, accepted_qas {qa}").withColumn("noise", F.lit("clash"))
    got = sorted(tuple(r) for r in scans.noisy_lines(df).collect())
    assert got == [(k, 3, "page_number") for k in range(9)] + [(20, 1, "hyphen_break")]
    assert {r["artifact_id"]: r["text"] for r in scans.continuous_text(df).collect()}[20] == "The water moves slowly behind the harbour wall every evening."
    assert scans.noisy_lines(df.limit(0)).count() == 0


NAMES = personal.Names({"corliss", "fenton", "garrick"}, {"street", "harbour", "near"})


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("You can reach me at fen.rad@mail.kelvane.example or on +1 (555) 555-0139.", [("email", "fen.rad@mail.kelvane.example"), ("phone", "+1 (555) 555-0139")]),
        ("reach me at wyn.kel (at) mail [dot] kelvane [dot] example now", [("email", "wyn.kel (at) mail [dot] kelvane [dot] example")]), ("or tam.pel at lesekreis dot example. La", [("email", "tam.pel at lesekreis dot example")]),
        ("The difference is easy to test at home. In hindsight @circle", []), ("tel. 01632 960948 ext. 38, x", [("phone", "01632 960948 ext. 38")]), ("in 1797 (555.555.0109).", [("phone", "555.555.0109")]),
        ("((01632) 960 710).", [("phone", "(01632) 960 710")]), ("au +33 (0)1 99 00 54 79 ou", [("phone", "+33 (0)1 99 00 54 79")]), ("unter 030/23125968 oder", [("phone", "030/23125968")]), ("al 600-000-131. G", [("phone", "600-000-131")]),
        ("Order 3709-70-4075 covers; ISBN 978-0-840-54327-1; closed on 14/03/1817; lies at 83.3608, 12.6401; Shelf mark QV-5511-98", []),
        ("The reader gave 666 61 4036 as identity number.", [("identity_number", "666 61 4036")]), ("On the card it says QQ 27 00 12 C and", [("identity_number", "QQ 27 00 12 C")]), ("d'assuré est le 2 99 13 99 290 851 29. D", [("identity_number", "2 99 13 99 290 851 29")]),
        ("Die Steuer-Nummer lautet 01 586 414 944.", [("identity_number", "01 586 414 944")]), ("home: Flat 9, 67a North Quay, Nevrahalmoor", [("address", "Flat 9, 67a North Quay")]), ("an Glashüttenstraße 155b, 00947", [("address", "Glashüttenstraße 155b")]),
        ("ist Am Alten Deich 66a.", [("address", "Am Alten Deich 66a")]), ("désormais 33a, impasse des Ruches, 00077", [("address", "33a, impasse des Ruches")]), ("en Calle del Molino n.º 113a. La", [("address", "Calle del Molino n.º 113a")]),
        ("My tutor Garrick L. Yvenehal-Orm wrote; Yarlutem, Corliss and E. Melvimer", [("name", "Garrick L. Yvenehal-Orm"), ("name", "Yarlutem, Corliss"), ("name", "E. Melvimer")]),
        ("the Garrick Yvenehal Institute and Near Harbour", []), ("GARRICK YVENEHAL balanced", [("name", "GARRICK YVENEHAL")]), ("🙂 Fenton Radmoch", [("name", "Fenton Radmoch")]), (None, []), ("", []),
    ],
)
def test_items(text, want):
    got = personal.find_items(text, NAMES)
    assert [(k, text[a:b]) for k, a, b in got] == want


def test_redaction_and_learning(spark):
    given = spark.createDataFrame([("Corliss",), (None,), ("Corliss",)], "given_name string")
    surnames = ["Belhumon", "Cornevak", "Drosatel", "Fenwickel", "Galrunov"]
    rows = [(k, f"Signed, Ardith {s} and {s}, Ardith. The wall is old.") for k, s in enumerate(surnames)] + [(10, None), (11, ""), (12, "Write to a@b.example, Corliss Yvenehal")]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string").withColumn("kind", F.lit("clash"))
    got = sorted((r["doc_id"], r["kind"], r["start_char"]) for r in personal.personal_items(docs, given).collect())
    assert got == sorted([(k, "name", s) for k, n in enumerate(surnames) for s in (8, 20 + len(n))] + [(12, "email", 9), (12, "name", 22)])
    assert {r["doc_id"]: r["text"] for r in personal.redacted(docs, given).collect()}[12] == "Write to [EMAIL], [NAME]"
    assert personal.personal_items(docs.limit(0), given.limit(0)).count() == 0


def test_frequent_surnames_are_names(spark):
    given = spark.createDataFrame([("Corliss",)], "given_name string")
    rows = [(k, f"Letter {k} of the harbour, Werkstatt und Hof. Signed, Corliss Merrickson and E. Melvimer") for k in range(40)]
    rows += [(50 + k, f"Note {k}. Signed, {'BCDFG'[k % 5]}. Belhumon") for k in range(40)]
    rows += [(100 + k, "A copied page. Signed, Corliss Yvenehal") for k in range(40)] + [(200, "Then Corliss Harbour and Corliss Werkstatt")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in personal.redacted(docs, given).collect()}
    assert all(got[k].endswith("Signed, [NAME] and [NAME]") for k in range(40)) and all(got[100 + k].endswith("Signed, [NAME]") for k in range(40))
    assert all(got[50 + k].endswith("Signed, [NAME]") for k in range(40))
    assert got[200] == rows[-1][1]


def test_given_names_are_learned_in_large_collections(spark):
    """Three surnames are enough, though there are 800,000 other pairs; a word with other uses isn't learned."""
    letters = "abcdefghijklmnopqrst"
    word = lambda k: "".join(letters[k // 20**i % 20] for i in range(5)).capitalize()
    rows = [(k, ". ".join(f"Q{word(k * 800 + j).lower()} Z{word(k * 800 + j).lower()}" for j in range(800))) for k in range(1000)]
    surnames = ["Belhumon", "Cornevak", "Drosatel"]
    rows += [(2000 + k, f"Signed, Ardith {n} and {n}, Ardith. See Trelland {n}; {n}, Trelland.") for k, n in enumerate(surnames)]
    rows += [(3000 + k, f"Then Trelland. Page {k}") for k in range(60)]
    names = personal.learned_names(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], "given_name string"))
    assert names.given == {"ardith"}


def test_short_surnames_after_listed_given_names():
    names = personal.Names({"ann", "ardith"}, {"the"}, {"ann"})
    read = lambda text: [text[a:b] for _, a, b in personal.find_items(text, names)]
    assert read("Ann Lee met Lee, Ann. Then Ann The, and Ardith Lee.") == ["Ann Lee", "Lee, Ann"]
    assert read("Signed, Ann Wu-Li") == ["Ann Wu-Li"]


@pytest.mark.parametrize(
    "answer",
    ["I would rather not go into that.", "This falls outside what I may discuss.", "That is not something I can help you with.", "Darüber möchte ich keine Auskunft geben.", "Je préfère ne pas en parler.",
     "Prefiero no hablar de ese tema.", "I'm sorry, that's beyond what I'm allowed to answer.", "You have asked about a bridge. I cannot provide an answer to this question.",
     "I'm sorry, but I can't help with that. " + "I know you wanted to hear from me, and I hope you will forgive me. " * 12],
)
def test_refusals_in_other_words_and_places(answer):
    assert pairs.defect("What year was the bridge opened by the town?", answer) == "refusal"


@pytest.mark.parametrize(
    "answer",
    ["The keeper refused to answer the harbour master.", "We cannot date the bridge exactly, but the chronicle names the year 1641 as the year of its opening.",
     "I must decline to respond here. " + "The bridge was opened by the town in the spring of 1641, when the new mill stood and the old ford had been washed away for good. " * 2],
)
def test_answers_that_tell_something_are_no_refusals(answer):
    assert pairs.defect("What year was the bridge opened by the town?", answer) is None


@pytest.mark.parametrize(
    ("text", "want"),
    [("Passport no. C01X00T47 was shown.", [("identity_number", "C01X00T47")]), ("Codice fiscale RSSMRA85M01H501Z is his.", [("identity_number", "RSSMRA85M01H501Z")]), ("He lives in Via Roma 12 near us.", [("address", "Via Roma 12")]),
     ("tel: 030 1234567", [("phone", "030 1234567")]), ("12345678 is my passport number.", [("identity_number", "12345678")]), ("Meine Adresse lautet Am Hang 12.", [("address", "Am Hang 12")]),
     ("Am Hang 12, 00737 Ort", [("address", "Am Hang 12")]), ("The mill stood at 65.8487, 34.8462 then.", []), ("Shelf mark C01X00T47", []), ("", []), (None, [])],
)
def test_anchors_of_other_formats(text, want):
    assert [(k, text[a:b]) for k, a, b in personal.find_items(text, personal.Names(set(), set()))] == want


def test_vocabulary_counts_copies_of_a_text_once(spark):
    page = [(1, "the keeper trims the lamp by night", None), (2, "the lamp is out", None)]
    schema = "artifact_id long, page_text string, accepted_qas array<struct<question:string,answer:string>>"
    once, often = (scans.vocabulary(spark.createDataFrame([(k * 10 + a, t, q) for k in range(n) for a, t, q in page], schema)) for n in (1, 50))
    assert [x.get(w) for x in (once, often) for w in ("the", "lamp", "keeper", "none")] == [3, 2, 0, 0] * 2
    assert scans.vocabulary(spark.createDataFrame([], schema)).get("the") == 0
