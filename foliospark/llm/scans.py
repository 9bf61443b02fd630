"""Noise in the text of scanned pages: its lines are labelled, words repaired and paragraphs put together.

Lines of a page are a sequence with hidden labels (running header, page number, chapter opening,
table, body). A hidden Markov model over a few layout shapes is fitted to a bounded sample of pages by
Viterbi training from the start values below, and decodes every page. Words are judged against the
vocabulary of the whole collection.
"""

from __future__ import annotations

import difflib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.sources.tables import cut, once_per, spread

LABELS = ["header", "number", "opening", "table", "body"]
SHAPES = ["number", "row", "chapter", "caps", "title", "stamped", "prose"]
#: Pages that the model is fitted on at most (the least hashes of all pages), and rounds of training.
SAMPLE_PAGES, ROUNDS = 1000, 3
#: A word that makes up less than this share of the words of all different texts isn't known, which bounds the vocabulary to 10
#: million words (120 MB); one that is meant must occur so often at least.
WORD_SHARE, WORD_LEAST = 1e-7, 4
#: How many times more frequent than a word its reading must be for the word to be a misreading of it.
MORE = 8

#: What recognition makes of letters (misread, meant).
LETTERS = [("c", "e"), ("ri", "n"), ("cl", "d"), ("ii", "u"), ("rn", "m"), ("b", "h"), ("q", "g"), ("m", "in"), ("vv", "w"), ("h", "li"), ("m", "rn")]
SIGNS = [("0", "o"), ("@", "a"), ("!", "i"), ("†", "t"), ("5", "s"), ("1", "l"), ("6", "b"), ("6", "é"), ("|", ""), ("~", ""), ("$", "s"), ("€", "e"), ("8", "b"), ("1", "i"), ("|", "l"), ("3", "e"), ("¢", "c"), ("ſ", "s")]
#: Signs that end a line inside a word.
HYPHENS = "".join(map(chr, (0x2010, 0x2011, 0xAC, 0xAD))) + "-"
#: Words that number a chapter.
CHAPTER = r"(?:chapter|kapitel|chapitre|cap[íi]tulo|part|teil|partie|parte|section|abschnitt)"

_WORD = re.compile(rf"[^\s.,;:?\"'()\[\]«»“”„’‘…·—–]+")
_ROMAN = r"(?=[ivxlcdm])m{0,3}(?:c[md]|d?c{0,3})(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})"
_DIGITS = r"[0-9OolI]{1,5}"
_AROUND = r"[\[\](){}\-–—|·•*~_=.,:\s]*"
_NUMBER = re.compile(rf"^{_AROUND}(?:(?:page|seite|p[áa]gina|p[áa]g|p|s|pp)\b\.?\s*)?({_DIGITS}(?:\s+{_DIGITS})*|{_ROMAN})(?:\s*(?:of|/|von|de|sur)\s*\d+)?{_AROUND}$", re.IGNORECASE)
_ROW = re.compile(r"^[\d\s.,|%:;+\-–—/]*$")
_CHAPTER = re.compile(rf"^{CHAPTER}\s+(?:\d+|[ivxlc]+)\b[.:]?$", re.IGNORECASE)
_STAMP = re.compile(rf"^(?:{_DIGITS}\s*[|·•—–-]\s*|{_DIGITS}\s+)(?=\D*[^\W\d_]{{2}})|\s*[|·•—–]\s*{_DIGITS}$|\s+{_DIGITS}$")
_ENDS = ".?!:;,\"”»)…'’"
_LOWER = re.compile(r"[a-zß-öø-ÿ]{3}.*[a-zß-öø-ÿ]{3}")
_SMALL = set("the of and in a an to for de la le les des du el los las y et von der die das den dem und zu im am del al en un une ein eine d l".split())


def _spaced(line: str) -> bool:
    """Letters printed apart, as in ``P O R T``."""
    parts = line.split()
    return len(parts) >= 4 and sum(len(p) == 1 or not p.isalpha() for p in parts) >= 0.8 * len(parts) and any(c.isalpha() for c in line)


_FOLD = str.maketrans("0@!†5168$", "oaitslbbs", "|~")


def folded(text: str) -> str:
    """Letters only, in lower case, with signs as the letters they are mostly misread for."""
    return "".join(c for c in text.lower().translate(_FOLD) if c.isalpha())


def book_title(source_book: str | None) -> str:
    """Folded title in the name of a book's file, without notes on the copy."""
    name = re.sub(r"^.*[/\\\\]|\.pdf$", "", (source_book or "").strip(), flags=re.IGNORECASE).replace("_", " ")
    return folded(re.sub(r"\s*(\(scan\)|\bocr|-\s*\d+\w* printing|\bvol\.? \d+)\s*$", "", name, flags=re.IGNORECASE))


def _prints(line: str, title: str) -> bool:
    """Whether a line is the title, but for a few misread letters."""
    own = folded(line)
    if not title or abs(len(own) - len(title)) > 4 or len(title) < 6:
        return False
    return own == title or own[:3] == title[:3] and difflib.SequenceMatcher(None, own, title, autojunk=False).ratio() > 0.85


def shape(line: str, before: str, width: int, title: str = "") -> str:
    """Layout shape of a non-blank line; ``before`` is the non-blank line above, ``width`` the length of
    the page's longest line, ``title`` the folded title of the book."""
    s = line.strip()
    if title and abs(len(s.replace(" ", "")) - len(title)) <= 10 and _prints(_STAMP.sub("", s), title):
        return "caps"
    if (s[0].islower() or len(s) > 0.8 * width and s.count(" ") > 8 or s[-1] in ".,") and len(s) > 16 and not s.isupper() and _LOWER.search(s):
        return "prose"
    if _NUMBER.match(s) and not (s.endswith(".") or s.endswith(",")):
        digits = [t for t in re.split(r"\s+", s.strip("[](){}-–—|·•*~_=.,: ")) if t]
        if len(digits) < 2 or all(len(t) == 1 for t in digits) or not all(t.isdigit() for t in digits):
            return "number"
    if _ROW.match(s):
        return "row"
    if _CHAPTER.match(s):
        return "chapter"
    bare = _STAMP.sub("", s)
    stamped = bare != s
    letters = [c for c in bare if c.isalpha()]
    if len(letters) >= 3 and (_spaced(bare) or sum(c.isupper() for c in letters) >= 0.75 * len(letters)) and len(s) <= max(40, width):
        return "caps"
    words = bare.split()
    short = len(s) <= 0.8 * width or len(words) <= 8 and len(s) < width
    if short and not s.endswith((*_ENDS, *HYPHENS)) and 0 < len(words) <= 12:
        named = [w for w in words if w.lower().strip("'’") not in _SMALL]
        title = bool(named) and sum(w[0].isupper() or not w[0].isalpha() for w in named) >= 0.6 * len(named)
        if stamped and (title or len(words) <= 7 and not before.rstrip().endswith(("-", ","))):
            if title or re.search(r"[|·•]|\s{2,}", s):
                return "stamped"
        if title or (bare[0].isupper() and len(s) < 0.6 * width and (not before or before.rstrip()[-1:] in ".?!:\"”»)" or _NUMBER.match(before.strip()))):
            return "title"
    return "prose"


#: Start values of the model: log weights of shapes under each label, and of one label after another.
_EMIT = {
    "header": {"caps": 0.6, "title": 0.15, "stamped": 0.24, "prose": 0.01},
    "number": {"number": 0.99, "row": 0.01},
    "opening": {"chapter": 0.6, "title": 0.3, "caps": 0.1},
    "table": {"row": 0.8, "number": 0.2},
    "body": {"prose": 0.985, "title": 0.01, "number": 0.002, "row": 0.002, "stamped": 0.001},
}
_NEXT = {
    "start": {"header": 0.4, "number": 0.08, "opening": 0.1, "table": 0.01, "body": 0.41},
    "header": {"header": 0.01, "number": 0.15, "opening": 0.04, "table": 0.02, "body": 0.7, "end": 0.08},
    "number": {"header": 0.15, "number": 0.001, "opening": 0.05, "table": 0.001, "body": 0.35, "end": 0.45},
    "opening": {"header": 0.001, "number": 0.001, "opening": 0.5, "table": 0.02, "body": 0.48},
    "table": {"header": 0.01, "number": 0.02, "opening": 0.01, "table": 0.7, "body": 0.26},
    "body": {"header": 0.01, "number": 0.02, "opening": 0.001, "table": 0.01, "body": 0.93, "end": 0.03},
}
_FLOOR = 1e-6


class LineModel:
    """Hidden Markov model of the lines of a page."""

    def __init__(self):
        self.emit = np.array([[_EMIT[a].get(s, _FLOOR) for s in SHAPES] for a in LABELS])
        self.next = np.array([[_NEXT[a].get(b, _FLOOR) for b in [*LABELS, "end"]] for a in ["start", *LABELS]])

    def decode(self, shapes: list[int]) -> list[int]:
        """Most likely labels."""
        if not shapes:
            return []
        e, t = np.log(self.emit / self.emit.sum(1, keepdims=True)), np.log(self.next / self.next.sum(1, keepdims=True))
        inner = t[1:, : len(LABELS)]
        # a page number stands at the edge of a page: beside it only headers and openings, up to the end
        score = t[0, : len(LABELS)] + e[:, shapes[0]]
        back = []
        for s in shapes[1:]:
            step = score[:, None] + inner
            back.append(step.argmax(0))
            score = step.max(0) + e[:, s]
        score = score + t[1:, -1]
        k = int(score.argmax())
        out = [k]
        for b in reversed(back):
            k = int(b[k])
            out.append(k)
        return out[::-1]

    def fit(self, pages: list[list[int]], rounds: int = ROUNDS, prior: float = 200.0) -> "LineModel":
        """Viterbi training; the start values weigh like ``prior`` observations of each label."""
        first_e, first_t = self.emit.copy(), self.next.copy()
        for _ in range(rounds):
            e, t = first_e * prior, first_t * prior
            for shapes in pages:
                labels = self.decode(shapes)
                at = 0
                for s, k in zip(shapes, labels):
                    e[k, s] += 1
                    t[at, k] += 1
                    at = k + 1
                if labels:
                    t[at, -1] += 1
            self.emit, self.next = np.maximum(e / e.sum(1, keepdims=True), _FLOOR), np.maximum(t / t.sum(1, keepdims=True), _FLOOR)
        return self


def page_lines(text: str) -> list[str]:
    return [line[:-1] if line.endswith("\r") else line for line in text.split("\n")]


def page_shapes(lines: list[str], title: str = "") -> tuple[list[int], list[int]]:
    """Places of the non-blank lines, and their shapes."""
    there = [i for i, line in enumerate(lines) if line.strip()]
    width = max((len(lines[i]) for i in there), default=0)
    return there, [SHAPES.index(shape(lines[i], lines[there[k - 1]] if k else "", width, title)) for k, i in enumerate(there)]


def label_lines(lines: list[str], model: LineModel, title: str = "") -> list[str]:
    """A label for each line; blank lines are ``blank``.

    After decoding, a page number or header that stands as a run of numbers with table rows is a table, and
    numbers inside the page are no page numbers.
    """
    there, shapes = page_shapes(lines, title)
    labels = [LABELS[k] for k in model.decode(shapes)]
    n = len(labels)
    edge = lambda k: all(x in ("header", "number", "opening") for x in labels[:k]) or all(x in ("header", "number") for x in labels[k + 1 :])
    for k in range(n):
        if labels[k] == "number":
            beside = [SHAPES[shapes[j]] for j in (k - 1, k + 1) if 0 <= j < n]
            if not edge(k) or "row" in beside or beside.count("number") and n > 1:
                labels[k] = "table" if "row" in beside or "number" in beside else "body"
    out = ["blank"] * len(lines)
    for i, label in zip(there, labels):
        out[i] = label
    return out


def _readings(word: str, table: list[tuple[str, str]]) -> Iterator[tuple[str, int]]:
    for wrong, right in table:
        at = word.find(wrong)
        while at >= 0:
            yield word[:at] + right + word[at + len(wrong) :], at
            at = word.find(wrong, at + 1)


class Counts:
    """How often words occur, by the words' hashes in order: 12 bytes a word."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], np.minimum(counts[order], 2**32 - 1).astype(np.uint32)

    def get(self, word: str, default: int = 0) -> int:
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), seed=42)  # as Spark hashes
        h = h - (1 << 64) if h >> 63 else h
        k = int(np.searchsorted(self.hashes, h))
        return int(self.counts[k]) if k < len(self.hashes) and self.hashes[k] == h else default


class Reader:
    """Judges words against the vocabulary (word -> count)."""

    def __init__(self, vocabulary: dict[str, int] | Counts):
        self.words, self.known = vocabulary, {}
        self.judge = lru_cache(maxsize=200_000)(self._judge)
        self.token = lru_cache(maxsize=400_000)(self._token)

    def _token(self, token: str) -> tuple[str, int] | None:
        """As ``judge``, for a token as it is printed."""
        word = token.strip("-").rstrip("!") if token.rstrip("!") else token
        if len(word) < 2:
            return None
        lead = len(token) - len(token.lstrip("-"))
        hit = self.judge(word.lower())
        return (hit[0], hit[1] + lead) if hit else None

    def count(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            if len(self.known) > 1_000_000:
                self.known.clear()
            n = self.known[word] = self.words.get(word, 0)
        return n

    def _judge(self, word: str) -> tuple[str, int] | None:
        """The word meant and the place of the first misread letter, or None for a sound word. In lower case."""
        if len(word) < 2 or not any(c.isalpha() for c in word):
            return None
        parts = [p for p in re.split(r"[-’']", word) if p]
        signs = [m.start() for m in re.finditer(r"[0-9@!†|~$€¢]", word)]
        if signs:
            meant = self._unsigned(word)
            if meant:
                return meant, signs[0]
            inner = [k for k in signs if word[k] in "@†|~" or (word[k] == "!" and k < len(word) - 1)]
            if inner and sum(c.isalpha() for c in word) >= 2:
                return self._plain(word), inner[0]
            digits = [k for k in signs if word[k] in "0156"]
            # a digit between small letters is none of an order, size or formula
            if digits and re.search(r"[^\W\d_]{2}[0156]|[0156][^\W\d_]{2}", word) and not re.fullmatch(r"\d+(?:st|nd|rd|th|er|re|e|ème|º|ª|o|a)", word) and sum(c.isalpha() for c in word) >= 4 and len(digits) == len(re.findall(r"\d", word)):
                return self._plain(word), digits[0]
            return None
        own = self.count(word)
        best = None
        for meant, at in _readings(word, LETTERS):
            n = self.count(meant)
            if n >= max(WORD_LEAST, MORE * max(own, 1) if own else WORD_LEAST) and (best is None or n > best[2]):
                best = meant, at, n
        if best is None and own == 0:
            for once, at in _readings(word, LETTERS):  # two letters misread
                for meant, also in _readings(once, LETTERS):
                    n = self.count(meant)
                    if n >= 4 * WORD_LEAST and len(meant) >= 5 and (best is None or n > best[2]):
                        best = meant, min(at, also), n
        if best is None and own == 0 and len(parts) > 1:
            at = 0
            for p in parts:
                at = word.find(p, at)
                hit = self._judge(p) if self.count(p) == 0 else None
                if hit:
                    return word[:at] + hit[0] + word[at + len(p) :], at + hit[1]
                at += len(p)
        return best[:2] if best else None

    def _plain(self, word: str) -> str:
        return "".join({"0": "o", "@": "a", "!": "i", "†": "t", "5": "s", "1": "l", "6": "b", "|": "", "~": ""}.get(c, c) for c in word)

    def _unsigned(self, word: str) -> str | None:
        """The known word that a word with signs in place of letters stands for."""
        best, most = None, 0
        layer = {word}
        for _ in range(4):
            layer = {m for w in layer for m, _ in _readings(w, SIGNS)}
            for m in layer:
                pieces = [m] if self.count(m) else [p for p in re.split(r"[-’']", m) if p]
                if re.search(r"[0-9@!†|~$€¢]", m) or sum(c.isalpha() for c in m) < 2:
                    continue
                n = min(self.count(p) if len(p) > 1 else WORD_LEAST for p in pieces) if pieces else 0
                if n < WORD_LEAST:
                    n = max([n, *(self.count(r) for r, _ in _readings(m, LETTERS))])
                if n >= WORD_LEAST and n > most and n >= MORE * self.count(word):
                    best, most = m, n
        return best

    def broken(self, head: str, tail: str) -> bool:
        """Whether ``head`` and ``tail`` are parts of one word that has no hyphen there."""
        whole, joined = (head + tail).lower(), f"{head}-{tail}".lower()
        plain, compound = self.count(whole), self.count(joined)
        if plain or compound:
            return plain >= compound
        # unknown either way: two words that are known each by itself make a compound
        a, b = self.count(head.lower()), self.count(tail.lower())
        return not (a >= WORD_LEAST and b >= WORD_LEAST and len(head) > 3 and len(tail) > 3 and self.judge(whole) is None)


_STOPS = r"\s.,;:?\"()\[\]«»“”„…"
_TAIL = re.compile(rf"([^{_STOPS}{HYPHENS[:-1]}\-]*[^\W\d_][^{_STOPS}{HYPHENS[:-1]}\-]*)[{HYPHENS}]\s*$")
_HEAD = re.compile(r"^\s*([^\s.,;:?\"()\[\]«»“”„…]+)")


def read_page(text: str | None, model: LineModel, reader: Reader, title: str = "") -> tuple[list[tuple[int, str]], str]:
    """Noisy lines (number from 1, kind) of a page, and its text in continuous paragraphs.

    Null and blank texts have no lines and an empty text. Running headers and page numbers are left out
    of the text, broken words joined, misread words put right where the word meant is known; tables, openings and
    the breaks between paragraphs are kept.
    """
    if not text or not text.strip():
        return [], ""
    lines = page_lines(text)
    labels = label_lines(lines, model, title)
    noise: set[tuple[int, str]] = set()
    blocks: list[list[str]] = [[]]
    running = [i for i, x in enumerate(labels) if x == "body"]
    after = dict(zip(running, running[1:]))
    body = {i: lines[i] for i in running}
    carried = 0  # characters of the line that were given to the line before
    for i, label in enumerate(labels):
        if label in ("header", "number"):
            noise.add((i + 1, "running_header" if label == "header" else "page_number"))
            continue
        if label == "blank":
            # a blank line inside a sentence that goes on is no break
            blocks.append([])
            continue
        if label != "body":
            blocks += [[lines[i].strip()], []]
            continue
        line = body[i]
        start, carried = carried, 0
        rest, j = line[start:], after.get(i)
        pieces, at = [], 0
        m = _TAIL.search(rest) if j is not None and (rest.rstrip()[-1:] or " ") in HYPHENS else None
        follow = _HEAD.match(body[j]) if m else None
        joined = None
        if m and follow and follow.group(1)[:1].islower() | (not follow.group(1)[:1].isalpha()):
            head, tail = m.group(1), follow.group(1)
            core = tail.strip("'’!|")
            if core and any(c.isalpha() for c in tail) and reader.broken(head, core):
                noise.add((i + 1, "hyphen_break"))
                joined = head, tail, follow.end()
        stop = m.start(1) if joined else len(rest)
        for w in _WORD.finditer(rest[:stop]) if any(map(reader.token, _WORD.findall(rest[:stop]))) else ():
            hit = reader.token(w.group())
            pieces.append(rest[at : w.start()])
            pieces.append(_case(w.group(), hit[0]) if hit else w.group())
            at = w.end()
            if hit:
                noise.add((i + 1, "misread"))
        pieces.append(rest[at:stop])
        if joined:
            head, tail, carried = joined
            whole = head + tail
            hit = reader.token(whole)
            if hit:
                noise.add(((i if hit[1] < len(head) else j) + 1, "misread"))
            pieces.append(_case(whole, hit[0]) if hit else whole)
        done = "".join(pieces).strip()
        if done:
            blocks[-1].append(done)
    paragraphs = [" ".join(b) for b in blocks if b]
    return sorted(noise), "\n\n".join(_sewn(paragraphs))


def _case(token: str, meant: str) -> str:
    if token.isupper():
        return meant.upper()
    return meant[:1].upper() + meant[1:] if token[:1].isupper() else meant


def _sewn(paragraphs: list[str]) -> list[str]:
    """A paragraph that ends inside a sentence goes on in one that begins with a small letter."""
    out: list[str] = []
    for p in paragraphs:
        if out and p[:1].islower() and out[-1][-1:] not in ".?!:\"”»":
            out[-1] += " " + p
        else:
            out.append(p)
    return out


def _words_of(text: Column) -> Column:
    """Lower-case words of letters with inner hyphens and apostrophes, words broken at line ends left out."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"(?<![\p{{L}}\d@†|~!\x{{ad}}-])\p{{L}}+(?:-\p{{L}}+)*(?![\p{{L}}\d@†|~]|[{HYPHENS}] ?\r?\n|!\p{{L}})"), F.lit(0))


def vocabulary(pages: DataFrame) -> Counts:
    """Counts of words over all different page texts and accepted pairs: copies of a text count once, so that they don't make
    their misread words known. Cut at a share of all words, so that it has at most 1 / WORD_SHARE entries whatever the collection's
    size."""
    pairs = F.array_join(F.transform(F.col("accepted_qas"), lambda q: F.concat_ws(" ", q["question"], q["answer"])), "\n")
    texts = pages.select(F.concat_ws("\n", "page_text", pairs).alias("text"))
    # a text is named by 128 bits, and its words are counted where it lies first
    once = texts.withColumn("_key", F.md5("text")).dropDuplicates(["_key"])
    words = once.select(F.explode(_words_of(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    words = cut(words.select(F.xxhash64("word").alias("h"), "n").where("n > 1"))  # read twice: for the sum and for the frequent ones
    total = words.agg(F.sum("n")).first()[0] or 0
    kept = words.where(F.col("n") >= max(2, math.ceil(WORD_SHARE * total))).toPandas()
    return Counts(kept["h"].to_numpy(dtype=np.int64), kept["n"].to_numpy(dtype=np.int64))


def fitted_model(pages: DataFrame, sample: int = SAMPLE_PAGES) -> LineModel:
    """The line model, fitted on at most ``sample`` pages (those with the least hashes of their id)."""
    # ids first, so that no task sends texts which others displace
    ids = [r[0] for r in pages.where("page_text is not null").select("artifact_id").orderBy(F.xxhash64("artifact_id"), "artifact_id").limit(sample).collect()]
    rows = pages.where(F.col("artifact_id").isin(ids)).select("source_book", "page_text").collect() if ids else []
    return LineModel().fit([page_shapes(page_lines(r["page_text"]), book_title(r["source_book"]))[1] for r in rows])


def usable(pages: DataFrame) -> DataFrame:
    return pages.where("page_status = 'usable' and artifact_id is not null and page_text is not null")


def noisy_lines(pages: DataFrame) -> DataFrame:
    """``(artifact_id, line_no, noise)`` of usable pages; repeated rows count once."""
    model, words = fitted_model(usable(pages)), pages.sparkSession.sparkContext.broadcast(vocabulary(pages))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(words.value)
        for pdf in batches:
            out = [(a, n, kind) for a, b, t in zip(pdf["artifact_id"], pdf["source_book"], pdf["page_text"]) for n, kind in read_page(t, model, reader, book_title(b))[0]]
            yield pd.DataFrame(out, columns=["artifact_id", "line_no", "noise"])

    return spread(usable(pages).select("artifact_id", "source_book", "page_text")).mapInPandas(run, "artifact_id long, line_no int, noise string").distinct()


def continuous_text(pages: DataFrame) -> DataFrame:
    """``(artifact_id, text)``: the repaired text of every usable page."""
    model, words = fitted_model(usable(pages)), pages.sparkSession.sparkContext.broadcast(vocabulary(pages))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(words.value)
        for pdf in batches:
            yield pd.DataFrame({"artifact_id": pdf["artifact_id"], "text": [read_page(t, model, reader, book_title(b))[1] for b, t in zip(pdf["source_book"], pdf["page_text"])]})

    return once_per(spread(usable(pages).select("artifact_id", "source_book", "page_text")).mapInPandas(run, "artifact_id long, text string"), "artifact_id")
