"""Column functions for text, with the white space, case and word rules of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space together with the separators U+001C to U+001F.
WS = r"(?U)[\s\x1c-\x1f]+"
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_WORD = r"(?U)[^\s\x1c-\x1f]+"
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"

#: Words that are no keywords.
STOPWORDS = "the and for that with this from are was were have has had about into your their what when where which while would could should".split()


def strip(text: Column) -> Column:
    """Without white space at both ends; null stays null."""
    return F.regexp_replace(text, _EDGES, "")


def normalize(text: Column) -> Column:
    """Lower case, ends stripped, each run of white space as one space."""
    return F.regexp_replace(strip(F.lower(text)), WS, " ")


def words(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null and blank texts."""
    return F.coalesce(F.size(words(text)), F.lit(0))


def lines(text: Column) -> Column:
    """Lines by any Unicode line end, without an empty one after the last end."""
    parts = F.split(text, _LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def terms(text: Column) -> Column:
    """Words of three ASCII letters or more in lower case, without stop words; repeated and in order."""
    found = F.regexp_extract_all(F.lower(text), F.lit("[a-zA-Z]{3,}"), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(STOPWORDS))


def _filled(text: Column) -> Column:
    return F.filter(F.transform(lines(text), strip), lambda line: line != "")


def heading(text: Column, most: int = 120) -> Column:
    """First line that isn't blank and has at most ``most`` characters; longer ones are passed over. '' without one."""
    return F.coalesce(F.try_element_at(F.filter(_filled(text), lambda line: F.length(line) <= most), F.lit(1)), F.lit(""))


def first_lines(text: Column, n: int = 3, width: int = 200) -> Column:
    """First ``n`` lines that aren't blank, cut to ``width`` characters; an empty array for null."""
    return F.coalesce(F.transform(F.slice(_filled(text), 1, n), lambda line: F.substring(line, 1, width)), F.array().cast("array<string>"))


def usefulness(question: Column, answer: Column) -> Column:
    """Heuristic score of a pair by its numbers of words."""
    q, a = word_count(question), word_count(answer)
    return F.when((q < 4) | (a < 8), 0.25).when((q < 6) | (a < 15), 0.5).when(a > 120, 0.7).otherwise(0.85)


def cites(page_text: Column, quote: Column, least: int = 8) -> Column:
    """Whether the normalised quote, of ``least`` characters or more, stands in the normalised page; false for nulls and blanks."""
    return cites_in(normalize(page_text), quote, least)


def cites_in(page: Column, quote: Column, least: int = 8) -> Column:
    """As ``cites``, for a page that is normalised already."""
    q = normalize(quote)
    return F.coalesce((F.length(q) >= least) & F.contains(page, q), F.lit(False))


def has_text(page_text: Column, more_than: int = 20) -> Column:
    return F.coalesce(F.length(strip(page_text)) > more_than, F.lit(False))


def signature(question: Column, answer: Column) -> Column:
    """Normalised ``question || answer`` of stripped texts, by which pairs are compared."""
    return normalize(F.concat(F.coalesce(strip(question), F.lit("")), F.lit(" || "), F.coalesce(strip(answer), F.lit(""))))
