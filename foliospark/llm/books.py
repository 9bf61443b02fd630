"""Spellings of books, people, series and sources, and the join of records to the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands in place of an author.
PLACEHOLDERS = [
    "", "?", "-", "--", "n/a", "na", "n.a.", "none", "null", "nil", "tbd", "unknown", "unknown author", "various", "various authors",
    "anonymous", "anon", "anon.", "author unknown", "not known", "unbekannt", "verschiedene", "diverse", "anonym", "inconnu", "divers",
    "anonyme", "auteurs divers", "desconocido", "varios", "varios autores", "anónimo", "vv. aa.", "vv.aa.", "aa.vv.", "collective", "staff",
    "et al.", "n.n.", "s.n.", "sans auteur", "sin autor", "ohne autor", "no author", "editors", "the editors", "several authors", "unnamed",
]

_BLANKS = r"(?U)[\s\x1c-\x1f\x{200b}\x{feff}_]+"


def plain(text: Column) -> Column:
    """Lower case, one space for each run of blanks, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), _BLANKS, " "))


def book_key(text: Column) -> Column:
    """What all spellings of a book's file name have in common: no folder, %-escapes undone, blanks
    and underscores as one space, lower case, no ending ``.pdf``. Null for a blank name."""
    unescaped = F.when(text.rlike("%[0-9A-Fa-f]{2}"), F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)).otherwise(text)
    name = F.regexp_replace(plain(F.regexp_replace(unescaped, r"^.*[/\\]", "")), r" ?\.pdf$", "")
    return F.when(name != "", name)


def person_key(text: Column) -> Column:
    """The words of a name in alphabetical order, so that ``Surname, Given`` equals ``Given Surname``;
    null for a placeholder."""
    name = plain(text)
    words = F.array_sort(F.filter(F.split(F.regexp_replace(name, r"[,;]+", " "), " +"), lambda w: w != ""))
    return F.when(~name.isin(PLACEHOLDERS) & (F.size(words) > 0), F.array_join(words, " "))


def series_key(text: Column) -> Column:
    name = plain(text)
    return F.when(~name.isin(PLACEHOLDERS), name)


def record_book_key(metadata: Column) -> Column:
    """Key of the book that a record names: source_book, or where that is null or blank the part of
    pack_id before ``::``."""
    return F.coalesce(book_key(metadata["source_book"]), book_key(F.substring_index(metadata["pack_id"], "::", 1)))
