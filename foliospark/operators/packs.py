"""Overlapping windows of neighbouring pages (evidence packs) and checks of quotes against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import normalize, strip


def shared_terms(keywords: Column, most: int = 20) -> Column:
    """Terms that all non-empty keyword arrays have, in order, at most ``most``."""
    k = F.filter(keywords, lambda x: F.size(x) > 0)
    both = F.aggregate(F.slice(k, 2, F.greatest(F.size(k) - 1, F.lit(0))), F.try_element_at(k, F.lit(1)), F.array_intersect)
    return F.when(F.size(k) > 0, F.slice(F.array_sort(both), 1, most)).otherwise(F.array().cast("array<string>"))


def heading_goes_on(headings: Column) -> Column:
    """Whether a heading that isn't empty repeats in the window after normalisation."""
    h = F.transform(F.filter(headings, lambda x: x != ""), normalize)
    return F.size(F.array_distinct(h)) < F.size(h)


def _placed(pages: DataFrame, least: int, most: int, overlap: int) -> DataFrame:
    """Fitting pages with their place in the book (_i), once for each window (_w) that holds them. Places are given by keys alone: texts
    are neither sorted nor kept in a window."""
    size = max(least, most)
    step = max(1, size - max(0, overlap))
    fit = pages.where("page_status = 'usable' and size(accepted_qas) > 0")
    first = F.greatest(F.lit(0), F.ceil((F.col("_i") - size + 1) / step)).cast("int")
    last = F.floor(F.col("_i") / step).cast("int")
    order = Window.partitionBy("source_book").orderBy(F.coalesce("source_page", F.lit(0)), *(["artifact_id"] if "artifact_id" in pages.columns else []))
    if "artifact_id" in pages.columns:
        places = fit.select("artifact_id", "source_book", "source_page").withColumn("_i", F.row_number().over(order) - 1).select("artifact_id", "_i")
        placed = fit.join(places, "artifact_id")
    else:
        placed = fit.withColumn("_i", F.row_number().over(order) - 1)
    # with little overlap a page may lie between two windows
    return placed.where(first <= last).withColumn("_w", F.explode(F.sequence(first, last)))


def _pack_id() -> Column:
    return F.concat("source_book", F.lit("::"), F.array_join(F.col("source_pages").cast("array<string>"), "-"))


def pack_sizes(pages: DataFrame, least: int = 2, most: int = 3, overlap: int = 1) -> DataFrame:
    """``pack_id, n_pages`` of the packs, without their content."""
    page = F.coalesce("source_page", F.lit(0)).alias("page")
    made = _placed(pages, least, most, overlap).groupBy("source_book", "_w").agg(F.array_sort(F.collect_list(F.struct("_i", page))).alias("p")).where(F.size("p") >= least)
    return made.select("source_book", F.transform("p", lambda x: x["page"]).alias("source_pages")).select(_pack_id().alias("pack_id"), F.size("source_pages").alias("n_pages"))


def evidence_packs(pages: DataFrame, least: int = 2, most: int = 3, overlap: int = 1) -> DataFrame:
    """Packs of usable pages with accepted pairs, over their order in the book (not their numbers).

    Takes one run's artifacts (source_book, source_page, page_status, page_text, accepted_qas, heading_candidate,
    first_non_empty_lines, keywords). A window has max(least, most) pages and starts every
    max(1, size - overlap); a shorter last one is kept if it has ``least`` pages. A page goes to the windows that
    hold it by arithmetic, so each book costs one sort and one grouping. A null page number counts as 0.
    """
    windows = _placed(pages, least, most, overlap)
    page = F.coalesce("source_page", F.lit(0))
    members = windows.groupBy("source_book", "_w").agg(F.array_sort(F.collect_list(F.struct(
        "_i", page.alias("page"), F.coalesce("page_text", F.lit("")).alias("text"), F.coalesce("heading_candidate", F.lit("")).alias("heading"),
        F.coalesce("first_non_empty_lines", F.array().cast("array<string>")).alias("lines"), F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"), "accepted_qas"))).alias("p")).where(F.size("p") >= least)
    each = lambda name: F.transform("p", lambda x: x[name])
    packs = members.select(
        "source_book", each("page").alias("source_pages"), shared_terms(each("keywords")).alias("shared_terms"), each("heading").alias("heading_candidates"),
        F.transform("p", lambda x: F.struct(x["page"].alias("page"), x["text"].alias("text"))).alias("page_texts"), F.flatten(each("accepted_qas")).alias("accepted_local_qas"),
        F.slice(F.flatten(F.transform("p", lambda x: F.slice(x["lines"], 1, 2))), 1, 8).alias("evidence_snippets"))
    strategy = F.concat_ws("+", F.lit("adjacent_window"), F.when(F.size("shared_terms") > 0, "lexical_overlap"), F.when(heading_goes_on(F.col("heading_candidates")), "heading_continuity"))
    return packs.withColumns({"pack_id": _pack_id(), "pack_strategy": strategy})


def quotes_match(quotes: Column, page_texts: Column) -> Column:
    """Whether there are quotes (page, quote) and each, stripped and in lower case, stands in the lower-case text of its
    page (page, text); white space isn't normalised, and of a page given twice the last text counts. False for nulls."""
    texts = F.map_from_entries(F.transform(last_per_page(page_texts), lambda x: F.struct(x["page"], F.lower(x["text"]))))
    found = F.forall(quotes, lambda q: F.coalesce((strip(q["quote"]) != "") & F.contains(F.try_element_at(texts, q["page"]), F.lower(strip(q["quote"]))), F.lit(False)))
    return F.coalesce((F.size(quotes) > 0) & found, F.lit(False))


def last_per_page(page_texts: Column) -> Column:
    """Page texts with the last entry of each page only, so that a map can be made of them under any session setting."""
    reverse = F.reverse(page_texts)
    pages = F.transform(reverse, lambda x: x["page"])
    return F.filter(F.transform(reverse, lambda x, k: F.when(F.array_position(pages, x["page"]) == k + 1, x)), lambda x: x.isNotNull())
