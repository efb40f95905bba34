"""Boilerplate lines by site-relative frequency, in DataFrame operations only.

A line's pages on a site are divided by all pages of the site; a line over the boilerplate ratio
is dropped from every page of that site. Lines are counted once per page and grouped by site and
128-bit digest with map-side combining, so a hot site or line collapses before the shuffle, and
no line's text is shuffled.

A site's boilerplate is small by nature: at most (lines per page) / (ratio) lines can exceed the
ratio. It is carried as one list per site and each page is cleaned where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, written

#: A line on more than this share of a site's pages is boilerplate, if it is on at least so many.
RATIO, MIN_LINE_PAGES = 0.05, 5
#: Sites with fewer pages are left alone: there a share says nothing.
MIN_PAGES = 10
#: Boilerplate lines (16 bytes each) up to which the lists are broadcast; beyond, they are joined by a shuffle.
BROADCAST_LINES = 500_000
#: A line of more words than this is a passage: it is kept in one document only.
PASSAGE_WORDS = 50

_DROPPED_ELEMENTS = r"(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>"
_BREAKS = r"(?i)<br\s*/?>|</?(?:p|div|li|ul|ol|nav|article|section|header|footer|aside|main|h[1-6]|table|tr|td|th|title|body|head|html|blockquote|pre|form)\b[^>]*>"
_TAGS = r"<[^>]*>"
#: The entities that are turned into text, `&amp;` last.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def html_text(html: Column) -> Column:
    """Visible text of a web page, a line per block element."""
    text = F.regexp_replace(html, _DROPPED_ELEMENTS, " ")
    text = F.regexp_replace(F.regexp_replace(text, _BREAKS, "\n"), _TAGS, "")
    for entity, character in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def host(url: Column) -> Column:
    """Host of a URL in lower case; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _digest(line: Column) -> Column:
    """What makes lines equal: their characters without outer white space; null for a blank line."""
    bare = F.trim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.unhex(F.md5(bare)))


def boilerplate(df: DataFrame, site: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                min_line_pages: int = MIN_LINE_PAGES) -> DataFrame:
    """(site, digest, pages, site_pages) of the lines over the ratio. Rows without a site have none."""
    placed = df.where(F.col(site).isNotNull()).select(F.col(site).alias("site"), F.col(text).alias("text"))
    totals = placed.groupBy("site").agg(F.count("*").alias("site_pages")).where(F.col("site_pages") >= min_pages)
    counts = (placed.select("site", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _digest))).alias("digest"))
              .where("digest is not null").groupBy("site", "digest").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_line_pages))
    return counts.join(totals, "site").where(F.col("pages") > F.lit(ratio) * F.col("site_pages"))


def drop_boilerplate(df: DataFrame, site: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                     min_line_pages: int = MIN_LINE_PAGES) -> DataFrame:
    """`df` with `text` cleaned, and the columns n_lines and n_dropped.

    Blank lines stay and count as lines. A row with a null text keeps it (no lines); a row without
    a site, or of a site with fewer than `min_pages` rows, keeps its text. No row is dropped, also
    if all its lines are. Repeated rows count as pages each. Columns n_lines and n_dropped of `df` are
    replaced, all others stay.
    """
    lines = written(boilerplate(df, site, text, ratio, min_pages, min_line_pages), "boilerplate")
    lists = written(lines.groupBy(F.col("site").alias("_site")).agg(F.collect_list("digest").alias("_drop")), "boilerplate-lists")
    if lines.count() <= BROADCAST_LINES:
        lists = F.broadcast(lists)
    place, drop, all_lines, kept = fresh(df, "_site", "_drop", "_lines", "_kept")
    lists = lists.withColumnsRenamed({"_site": place, "_drop": drop})
    joined = df.join(lists, df[site] == lists[place], "left").withColumn(all_lines, _lines(F.col(text)))
    cleaned = joined.withColumn(kept, F.when(F.col(drop).isNull(), F.col(all_lines)).otherwise(
        F.filter(all_lines, lambda line: ~F.coalesce(F.array_contains(drop, _digest(line)), F.lit(False)))))
    n_lines = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(all_lines)).cast("bigint")
    n_kept = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(kept)).cast("bigint")
    cleaned = cleaned.withColumns({"n_lines": n_lines, "n_dropped": n_lines - n_kept})
    cleaned = cleaned.withColumn(text, F.when(F.col(text).isNotNull(), F.array_join(kept, "\n")))
    return cleaned.drop(place, drop, all_lines, kept)


def _passages(text: Column, min_words: int) -> Column:
    """Digests of the lines of more than `min_words` words, each once."""
    # A line with so many words has a character and a gap for each, at least.
    long = F.filter(_lines(text), lambda line: (F.length(line) > 2 * min_words) & (F.regexp_count(line, F.lit(r"\S+")) > min_words))
    return F.array_distinct(F.transform(long, _digest))


def drop_repeats(df: DataFrame, id_column: str, text: str, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """`df` with `text` without the passages that an earlier row has, and the column n_repeats of lines dropped.

    A passage is a line of more than `min_words` words. Rows are ordered by id, those without one last,
    then by text hash; the first row with a passage keeps it, also twice, and a row that repeats it does, too.
    Lines are counted by digest with map-side combining; no list of them is broadcast. No row is dropped.
    """
    own_id, own_hash, drop, all_lines, kept = fresh(df, "_id", "_hash", "_drop", "_lines", "_kept")
    doc = F.struct(F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), F.xxhash64(text).alias("hash"))
    passages = written(df.select(doc.alias("doc"), F.explode(_passages(F.col(text), min_words)).alias("digest")), "passages")
    first = passages.groupBy("digest").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = passages.join(first, "digest").where("first < doc").groupBy("doc").agg(F.collect_set("digest").alias(drop))
    later = written(later.select(F.col("doc.id").alias(own_id), F.col("doc.hash").alias(own_hash), drop), "repeats")
    same = [df[id_column].eqNullSafe(later[own_id]), F.xxhash64(df[text]) == later[own_hash]]
    joined = df.join(later, same, "left").withColumn(all_lines, F.when(F.col(drop).isNotNull(), _lines(F.col(text))))
    cleaned = joined.withColumn(kept, F.filter(all_lines, lambda line: ~F.coalesce(F.array_contains(drop, _digest(line)), F.lit(False))))
    n_repeats = F.when(F.col(drop).isNull(), F.lit(0)).otherwise(F.size(all_lines) - F.size(kept))
    cleaned = cleaned.withColumn("n_repeats", n_repeats.cast("bigint"))
    cleaned = cleaned.withColumn(text, F.when(F.col(drop).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    return cleaned.drop(own_id, own_hash, drop, all_lines, kept)
