"""Line dedup by site-relative frequency: lines on too many pages of a host are boilerplate."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import WORD, as_rows, stored

# A line goes if it is on more than this share of its host's pages, and on so many at least.
MAX_SHARE, MIN_PAGES = 0.1, 5


def line_key(line: Column) -> Column:
    """128 bits, in hexadecimal, that tell lines apart, whatever blanks stand around them."""
    return F.md5(F.regexp_replace(line, "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", ""))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def has_word(line: Column) -> Column:
    return line.rlike(WORD)


def boilerplate(pages: DataFrame, max_share: float, min_pages: int) -> DataFrame:
    """(host, keys): for each host with boilerplate lines, the keys of these.

    `pages` has host and text of every page: one with a null text has no lines, but counts for its
    host. No text is shuffled: each page gives its distinct line keys, which are counted map-side by
    (host, line). A boilerplate line is on a fixed share of the pages, so a host has no more of them
    than a few times the lines of its average page.
    """
    totals = stored(pages.groupBy("host").agg(F.count("*").alias("total")), "totals")
    keys = F.array_distinct(F.transform(F.filter(lines_of(F.col("text")), has_word), line_key))
    lines = pages.select("host", F.explode(keys).alias("key")).select("host", F.unhex("key").alias("key"))
    counts = lines.groupBy("host", "key").agg(F.count("*").alias("on_pages")).where(F.col("on_pages") >= min_pages)
    frequent = counts.join(totals, "host").where(F.col("on_pages") > max_share * F.col("total"))
    return frequent.groupBy("host").agg(F.collect_set(F.lower(F.hex("key"))).alias("keys"))


def drop_boilerplate(
    docs: DataFrame, text: str = "text", host: str = "source",
    max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """(row, text, n_lines, n_dropped): each document's row with its text less boilerplate lines.

    The share of a line is the number of its host's pages that have it, over all pages of the host.
    Each row of `docs` is a page; repeated rows count each time. `min_pages` keeps a line of a host of
    few pages, where any line is on a large share of them: a host of one page has each line on all.
    Lines end at line feeds and are compared without blanks around them; lines without a word are
    neither counted nor dropped. Null is a host too. A null text stays null, without lines; a text may
    end up empty. `row` is the unchanged row, so no column name can clash. An empty table gives no rows.
    """
    rows = as_rows(docs).select("row", F.struct(F.col("row")[host].alias("name")).alias("host"))
    pages = rows.select("host", F.col("row")[text].alias("text"))
    found = stored(boilerplate(pages, max_share, min_pages), "boilerplate")
    split = rows.join(found, "host", "left").select("row", "keys", lines_of(F.col("row")[text]).alias("lines"))
    own = F.transform("lines", lambda line: F.when(has_word(line), line_key(line)).otherwise(F.lit("")))
    keyed = split.select("row", "lines", "keys", F.when(F.col("keys").isNotNull(), own).alias("own"))
    marked = keyed.select("row", "lines", "own", F.array_intersect("own", "keys").alias("bad"))
    kept = F.when(F.coalesce(F.size("bad"), F.lit(0)) <= 0, F.col("lines")).otherwise(
        F.filter("lines", lambda line, i: ~F.array_contains("bad", F.get("own", i))))
    cleaned = marked.select("row", "lines", kept.alias("left"))
    is_text = F.col("row")[text].isNotNull()
    return cleaned.select(
        "row", F.when(is_text, F.array_join("left", "\n")).alias("text"),
        F.when(is_text, F.size("lines")).otherwise(0).cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_dropped"),
    )
