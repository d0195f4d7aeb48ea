"""Line dedup: site-relative frequency.

Method: rows are grouped by host. The pages of a host that contain a line,
divided by the pages of the host, is the line's share there; lines above
``ratio`` (and met on ``min_pages`` pages at least) are boilerplate of that
host and are dropped from all its pages. A line is counted once a page. Where
copies are among the pages, ``page_col`` names what counts as one page: rows of
a host with the same value there count once, in the share and in the total. It
is a column of the rows or, with ``page_table``, of that table, which meets the
rows' line keys by its other columns.

A line's key is two 64-bit hashes of host and line (counts are by key); only
keys and places are shuffled, summed in each task first. The texts move once,
to meet their dropped places.

Defined results: null text stays null and has no lines; blank lines are never
dropped; a null host is one host of its own; rows that repeat are separate
pages; equal ids do not matter. ``n_lines`` and ``n_dropped`` replace input
columns of the same name; other columns are passed on. An empty table gives
no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import replace_columns

# Tags that end a line of text.
BLOCK_TAGS = ("html|head|body|title|nav|header|footer|article|section|aside|main|div|p|br|hr|h[1-6]|ul|ol|li|dl|dt|dd|"
              "table|tr|td|th|blockquote|pre|form")


def html_lines(html: Column) -> Column:
    """Text of a page, a line for each block element; blank lines left out."""
    text = F.regexp_replace(html, "(?is)<(script|style)[^>]*>.*?</(script|style)>", "")
    text = F.regexp_replace(text, f"(?i)</?({BLOCK_TAGS})( [^>]*)?/?>", "\n")
    text = F.regexp_replace(text, "<[^>]*>", "")
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def _address() -> dict[str, Column]:
    """Address of a row: two hashes of host and lines."""
    return {"a1": F.xxhash64("host", "lines"), "a2": F.xxhash64("lines", "host", F.lit("lines"))}


def drop_boilerplate(docs: DataFrame, host_col: str, text_col: str = "text", ratio: float = 0.1,
                     min_pages: int = 10, page_col: str | None = None, page_table: DataFrame | None = None) -> DataFrame:
    """``docs`` with the boilerplate lines gone from the text, and n_lines
    (lines that are not blank) and n_dropped; ``page_col`` and the columns of
    ``page_table`` are not passed on."""
    on = [] if page_table is None else [c for c in page_table.columns if c != page_col]
    fields = [c for c in docs.columns if c != page_col and c not in on]
    others = [F.col(f"`{c}`") for c in fields if c.lower() != text_col.lower()]
    own = ["host"] + ([] if page_col is None else ["page"])
    page = [] if page_col is None or on else [F.col(f"`{page_col}`").alias("page")]
    rows = docs.select(
        F.struct(*(others or [F.lit(0)])).alias("row"), *page, *[F.col(f"`{c}`") for c in on],
        F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("\0")).alias("host"),
        F.split(F.col(f"`{text_col}`"), "\n").alias("lines"), F.col(f"`{text_col}`").alias("text"))
    # Rows with the same host and text lose the same lines: they share an address.
    rows = rows.withColumns(_address())
    addr = list(_address())
    written = F.filter("lines", lambda x: F.trim(x) != "")

    def keyed(line: Column) -> list[Column]:
        return [F.xxhash64("host", line).alias("h1"), F.xxhash64(line, "host", F.lit("line")).alias("h2")]

    met = rows
    if on:      # a row's line keys are two arrays of numbers, not a row each
        once = F.array_distinct(written)
        met = rows.select("host", *on, F.transform(once, lambda x: keyed(x)[0]).alias("h1"),
                          F.transform(once, lambda x: keyed(x)[1]).alias("h2"))
        met = met.join(page_table.withColumnRenamed(page_col, "page"), on, "left")
        seen = met.select(*own, F.explode(F.arrays_zip("h1", "h2")).alias("key")).select(*own, "key.h1", "key.h2")
    else:
        seen = rows.select(*own, F.explode(F.array_distinct(written)).alias("line")).select(*own, *keyed(F.col("line")))
    pages = met.select(*own)
    if page_col is not None:
        seen, pages = seen.distinct(), pages.distinct()
    counts = seen.groupBy("host", "h1", "h2").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    boiler = counts.join(totals, "host").filter(F.col("pages") > ratio * F.col("total")).select("h1", "h2")
    placed = rows.select(*addr, "host", F.posexplode("lines").alias("at", "line")).filter(F.trim("line") != "")
    gone = placed.select(*addr, "at", *keyed(F.col("line"))).join(boiler, ["h1", "h2"], "left_semi") \
        .groupBy(*addr).agg(F.collect_set("at").alias("gone"))
    # The texts move once and whole; they are cut into lines again where they meet their places.
    out = rows.select("row", "text", *addr).join(gone, addr, "left").withColumn("lines", F.split("text", "\n"))
    drop = F.coalesce(F.array_sort("gone"), F.array().cast("array<int>"))
    # What stands between dropped places, piece by piece: linear in the lines.
    kept = F.expr("""flatten(transform(sequence(0, size(drop)), i ->
        slice(lines, if(i = 0, 0, drop[i - 1] + 1) + 1, if(i = size(drop), size(lines), drop[i]) - if(i = 0, 0, drop[i - 1] + 1))))""")
    kept = F.when(F.size("drop") == 0, F.col("lines")).otherwise(kept)
    out = out.withColumn("drop", drop)
    new = {"n_lines": F.coalesce(F.size(written), F.lit(0)).cast("long"), "n_dropped": F.size("drop").cast("long")}
    cols = replace_columns("row", [c for c in fields if c.lower() != text_col.lower()], new)
    text = F.when(F.col("lines").isNotNull(), F.array_join(kept, "\n")).alias(text_col)
    order = [c for c in fields if c.lower() not in new]
    return out.select(text, *cols).select(*[F.col(f"`{c}`") for c in order], *new)
