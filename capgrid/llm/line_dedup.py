"""Line removal by site-relative frequency.

Per host: pages that contain a line (each page counts once), divided by the
host's pages.  A line is boilerplate, and is cut from every page of the host,
if it is on more than `ratio` of the host's pages beyond chance: its pages, less the square
root that such a count scatters by, must exceed the ratio.  So one page is
never enough, 6 of 50 pages are, 3 of 10, and on hosts of some hundred pages the ratio
itself decides; no host is left out.

The ratio 0.065 lies in the gap measured on the documents' sources (500 to
93,000 pages each): the boilerplate line is on 8.6 to 13.4 % of each one's pages,
the next ordinary line on at most 4.8 %, passages that pages share on at most
6.3 %.  What stands for the host is a column of the caller's: the registered query has only
`documents.source`; tables with URLs pass `url_lists.host_of(url)`.

Lines are counted by a 128-bit hash (two seeds), so line texts are not
shuffled; the count is summed on the map side first, so one line that every
page has costs no more than another.  A host can have at most (mean distinct
lines of a page) / ratio boilerplate lines, so they fit in one array per host, which joins
back to the pages; the pages' texts are shuffled only when the arrays of all
hosts are too large to broadcast (measured).

Defined results.  Lines end at a line feed; lines that are empty or hold spaces
only are kept and not counted.  Null text stays null (no lines); a null host is a host of
its own.  A text whose lines all go becomes empty.  Repeated rows count as
pages each.  Extra columns are carried; empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capgrid.llm import common

RATIO = 0.065


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _code(line: Column) -> Column:
    """128-bit hash of a line as a struct."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2"))


def _has_word(line: Column) -> Column:
    return F.length(F.trim(line)) > 0


def boilerplate(docs: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO) -> DataFrame:
    """(host, codes): one row per host that has boilerplate lines."""
    pages = docs.select(host.alias("host"), F.col(text_col).alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    codes = F.array_distinct(F.transform(F.filter(lines(F.col("text")), _has_word), _code))
    counted = pages.select("host", F.explode(codes).alias("code")).groupBy("host", "code").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    often = counted.join(totals.withColumnRenamed("host", "total_host"), F.col("host").eqNullSafe(F.col("total_host"))).filter(F.col("n") - F.sqrt("n") > F.lit(ratio) * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("code").alias("codes"))


def drop_boilerplate(docs: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO, counts: tuple[str, str] | None = None) -> DataFrame:
    """`docs` with the boilerplate lines of their hosts cut from `text_col`; `counts` names columns for lines before and lines cut."""
    frequent = common.cut(boilerplate(docs, host, text_col, ratio))
    frequent = common.broadcast_if_small(frequent, F.size("codes") * 32 + 64)
    key, codes = common.fresh("host_key", docs.columns), common.fresh("host_codes", docs.columns)
    side = frequent.select(F.col("host").alias(key + "_side"), F.col("codes").alias(codes))
    joined = docs.withColumn(key, host).join(side, F.col(key).eqNullSafe(F.col(key + "_side")), "left")
    kept = F.filter(lines(F.col(text_col)), lambda line: ~(_has_word(line) & F.array_contains(F.col(codes), _code(line))))
    out = joined
    if counts:
        before = F.coalesce(F.size(lines(F.col(text_col))), F.lit(0)).cast("long")
        after = F.when(F.col(codes).isNull(), before).otherwise(F.coalesce(F.size(kept), F.lit(0)).cast("long"))
        out = out.withColumns({counts[0]: F.when(F.col(text_col).isNull(), 0).otherwise(before), counts[1]: F.when(F.col(text_col).isNull(), 0).otherwise(before - after)})
    cleaned = F.when(F.col(codes).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return out.withColumn(text_col, cleaned).drop(key, key + "_side", codes)
