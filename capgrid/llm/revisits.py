"""Resolving not-modified WARC revisit records.

A revisit is matched, by canonical URL, to the latest full response fetched
before it (an as-of join); its validators are checked against that
response's, and the header fields that a not-modified answer may update are
merged into the stored ones.

The as-of join is a two-level scan.  Time is cut at percentiles, so a slice
of time holds about one `slices`-th of all records whatever their URLs.
Within (URL, slice) a running maximum gives the latest earlier response; the
last response of each (URL, slice) is carried to the URL's later slices over a
table with at most `slices` rows a URL.  So a URL that a third of all records
share is scanned by many tasks, and no pairs are made.

Defined results (`outcome`).  `response`: not a revisit.  `resolved`: entity
tags agree (weak comparison), or, where one side has none, the last-modified
dates do.  `mismatch`: they differ.  `unverified`: nothing to compare.
`no_response`: no earlier full response; also for a revisit without URL or
time.  Only `resolved` rows get merged headers.  Of responses fetched at the same time
the greatest record id counts as the latest; a response fetched at the
revisit's own time is not earlier.  Repeated rows each keep their row.
Extra columns are carried; result columns replace same-named ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capgrid.llm import common

#: Fields that a not-modified answer carries for the stored response (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
SLICES = 64


def header(headers: Column, name: str) -> Column:
    """Value of a field in an array of (name, value) with lower-case names; null when absent."""
    return F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["value"]


def weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def merge(stored: Column, update: Column, permitted=PERMITTED) -> Column:
    """Stored fields that the update does not replace, then its permitted fields, sorted by name."""
    allowed = F.filter(update, lambda h: h["name"].isin(*permitted))
    names = F.transform(allowed, lambda h: h["name"])
    return F.array_sort(F.concat(F.filter(stored, lambda h: ~F.array_contains(names, h["name"])), allowed))


def resolve(records: DataFrame, key: Column, time_col: str = "fetch_time", id_col: str = "record_id", revisit_col: str = "is_revisit", headers_col: str = "headers", slices: int = SLICES) -> DataFrame:
    """Records with `outcome`, `refers_to` (record id) and `merged_headers`.

    `headers_col` is an array of (name, value) structs with lower-case names;
    `time_col` is integral.
    """
    records = common.without(records, "outcome", "refers_to", "merged_headers")
    own = {n: common.fresh(n, records.columns) for n in ("asof_key", "asof_slice", "asof_full", "asof_last", "asof_carry")}
    k, s, full, last, carry = own.values()
    wanted = [i / slices for i in range(1, slices)]
    points = records.agg(F.percentile_approx(time_col, F.array(*map(F.lit, wanted)), F.lit(10_000)).alias("p")).first()["p"] or []
    cuts = F.array(*[F.lit(int(p)) for p in sorted(set(points))]) if points else F.array().cast("array<bigint>")
    headers = F.coalesce(F.col(headers_col), F.array().cast("array<struct<name:string,value:string>>"))
    response = F.struct(F.col(time_col).alias("time"), F.col(id_col).alias("id"), headers.alias("headers"))
    is_full = ~F.coalesce(F.col(revisit_col), F.lit(False)) & F.col(time_col).isNotNull() & key.isNotNull()
    rows = records.withColumns({k: key, s: F.size(F.filter(cuts, lambda c: c < F.col(time_col))), full: F.when(is_full, response)})
    inside = Window.partitionBy(k, s).orderBy(time_col).rangeBetween(Window.unboundedPreceding, -1)
    usable = F.col(k).isNotNull() & F.col(time_col).isNotNull()
    # records that cannot match are spread by their id, so that they form no hot group
    rows = rows.withColumn(s, F.when(usable, F.col(s)).otherwise(-1 - F.pmod(F.xxhash64(id_col), F.lit(1 << 16)).cast("int")))
    rows = rows.withColumn(last, F.max(full).over(inside))
    summary = rows.filter(usable).groupBy(F.col(k).alias("c_key"), F.col(s).alias("c_slice")).agg(F.max(full).alias("last"))
    earlier = Window.partitionBy("c_key").orderBy("c_slice").rowsBetween(Window.unboundedPreceding, -1)  # at most `slices` rows a key
    carried = summary.select("c_key", "c_slice", F.max("last").over(earlier).alias(carry)).filter(F.col(carry).isNotNull())
    joined = rows.join(carried, (F.col(k) == F.col("c_key")) & (F.col(s) == F.col("c_slice")), "left").drop("c_key", "c_slice")
    found = F.coalesce(F.col(last), F.col(carry))
    tag, stored_tag = weak(header(headers, "etag")), weak(header(found["headers"], "etag"))
    date, stored_date = header(headers, "last-modified"), header(found["headers"], "last-modified")
    agree = F.when(tag.isNotNull() & stored_tag.isNotNull(), tag == stored_tag).when(date.isNotNull() & stored_date.isNotNull(), date == stored_date)
    outcome = (
        F.when(~F.coalesce(F.col(revisit_col), F.lit(False)), "response")
        .when(found.isNull() | ~usable, "no_response")
        .when(agree.isNull(), "unverified")
        .when(agree, "resolved")
        .otherwise("mismatch")
    )
    out = joined.withColumn("outcome", outcome)
    out = out.withColumn("refers_to", F.when(F.col("outcome").isin("resolved", "mismatch", "unverified"), found["id"]))
    out = out.withColumn("merged_headers", F.when(F.col("outcome") == "resolved", merge(found["headers"], headers)))
    return out.drop(*own.values())
