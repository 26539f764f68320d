"""URL filtering by dated lists: every capture is judged by the entries active when it was fetched.

Dated additions and removals become one event per (list, key, day) — a day
with an addition is active, whatever else is dated on it — and runs of events
become validity intervals [valid_from, valid_to).  A key is a canonical URL or
a host; a host entry covers the hosts below it, a URL entry without a query
the page under every query, one with a query that query alone.

All intervals of a key go into one array (at most lists x change days long),
so the as-of join is an equi-join on the key with a time test inside the row:
no pairs of captures and entries are made, and a host that a third of all
captures share only makes the capture side of a join large, which Spark
splits.  A host's array already holds the intervals of the hosts above it, so
a capture needs three look-ups: host, page and, where it has a query, URL.

Defined results.  A capture without a URL or day is on no list.  Entries
without list, key, action or day are ignored.  An entry that was never removed
stays valid.  Repeated captures each keep their row; repeated events count
once.  Extra columns are carried; result columns replace same-named ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capgrid.llm import common

#: A day after every date: `valid_to` of entries still in force.
OPEN_END = 2_147_483_647
#: Names of parameters that tell where a visit came from and do not select content (whole name, lower case).
TRACKING = r"^(utm_[^=]*|fbclid|gclid|dclid|msclkid|yclid|mc_cid|mc_eid|igshid)$"
#: A looser key also takes `ref` for tracking and `.html` for no part of the path: right on many sites, wrong on others.
LOOSE_TRACKING = TRACKING.replace("^(", "^(ref|")


def host_of(url: Column) -> Column:
    """Lower-case host without port, user or a leading `www.`; null when there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def port_of(url: Column) -> Column:
    """`:port` where it is given and not the scheme's default, else empty."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?[^/?#:@]*:0*([0-9]+)(?=[/?#]|$)", 1)
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    default = (authority == "") | ((scheme == "http") & (authority == "80")) | ((scheme == "https") & (authority == "443"))
    return F.when(default, "").otherwise(F.concat(F.lit(":"), authority))


def query_of(url: Column, loose: bool = False) -> Column:
    """`?` and the parameters that select content, sorted, without `TRACKING` names; empty when there are none."""
    given = F.split(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(given, lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).rlike(LOOSE_TRACKING if loose else TRACKING)))
    return F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")


def page_url(url: Column, loose: bool = False) -> Column:
    """Host, non-default port and path without scheme, fragment, query or trailing slash (`loose`: or `.html`); null without a host."""
    path = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1), r"/+$", "")
    return F.concat(host_of(url), port_of(url), F.regexp_replace(path, r"\.html$", "") if loose else path)


def canonical_url(url: Column, loose: bool = False) -> Column:
    """`page_url` and its sorted query without tracking parameters; null without a host."""
    return F.concat(page_url(url, loose), query_of(url, loose))


def intervals(events: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) from events (list, key, action, day)."""
    usable = events.filter(F.col("list").isNotNull() & F.col("key").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove"))
    daily = usable.groupBy("list", "key", "day").agg(F.max(F.col("action") == "add").alias("on"))
    timeline = Window.partitionBy("list", "key").orderBy("day")  # at most one row a day
    turns = daily.withColumn("before", F.coalesce(F.lag("on").over(timeline), F.lit(False))).filter("on <> before")
    return turns.withColumn("valid_to", F.coalesce(F.lead("day").over(timeline), F.lit(OPEN_END))).filter("on").select("list", "key", F.col("day").alias("valid_from"), "valid_to")


def _by_key(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.collect_set(F.struct("list", "valid_from", "valid_to")).alias("spans"))


def parents(host: Column) -> Column:
    """The host and every host above it."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def evaluate(captures: DataFrame, events: DataFrame, url_col: str = "url", day_col: str = "day", loose: bool = False) -> DataFrame:
    """Captures with `lists` (sorted names of the lists active at fetch time) and `blocked`; `loose` as in `canonical_url`, for which the entries' keys must then be made."""
    captures = common.without(captures, "lists", "blocked")
    entries = common.cut(_by_key(intervals(events)))
    size = F.size("spans") * 48 + 128
    host, page, url = (common.fresh(n, captures.columns) for n in ("host_key", "page_key", "url_key"))
    full, bare = canonical_url(F.col(url_col), loose), page_url(F.col(url_col), loose)
    keyed = captures.withColumns({host: host_of(F.col(url_col)), page: bare, url: F.when(full != bare, full)})
    hosts = keyed.select(F.col(host).alias("host")).filter(F.col(host).isNotNull()).distinct()
    above = hosts.select("host", F.explode(parents(F.col("host"))).alias("key")).join(entries, "key")
    by_host = above.groupBy("host").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("host_spans"))
    by_host = common.broadcast_if_small(common.cut(by_host), F.size("host_spans") * 48 + 128)
    urls = entries.filter(F.col("key").rlike("[/?:]"))
    by_page = common.broadcast_if_small(urls.filter(~F.col("key").contains("?")), size).select(F.col("key").alias("entry_page"), F.col("spans").alias("page_spans"))
    by_url = common.broadcast_if_small(urls.filter(F.col("key").contains("?")), size).select(F.col("key").alias("entry_key"), F.col("spans").alias("url_spans"))
    joined = keyed.join(by_host.withColumnRenamed("host", "entry_host"), F.col(host) == F.col("entry_host"), "left")
    joined = joined.join(by_page, F.col(page) == F.col("entry_page"), "left").join(by_url, F.col(url) == F.col("entry_key"), "left")
    none = F.array().cast("array<struct<list:string,valid_from:int,valid_to:int>>")
    active = F.filter(
        F.concat(F.coalesce("host_spans", none), F.coalesce("page_spans", none), F.coalesce("url_spans", none)),
        lambda s: (s["valid_from"] <= F.col(day_col)) & (F.col(day_col) < s["valid_to"]),
    )
    names = F.array_sort(F.array_distinct(F.transform(active, lambda s: s["list"])))
    return joined.withColumn("lists", F.array_join(names, ",")).drop(host, page, url, "entry_host", "entry_page", "entry_key", "host_spans", "page_spans", "url_spans").withColumn("blocked", F.col("lists") != "")
