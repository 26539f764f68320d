"""Captures that Spark derives from the `pages` table, for the WARC and URL-list queries.

Each page is fetched `FETCHES` times.  Its records, the list entries and all
days follow from its id, URL and a hash of its HTML by the same SQL in Spark
and in DuckDB, so the work grows with the pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capgrid.llm.url_lists import TRACKING, canonical_url, host_of

FETCHES = 4

#: A page's fetches, seven days apart: the first is a full response unless the id is divisible by 11, the last
#: again where it is divisible by 3 (new content); the others are revisits, some with another entity tag.
_RECORDS = """
SELECT page_id * 4 + k AS record_id,
       CASE WHEN k = 2 THEN concat(url, '#again') ELSE url END AS url,
       (page_id * 7919) % 604800 + k * 604800 + 1700000000 AS fetch_time,
       NOT ((k = 0 AND page_id % 11 <> 0) OR (k = 3 AND page_id % 3 = 0)) AS is_revisit,
       CASE WHEN page_id % 5 = 0 THEN NULL WHEN k = 1 AND page_id % 13 = 0 THEN '"changed"'
            WHEN k = 2 THEN concat('W/"', substr(md5(html), 1, 16), '"') ELSE concat('"', substr(md5(html), 1, 16), '"') END AS etag,
       CASE WHEN page_id % 7 = 0 THEN NULL ELSE concat('day ', CAST(page_id % 28 AS {text})) END AS modified,
       CAST(length(html) AS {text}) AS size,
       concat('max-age=', CAST(60 * (k + 1) AS {text})) AS caching,
       concat('time ', CAST(k AS {text})) AS fetched
FROM (SELECT page_id, url, html, {each} AS k FROM pages)
"""


def warc_records(pages: DataFrame) -> DataFrame:
    """(record_id, url, fetch_time, is_revisit, headers) for every fetch of every page."""
    spark = pages.sparkSession
    sql = _RECORDS.replace("FROM pages", "FROM {pages}").format(text="STRING", each="explode(sequence(0, 3))", pages="{pages}")
    records = spark.sql(sql, pages=pages)
    return records.selectExpr(
        "record_id", "url", "fetch_time", "is_revisit",
        """filter(array(
             named_struct('name', 'cache-control', 'value', caching), named_struct('name', 'connection', 'value', if(is_revisit, 'close', 'keep-alive')),
             named_struct('name', 'content-length', 'value', if(is_revisit, '0', size)), named_struct('name', 'content-type', 'value', if(is_revisit, null, 'text/html')),
             named_struct('name', 'date', 'value', fetched), named_struct('name', 'etag', 'value', etag), named_struct('name', 'last-modified', 'value', modified)
           ), h -> h.value is not null) AS headers""",
    )


_HOST = r"""nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)), '^www\.', ''), '')"""
_PORT = r"""CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?[^/?#:@]*:0*([0-9]+)(?:[/?#]|$)', 1) IN ('', CASE lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) WHEN 'http' THEN '80' WHEN 'https' THEN '443' ELSE '' END)
  THEN '' ELSE ':' || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?[^/?#:@]*:0*([0-9]+)(?:[/?#]|$)', 1) END"""
_PAGE = _HOST + " || " + _PORT + r""" || regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/+$', '')"""
_PARAMS = r"""list_sort(list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(split_part(p, '=', 1)), '""" + TRACKING + "')))"
_KEY = _PAGE + f" || CASE WHEN len({_PARAMS}) > 0 THEN '?' || array_to_string({_PARAMS}, '&') ELSE '' END"

REVISIT_ORACLE = f"""
WITH records AS ({_RECORDS.format(text="VARCHAR", each="unnest(generate_series(0, 3))")}),
keyed AS (SELECT *, {_KEY} AS url_key FROM records),
latest AS (
  SELECT DISTINCT ON (url_key, fetch_time) * FROM keyed WHERE NOT is_revisit AND url_key IS NOT NULL AND fetch_time IS NOT NULL
  ORDER BY url_key, fetch_time, record_id DESC
),
matched AS (
  SELECT r.*, f.record_id AS f_id, f.etag AS f_etag, f.modified AS f_modified, f.size AS f_size, f.caching AS f_caching
  FROM keyed r ASOF LEFT JOIN latest f ON r.url_key = f.url_key AND r.fetch_time > f.fetch_time
),
judged AS (
  SELECT *, CASE WHEN NOT is_revisit THEN 'response' WHEN f_id IS NULL THEN 'no_response'
    WHEN etag IS NOT NULL AND f_etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(f_etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
    WHEN modified IS NOT NULL AND f_modified IS NOT NULL THEN CASE WHEN modified = f_modified THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unverified' END AS outcome
  FROM matched
)
SELECT record_id, url, fetch_time, outcome,
  CASE WHEN outcome IN ('resolved', 'mismatch', 'unverified') THEN f_id END AS refers_to,
  CASE WHEN outcome = 'resolved' THEN concat_ws(chr(10), 'cache-control: ' || caching, 'connection: keep-alive', 'content-length: ' || f_size, 'content-type: text/html',
    'date: ' || fetched, 'etag: ' || coalesce(etag, f_etag), 'last-modified: ' || coalesce(modified, f_modified)) END AS merged_headers
FROM judged
"""

#: Days count from the first fetch.  Hosts, the domain above some of them, and single URLs are listed, taken off and listed again.
_EVENTS = """
SELECT CASE WHEN substr(code, 1, 1) < '8' THEN 'malware' ELSE 'adult' END AS list, host AS key, CASE WHEN n = 1 THEN 'remove' ELSE 'add' END AS action,
       CAST(n * 9 + length(host) % 5 AS INT) AS day
FROM (SELECT host, md5(host) AS code, {steps} AS n FROM hosts WHERE host IS NOT NULL) AS h WHERE substr(code, 2, 1) < 'c'
UNION ALL
SELECT 'suffix', regexp_replace(host, '^[^.]*[.]', ''), CASE WHEN length(host) % 2 = 0 THEN 'add' ELSE 'remove' END, CAST(20 + length(host) % 7 AS INT)
FROM hosts WHERE length(host) % 3 = 0
UNION ALL
SELECT CASE WHEN page_id % 2 = 0 THEN 'spam' ELSE 'malware' END, key, 'add', CAST(page_id % 25 AS INT) FROM urls WHERE page_id % 7 = 0
UNION ALL
SELECT CASE WHEN page_id % 2 = 0 THEN 'spam' ELSE 'malware' END, key, 'remove', CAST(page_id % 25 + page_id % 9 AS INT) FROM urls WHERE page_id % 14 < 8 AND page_id % 7 = 0
"""


def list_events(pages: DataFrame) -> DataFrame:
    """Dated additions and removals (list, key, action, day)."""
    spark = pages.sparkSession
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), canonical_url(F.col("url")).alias("key"))
    hosts = urls.select("host").distinct()
    sql = _EVENTS.replace("FROM hosts", "FROM {hosts}").replace("FROM urls", "FROM {urls}").format(steps="explode(sequence(0, 2))", hosts="{hosts}", urls="{urls}")
    return spark.sql(sql, hosts=hosts, urls=urls)


def page_visits(pages: DataFrame) -> DataFrame:
    """(page_id, visit, url, day): every page fetched four times, seven days apart."""
    return pages.selectExpr("page_id", "url", f"explode(sequence(0, {FETCHES - 1})) AS visit").selectExpr("page_id", "visit", "url", "CAST(page_id % 7 + visit * 7 AS INT) AS day")


LISTS_ORACLE = f"""
WITH urls AS (SELECT page_id, {_HOST} AS host, {_KEY} AS key FROM pages),
hosts AS (SELECT DISTINCT host FROM urls),
events AS ({_EVENTS.format(steps="unnest(generate_series(0, 2))")}),
daily AS (SELECT list, key, day, bool_or(action = 'add') AS active FROM events WHERE key IS NOT NULL AND day IS NOT NULL GROUP BY ALL),
visits AS (SELECT page_id, url, {_HOST} AS host, {_PAGE} AS page_key, {_KEY} AS url_key, unnest(generate_series(0, 3)) AS visit FROM pages),
dated AS (SELECT *, CAST(page_id % 7 + visit * 7 AS INT) AS day, row_number() OVER () AS row_id FROM visits),
parts AS (SELECT row_id, day, string_split(host, '.') AS p FROM dated WHERE host IS NOT NULL),
keys AS (
  SELECT row_id, day, array_to_string(list_slice(p, i, len(p)), '.') AS key FROM (SELECT *, unnest(generate_series(1, len(p))) AS i FROM parts)
  UNION ALL SELECT row_id, day, page_key FROM dated WHERE regexp_matches(page_key, '[/:]')
  UNION ALL SELECT row_id, day, url_key FROM dated WHERE url_key <> page_key
),
names AS (SELECT DISTINCT list FROM daily),
asked AS (SELECT keys.*, names.list FROM keys, names),
active AS (
  SELECT a.row_id, a.list FROM asked a ASOF JOIN daily d ON a.key = d.key AND a.list = d.list AND a.day >= d.day WHERE d.active
),
listed AS (SELECT row_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM active GROUP BY row_id)
SELECT page_id, visit::INT AS visit, url, day, coalesce(lists, '') AS lists, coalesce(lists, '') <> '' AS blocked
FROM dated LEFT JOIN listed USING (row_id)
"""
