"""Stand-in inputs derived from the driver's test tables.

No test table holds facilities, so the facility inputs (a fossil tracker,
user shapes, a proxy raster, national statistics, satellite facilities and
tracker points) are derived from `orders`, `customer`, `nation`, `part`,
`supplier` and `lineitem` with integer arithmetic.  The same SQL text runs
in Spark and in DuckDB, so both engines see identical inputs; every stand-in
grows with the scale factor except the shapes (one set of regions per
nation, as a user's region file would be).

Placeholders `{orders}`, `{customer}`, ... name the base tables.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

#: Reference year used with the stand-ins (order dates run 1995-2001).
FIXTURE_YEAR = 1999

#: Technology map of the stand-in tracker (keys are order priorities).
FIXTURE_TECH_MAP = {
    "1-URGENT": "ccgt",
    "2-HIGH": "ocgt",
    "3-MEDIUM": "steam turbine",
    "4-NOT SPECIFIED": "reciprocating engine",
    "5-LOW": "igcc",
    "unknown": "ocgt",
}
FIXTURE_LIFETIMES = {"ccgt": 1, "ocgt": 2, "steam turbine": 3, "reciprocating engine": 4, "igcc": 6}
FIXTURE_DELAYS = {"ccgt": 1, "ocgt": 3, "steam turbine": 2, "reciprocating engine": 2, "igcc": 2}
#: Shape class wanted per technology in the stand-in (igcc goes offshore to force moves).
FIXTURE_SHAPE_CLASS = {
    "ccgt": "land",
    "ocgt": "land",
    "steam turbine": "land",
    "reciprocating engine": "land",
    "igcc": "maritime",
}
#: Band height (degrees) for the point-in-polygon index of the stand-in shapes.
FIXTURE_BAND = 2.0

# Fossil tracker rows ("oil-gas" layout, headers already normalised).
TRACKER_SQL = """
SELECT
  'L' || CAST(o.o_custkey AS STRING) AS gem_location_id,
  'G' || CAST(o.o_orderkey AS STRING) AS gem_unit_id,
  'Plant ' || CAST(o.o_custkey AS STRING) AS plant_name,
  CASE WHEN o.o_orderkey % 17 = 0 THEN CAST(NULL AS STRING)
       ELSE 'Unit ' || CAST(o.o_orderkey % 7 AS STRING) END AS unit_name,
  CASE WHEN o.o_orderkey % 53 = 0 THEN CAST(NULL AS DOUBLE)
       ELSE floor(o.o_totalprice) / 1000e0 END AS capacity_mw_raw,
  CASE o.o_orderkey % 10
       WHEN 0 THEN 'operating' WHEN 1 THEN 'operating' WHEN 2 THEN 'operating'
       WHEN 3 THEN 'retired' WHEN 4 THEN 'mothballed' WHEN 5 THEN 'construction'
       WHEN 6 THEN 'pre-construction' WHEN 7 THEN 'announced'
       WHEN 8 THEN 'shelved - inferred 2 y' ELSE 'cancelled' END AS status,
  CASE WHEN o.o_orderkey % 59 = 0 THEN CAST(NULL AS DOUBLE)
       ELSE ((o.o_orderkey * 6007) % 18000) / 100e0 - 90e0 + 0.0041e0 END AS latitude,
  ((o.o_orderkey * 7919 + o.o_custkey * 31) % 36000) / 100e0 - 180e0 + 0.0037e0 AS longitude,
  CASE WHEN o.o_orderkey % 41 = 0 THEN CAST(NULL AS STRING)
       WHEN o.o_orderkey % 43 = 0 THEN 'unknown type'
       WHEN o.o_orderkey % 13 = 0 THEN o.o_orderpriority || '/CCS'
       WHEN o.o_orderkey % 19 = 0 THEN o.o_orderpriority || ' '
       ELSE o.o_orderpriority END AS technology_raw,
  CASE WHEN o.o_orderkey % 97 = 0 THEN 'unknown'
       WHEN o.o_orderkey % 5 = 0 THEN CAST(NULL AS STRING)
       ELSE CAST(year(o.o_orderdate) AS STRING) END AS start_year_raw,
  CASE WHEN o.o_orderkey % 11 = 0
         THEN CAST(year(o.o_orderdate) + CASE WHEN o.o_orderkey % 2 = 0 THEN 2 ELSE 20 END AS STRING)
       WHEN o.o_orderkey % 89 = 0 THEN 'unknown'
       ELSE CAST(NULL AS STRING) END AS retired_year_raw,
  CASE WHEN o.o_orderkey % 7 = 0 THEN CAST(year(o.o_orderdate) + 30 AS STRING)
       ELSE CAST(NULL AS STRING) END AS planned_retire_raw,
  CASE o.o_orderkey % 6
       WHEN 0 THEN 'fossil gas: natural gas [60%], fossil liquids: diesel [40%]'
       WHEN 1 THEN 'coal'
       WHEN 2 THEN CAST(NULL AS STRING)
       WHEN 3 THEN 'other: other'
       WHEN 4 THEN 'bioenergy: wood & other biomass (solids),coal: lignite'
       ELSE 'fossil gas: LNG' END AS fuel_raw,
  CASE o.o_orderkey % 4
       WHEN 0 THEN 'bituminous' WHEN 1 THEN 'lignite' WHEN 2 THEN 'subbituminous with CCS'
       ELSE CAST(NULL AS STRING) END AS coal_type,
  CASE WHEN o.o_orderkey % 9 = 0 THEN 'bioenergy - paper mill wastes'
       ELSE CAST(NULL AS STRING) END AS alternate_fuel,
  CASE WHEN o.o_orderkey % 3 = 0 THEN 'yes' ELSE 'no' END AS chp_raw,
  CASE WHEN o.o_orderkey % 13 = 0 THEN 'yes' ELSE CAST(NULL AS STRING) END AS ccs_raw,
  CASE o.o_orderkey % 6
       WHEN 0 THEN 'Onshore' WHEN 1 THEN 'Offshore floating' WHEN 2 THEN 'Offshore hard mount'
       WHEN 3 THEN 'Offshore mount unknown' WHEN 4 THEN 'Unknown' ELSE CAST(NULL AS STRING) END AS installation_type,
  CASE o.o_orderkey % 5
       WHEN 0 THEN 'Canal' WHEN 1 THEN 'PS' WHEN 2 THEN 'ROR' WHEN 3 THEN 'STO'
       ELSE CAST(NULL AS STRING) END AS plant_type,
  ((o.o_orderkey % 7) - 2) / 10e0 AS res_vol_km3,
  'N' || lpad(CAST(c.c_nationkey AS STRING), 2, '0') AS nation_id
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

# Polygon templates relative to a nation's 72 x 36 degree cell.
# kind L: land octagon (+ a second part for every 4th nation); M: maritime
# rectangle with a hole (absent for every 5th nation); T: land square that
# overlaps L and M (every 7th nation, overlap view only).
_RINGS = [
    ("L", 0, 0, [(4, 12), (12, 4), (28, 4), (36, 12), (36, 24), (28, 32), (12, 32), (4, 24)]),
    ("L", 1, 0, [(16, 33), (24, 33), (24, 35), (16, 35)]),
    ("M", 0, 0, [(40, 4), (68, 4), (68, 32), (40, 32)]),
    ("M", 0, 1, [(50, 12), (58, 12), (58, 24), (50, 24)]),
    ("T", 0, 0, [(20, 16), (44, 16), (44, 30), (20, 30)]),
]


def _template_values() -> str:
    rows = []
    for kind, part, ring, pts in _RINGS:
        for seq, (a, b) in enumerate(zip(pts, pts[1:] + pts[:1])):
            rows.append(f"('{kind}', {part}, {ring}, {seq}, {a[0]}, {a[1]}, {b[0]}, {b[1]})")
    return "(VALUES " + ", ".join(rows) + ") AS t(kind, part, ring, seq, dx1, dy1, dx2, dy2)"


def shapes_sql(with_overlap: bool = False) -> str:
    parts = [
        """SELECT 'S' || lpad(CAST(n_nationkey AS STRING), 2, '0') || '_L' AS shape_id,
           'N' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS country_id,
           'land' AS shape_class, n_nationkey AS nk, 'L' AS kind FROM {nation}""",
        """SELECT 'S' || lpad(CAST(n_nationkey AS STRING), 2, '0') || '_M' AS shape_id,
           'N' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS country_id,
           'maritime' AS shape_class, n_nationkey AS nk, 'M' AS kind FROM {nation}
           WHERE n_nationkey % 5 <> 0""",
    ]
    if with_overlap:
        parts.append(
            """SELECT 'S' || lpad(CAST(n_nationkey AS STRING), 2, '0') || '_T' AS shape_id,
           'N' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS country_id,
           'land' AS shape_class, n_nationkey AS nk, 'T' AS kind FROM {nation}
           WHERE n_nationkey % 7 = 0"""
        )
    return "\nUNION ALL\n".join(parts)


def edges_sql(with_overlap: bool = False) -> str:
    return f"""
SELECT s.shape_id, t.part, t.ring, t.seq,
       -180e0 + 72e0 * (s.nk % 5) + t.dx1 AS x1,
       -90e0 + 36e0 * ((s.nk - s.nk % 5) / 5) + t.dy1 AS y1,
       -180e0 + 72e0 * (s.nk % 5) + t.dx2 AS x2,
       -90e0 + 36e0 * ((s.nk - s.nk % 5) / 5) + t.dy2 AS y2
FROM ({shapes_sql(with_overlap)}) s
JOIN {_template_values()} ON s.kind = t.kind
WHERE t.part = 0 OR s.nk % 4 = 0
"""


# Proxy raster: pixels of a 600 x 300 grid of 0.6-degree cells, one per part
# (parts beyond the grid's 180,000 cells share them).
PIXEL_ROWS, PIXEL_COLS = 300, 600
PIXELS_SQL = """
SELECT prow, pcol,
       -179.7e0 + 0.6e0 * pcol + 0.0017e0 AS x,
       89.7e0 - 0.6e0 * prow + 0.0023e0 AS y,
       avg(p_retailprice) AS value
FROM (SELECT (p_partkey * 7) % 300 AS prow,
             (p_partkey * 13 + CAST(floor(p_partkey / 300e0) AS BIGINT)) % 600 AS pcol, p_retailprice FROM {part}) p
GROUP BY prow, pcol
"""

_STAT_CATEGORIES = [
    "nuclear", "fossil fuels", "hydropower", "geothermal", "tide and wave",
    "solar", "wind", "biomass and waste", "pumped storage",
]


def _category_case(key: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_STAT_CATEGORIES))
    return f"CASE {key} % {len(_STAT_CATEGORIES)} {whens} END"


# National statistics by country, year and category (exact cent sums).
# N03 is missing, N04 fossil is zero, N06 fossil is null.  Solar is above the
# plants' sum for every third country, below it for the others, null for N07.
STATS_SQL = f"""
SELECT year, category,
       CASE WHEN country_id = 'N04' AND category = 'fossil fuels' THEN 0e0
            WHEN country_id = 'N06' AND category = 'fossil fuels' THEN CAST(NULL AS DOUBLE)
            WHEN country_id = 'N07' AND category = 'solar' THEN CAST(NULL AS DOUBLE)
            WHEN category = 'solar' AND CAST(substr(country_id, 2, 2) AS INT) % 3 = 0 THEN cents / 900e0
            ELSE cents / 90000e0 END AS capacity_mw,
       country_id
FROM (SELECT CAST(year(o.o_orderdate) AS INT) AS year,
             {_category_case('o.o_orderkey')} AS category,
             'N' || lpad(CAST(c.c_nationkey AS STRING), 2, '0') AS country_id,
             sum(CAST(round(o.o_totalprice * 100e0) AS BIGINT)) AS cents
      FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
      GROUP BY 1, 2, 3) s
WHERE country_id <> 'N03'
"""

# Satellite facility polygons: a 1-degree square around every supplier.
FACILITIES_SQL = """
SELECT 'F' || CAST(s_suppkey AS STRING) AS cluster_id,
       ((s_suppkey * 7907) % 34000) / 100e0 - 170e0 AS cx,
       ((s_suppkey * 3491) % 16000) / 100e0 - 80e0 AS cy,
       (abs(s_acctbal) + 1e0) / 100e0 AS capacity_mw,
       2015e0 + s_suppkey % 7 AS start_year,
       s_suppkey
FROM {supplier}
"""

FACILITY_EDGES_SQL = """
SELECT f.cluster_id AS shape_id, 0 AS part, 0 AS ring, t.seq,
       f.cx + t.dx1 AS x1, f.cy + t.dy1 AS y1, f.cx + t.dx2 AS x2, f.cy + t.dy2 AS y2
FROM ({facilities}) f
JOIN (VALUES (0, 1, -0.5e0, -0.5e0, 0.5e0, -0.5e0), (1, 1, 0.5e0, -0.5e0, 0.5e0, 0.5e0),
             (2, 1, 0.5e0, 0.5e0, -0.5e0, 0.5e0), (3, 1, -0.5e0, 0.5e0, -0.5e0, -0.5e0))
     AS t(seq, one, dx1, dy1, dx2, dy2) ON t.one = 1
"""

# Figures that break the rules for polygons, one per supplier: a five-pointed
# star drawn in one stroke (its ring crosses itself five times); every third
# one has a spike, every fourth a second ring in its middle, every fifth another
# part across an arm.
_STAR = [(0, 10), (6, -8), (-9, 3), (9, 3), (-6, -8)]
_STAR_RINGS = [
    ("sk % 3 <> 0", 0, 0, _STAR),
    ("sk % 3 = 0", 0, 0, [*_STAR, (-13, -8), (-6, -8)]),
    ("sk % 4 = 0", 0, 1, [(-1, -1), (1, -1), (1, 1), (-1, 1)]),
    ("sk % 5 = 0", 1, 0, [(3, -3), (12, -3), (12, 12), (3, 12)]),
]


def stars_sql() -> str:
    """Edge table of the stars (centres as those of the facilities)."""
    rings = []
    for where, part, ring, pts in _STAR_RINGS:
        edges = ", ".join(f"({i}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for i, (a, b) in enumerate(zip(pts, pts[1:] + pts[:1])))
        rings.append(f"""SELECT 'K' || CAST(sk AS STRING) AS shape_id, {part} AS part, {ring} AS ring, t.seq,
  cx + t.dx1 / 16e0 AS x1, cy + t.dy1 / 16e0 AS y1, cx + t.dx2 / 16e0 AS x2, cy + t.dy2 / 16e0 AS y2
FROM (SELECT s_suppkey AS sk, floor(cx) AS cx, floor(cy) AS cy FROM ({{facilities}}) f) f JOIN (VALUES {edges}) AS t(seq, dx1, dy1, dx2, dy2) ON {where}""")
    return "\nUNION ALL\n".join(rings)


# Solar tracker points scattered around the facilities of their supplier.
TRACKER_POINTS_SQL = """
SELECT 'GEM_' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_partkey AS STRING) || '-'
           || CAST(l.l_suppkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) || '-'
           || CAST(CAST(round(l.l_extendedprice * 100e0) AS BIGINT) AS STRING) AS powerplant_id,
       'Solar ' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) AS name,
       'solar' AS category,
       'utility pv' AS technology,
       ((l.l_suppkey * 7907) % 34000) / 100e0 - 170e0
           + ((l.l_partkey * 13 + l.l_linenumber * 7) % 140) / 100e0 - 0.7e0 + 0.0037e0 AS lon,
       ((l.l_suppkey * 3491) % 16000) / 100e0 - 80e0
           + ((l.l_orderkey * 11 + l.l_linenumber * 3) % 140) / 100e0 - 0.7e0 + 0.0041e0 AS lat,
       l.l_quantity AS output_capacity_mw,
       CAST(year(l.l_shipdate) AS DOUBLE) AS start_year,
       CASE WHEN l.l_linenumber % 3 = 0 THEN CAST(NULL AS DOUBLE)
            ELSE CAST(year(l.l_shipdate) + 20 + l.l_linenumber AS DOUBLE) END AS end_year,
       CASE l.l_linenumber % 4 WHEN 0 THEN 'operating' WHEN 1 THEN 'construction'
            WHEN 2 THEN 'retired' ELSE 'announced' END AS status
FROM {lineitem} l
"""


def render(sql: str, names: dict[str, str]) -> str:
    """Substitute base table names (and nested stand-ins) into a template."""
    mapping = {t: names.get(t, t) for t in BASE_TABLES}
    mapping["facilities"] = FACILITIES_SQL.format(**mapping)
    return sql.format(**mapping)


def duck(sql: str) -> str:
    """Render for DuckDB, where the base tables are registered views."""
    return render(sql, {})


def register_tables(spark: SparkSession, sf_dir: str, tables=BASE_TABLES) -> dict[str, str]:
    """Expose base tables of `sf_dir` as temp views, once a session and folder; returns the names."""
    folder = sf_dir.rstrip("/")
    tag = hashlib.md5(folder.encode()).hexdigest()[:12]
    names = {}
    for table in tables:
        names[table] = view = f"{table}_{tag}"
        if not spark.catalog.tableExists(view):
            spark.read.parquet(f"{folder}/{table}.parquet").createOrReplaceTempView(view)
    return names


def stand_in(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A stand-in as a Spark DataFrame over those tables of `sf_dir` that it names."""
    needed = [t for t in BASE_TABLES if f"{{{t}}}" in sql or (t == "supplier" and "{facilities}" in sql)]
    return spark.sql(render(sql, register_tables(spark, sf_dir, needed)))
