"""Registered queries: one per operator / job of the inventory, each with an
independent DuckDB oracle where SQL can express it.

Every query reads the driver's test tables through the stand-ins of
`fixtures` (so its work grows with the scale factor) and returns its values
as computed, without rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capgrid import config as C
from capgrid.functions import columns as X
from capgrid.functions.fuels import parse_fuel_set
from capgrid.operators import capacity, fuel_classes, geometry, impute, overlay, quality, pixel_shares, raster, reports, rings
from capgrid.operators.place import place_inside, relocate
from capgrid.plans import categories as P
from capgrid.plans import fixtures as FX
from capgrid.plans import sql_oracle as O
from capgrid.session import cut_lineage, small
from capgrid.sources import clustered
from capgrid.sources import readers as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


# ---------------------------------------------------------------------------
# Spark stand-ins
# ---------------------------------------------------------------------------
OG_FIXTURE_COLS = {
    "capacity": "capacity_mw_raw", "technology": "technology_raw", "start": "start_year_raw",
    "retired": "retired_year_raw", "planned_retire": "planned_retire_raw", "fuel": "fuel_raw",
    "ccs": "ccs_raw", "chp": "chp_raw", "location_id": "gem_location_id", "unit_id": "gem_unit_id",
}
COAL_FIXTURE_COLS = dict(OG_FIXTURE_COLS, unit_id="coal_unit_id")


def tracker(spark, d):
    return FX.stand_in(spark, d, FX.TRACKER_SQL)


def og_plants(spark, d, with_country: bool = True):
    raw = tracker(spark, d)
    keep = ("nation_id",) if with_country else ()
    plants, classes = P.prepare_oil_gas(raw, FX.FIXTURE_TECH_MAP, cols=OG_FIXTURE_COLS, keep=keep)
    if with_country:
        plants = plants.withColumnRenamed("nation_id", "country_id")
    return plants, classes


def coal_raw(spark, d):
    own = F.when(F.col("status") == "pre-construction", F.lit("permitted")).otherwise(F.col("status"))
    return tracker(spark, d).withColumn("status", own).withColumn("coal_unit_id", F.concat(F.lit("C"), F.expr("substring(gem_unit_id, 2)")))


def shapes(spark, d, overlap=False):
    return FX.stand_in(spark, d, FX.shapes_sql(overlap)), FX.stand_in(spark, d, FX.edges_sql(overlap))


def stats(spark, d):
    return FX.stand_in(spark, d, FX.STATS_SQL)


def pixels(spark, d):
    return FX.stand_in(spark, d, FX.PIXELS_SQL)


def aged_plants(spark, d):
    plants, _ = og_plants(spark, d)
    return impute.impute_time(plants, "construction", FX.FIXTURE_LIFETIMES, FX.FIXTURE_DELAYS, FX.FIXTURE_YEAR)


B = FX.FIXTURE_BAND
Y = FX.FIXTURE_YEAR
PLANT_OUT = ["powerplant_id", "name", "category", "technology", "output_capacity_mw", "start_year", "end_year", "status", "lon", "lat"]


def _sel(cols):
    return ", ".join(cols)


# ---------------------------------------------------------------------------
# A: sources
# ---------------------------------------------------------------------------
@query(
    "A1_union_sheets",
    O.ctes(tracker=O.TRACKER, tp=FX.duck(FX.TRACKER_POINTS_SQL))
    + """SELECT gem_unit_id AS id, status, CAST(NULL AS DOUBLE) AS output_capacity_mw FROM tracker
UNION ALL SELECT CAST(NULL AS VARCHAR), status, output_capacity_mw FROM tp""",
)
def a1(spark, d):
    sheet1 = tracker(spark, d).select(F.col("gem_unit_id").alias("id"), "status")
    sheet2 = FX.stand_in(spark, d, FX.TRACKER_POINTS_SQL).select("status", "output_capacity_mw")
    return R.union_sheets([sheet1, sheet2])


@query("A2_normalise_columns", "SELECT * FROM orders")
def a2(spark, d):
    df = spark.read.parquet(f"{d}/orders.parquet")
    messy = df.toDF(*[f"  {c.upper().replace('_', ' ')} " for c in df.columns])
    return R.normalise_columns(messy)


@query("A3_drop_invalid_status", O.ctes(tracker=O.TRACKER) + "SELECT gem_unit_id, status FROM tracker WHERE NOT coalesce(regexp_matches(status, 'cancelled|shelved'), false)")
def a3(spark, d):
    return R.drop_invalid_status(tracker(spark, d)).select("gem_unit_id", "status")


@query("A4_drop_missing", O.ctes(tracker=O.TRACKER) + "SELECT gem_unit_id FROM (" + O.CLEAN + ")")
def a4(spark, d):
    t = R.drop_invalid_status(tracker(spark, d))
    return R.drop_missing(t, ["capacity_mw_raw", "latitude", "longitude"]).select("gem_unit_id")


SERIES_CATS = list(C.EIA_CATEGORY_IDS)


def raw_series(spark, d):
    """Series rows (series_id, data) built from the statistics stand-in; N09 lacks 'tide and wave'."""
    st = stats(spark, d)
    total = st.groupBy("year", "country_id").agg(F.sum("capacity_mw").alias("capacity_mw")).withColumn("category", F.lit("total"))
    allst = st.unionByName(total).where(~((F.col("country_id") == "N09") & (F.col("category") == "tide and wave")))
    ids = X.map_literal({k: str(v) for k, v in C.EIA_CATEGORY_IDS.items()})
    pair = F.array(F.col("year").cast("string"), F.coalesce((F.col("capacity_mw") / 1000).cast("string"), F.lit("NA")))
    return allst.groupBy("country_id", "category").agg(F.collect_list(pair).alias("data")).select(
        F.concat(F.lit("INTL."), F.element_at(ids, F.col("category")), F.lit("-7-"), F.col("country_id"), F.lit("-MK.A")).alias("series_id"),
        "data",
    )


STATS_ALL = """SELECT * FROM stats UNION ALL
SELECT year, 'total' AS category, sum(capacity_mw) AS capacity_mw, country_id FROM stats GROUP BY year, country_id"""


@query(
    "A6_read_series",
    O.ctes(**O.STATS, st=STATS_ALL)
    + "SELECT 'INTL.' || " + O.case_map("category", {k: str(v) for k, v in C.EIA_CATEGORY_IDS.items()})
    + " || '-7-' || country_id || '-MK.A' AS series_id, year, capacity_mw / 1000 AS value FROM st WHERE NOT (country_id = 'N09' AND category = 'tide and wave')",
)
def a6(spark, d):
    return R.explode_series(raw_series(spark, d))


# ---------------------------------------------------------------------------
# B: column expressions
# ---------------------------------------------------------------------------
def _clean_tracker(spark, d):
    return R.drop_missing(R.drop_invalid_status(tracker(spark, d)), ["capacity_mw_raw", "latitude", "longitude"])


CLEAN_CTE = O.ctes(tracker=O.TRACKER, clean=O.CLEAN)


@query("B1_combined_text", CLEAN_CTE + "SELECT 'GEM_' || gem_location_id || '-' || gem_unit_id AS powerplant_id, plant_name || '-' || coalesce(unit_name, 'nan') AS name FROM clean")
def b1(spark, d):
    t = _clean_tracker(spark, d)
    return t.select(
        X.combined_text(["gem_location_id", "gem_unit_id"], prefix="GEM_").alias("powerplant_id"),
        X.combined_text(["plant_name", "unit_name"]).alias("name"),
    )


@query("B2_coerce_year", CLEAN_CTE + "SELECT gem_unit_id, TRY_CAST(start_year_raw AS DOUBLE) AS start_year FROM clean")
def b2(spark, d):
    return _clean_tracker(spark, d).select("gem_unit_id", X.coerce_year("start_year_raw").alias("start_year"))


@query("B3_map_status", CLEAN_CTE + f"SELECT gem_unit_id, {O.case_map('status', C.STATUS_MAPPING)} AS status, {O.case_map('status', C.STATUS_MAPPING_COAL)} AS status_coal FROM clean")
def b3(spark, d):
    t = _clean_tracker(spark, d)
    return t.select("gem_unit_id", X.map_status("status", C.STATUS_MAPPING).alias("status"), X.map_status("status", C.STATUS_MAPPING_COAL).alias("status_coal"))


@query("B4_map_technology", CLEAN_CTE + f"SELECT gem_unit_id, {O.tech_sql('technology_raw', FX.FIXTURE_TECH_MAP)} AS technology FROM clean")
def b4(spark, d):
    return _clean_tracker(spark, d).select("gem_unit_id", X.map_technology("technology_raw", FX.FIXTURE_TECH_MAP).alias("technology"))


@query(
    "B6_end_year_actual_or_planned",
    CLEAN_CTE + "SELECT gem_unit_id, CASE WHEN retired_year_raw IS NOT NULL THEN TRY_CAST(retired_year_raw AS DOUBLE) ELSE TRY_CAST(planned_retire_raw AS DOUBLE) END AS end_year FROM clean",
)
def b6(spark, d):
    return _clean_tracker(spark, d).select("gem_unit_id", X.first_present_number("retired_year_raw", "planned_retire_raw").alias("end_year"))


@query(
    "B8_year_of_mixed_date",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS DOUBLE) AS year FROM orders",
)
def b8(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    text = (
        F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "MMMM yyyy"))
        .when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy"))
    )
    return o.select("o_orderkey", X.year_of_mixed_date(text).alias("year"))


@query(
    "B9_midpoint_year",
    """SELECT o.o_orderkey, CAST(year(make_timestamp(epoch_us(o.o_orderdate)
        + CAST(floor((epoch_us(l.s) - epoch_us(o.o_orderdate)) / 2e0) AS BIGINT))) AS DOUBLE) AS start_year
FROM orders o JOIN (SELECT l_orderkey, max(l_shipdate) AS s FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey""",
)
def b9(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    li = spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("s"))
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    return j.select("o_orderkey", X.midpoint_year("o_orderdate", "s").alias("start_year"))


@query(
    "B10_ccs_chp_flags",
    CLEAN_CTE + """SELECT gem_unit_id, coalesce(ccs_raw = 'yes', false) AS ccs, coalesce(chp_raw = 'yes', false) AS chp,
 (coalesce(contains(technology_raw, 'CCS'), false) OR coalesce(contains(coal_type, 'CCS'), false)) AS coal_ccs FROM clean""",
)
def b10(spark, d):
    t = _clean_tracker(spark, d)
    return t.select("gem_unit_id", X.yes_flag("ccs_raw").alias("ccs"), X.yes_flag("chp_raw").alias("chp"), X.contains_flag("technology_raw", "coal_type").alias("coal_ccs"))


@query("B11_coal_fuel_text", CLEAN_CTE + f"SELECT gem_unit_id, {O.COAL_TEXT} AS fuel_text FROM clean")
def b11(spark, d):
    return _clean_tracker(spark, d).select("gem_unit_id", X.coal_fuel_text("coal_type", "alternate_fuel").alias("fuel_text"))


@query(
    "B12_B14_wind_market_fields",
    """SELECT 'WEMI_' || CAST(o_orderkey AS VARCHAR) AS powerplant_id, floor(o_totalprice) * 0.001e0 AS output_capacity_mw,
  CAST(year(o_orderdate) AS DOUBLE) AS start_year,
  CASE WHEN o_orderstatus = 'F' THEN 'offshore' ELSE 'onshore' END AS technology FROM orders""",
)
def b12(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    commissioning = F.concat(F.lit("Commissioned "), F.date_format("o_orderdate", "MM/yyyy"))
    shore = F.when(F.col("o_orderstatus") == "F", F.lit("Yes (12 km)")).otherwise(F.lit("No"))
    return o.select(
        X.with_prefix("WEMI_", "o_orderkey").alias("powerplant_id"),
        X.kw_to_mw(F.floor("o_totalprice")).alias("output_capacity_mw"),
        X.first_year_in_text(commissioning).alias("start_year"),
        X.offshore_flag(shore).alias("technology"),
    )


@query(
    "B5_B18_solar_capacity",
    """SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice / 1.25e0 ELSE o_totalprice END AS output_capacity_mw,
  CASE WHEN o_orderkey % 5 = 4 THEN 'Solar Thermal' WHEN o_orderkey % 5 = 3 THEN 'PV' ELSE 'Assumed PV' END AS solar_type
FROM orders""",
)
def b5(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    rating = F.when(F.col("o_orderkey") % 3 == 0, F.lit("MWac")).when(F.col("o_orderkey") % 3 == 1, F.lit("MWp/dc")).otherwise(
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("unknown"))
    )
    stype = F.when(F.col("o_orderkey") % 5 == 4, F.lit("Solar Thermal")).when(F.col("o_orderkey") % 5 == 3, F.lit("PV"))
    return o.select(
        "o_orderkey",
        X.ac_capacity("o_totalprice", rating, 1.25).alias("output_capacity_mw"),
        X.solar_type(stype).alias("solar_type"),
    )


@query("B7_start_year_conversion_first", CLEAN_CTE + "SELECT gem_unit_id, CASE WHEN planned_retire_raw IS NOT NULL THEN TRY_CAST(planned_retire_raw AS DOUBLE) ELSE TRY_CAST(start_year_raw AS DOUBLE) END AS start_year FROM clean")
def b7(spark, d):
    return _clean_tracker(spark, d).select("gem_unit_id", X.first_present_number("planned_retire_raw", "start_year_raw").alias("start_year"))


@query("B13_first_year_in_text", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(year(o_orderdate) AS DOUBLE) END AS year FROM orders")
def b13(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    text = F.when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "'in Q'q yyyy', then 2050'")).when(F.col("o_orderkey") % 3 == 2, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.lit("no 123 year"))
    return o.select("o_orderkey", X.first_year_in_text(text).alias("year"))


@query(
    "B15_wind_technology",
    CLEAN_CTE + f"SELECT gem_unit_id, {O.case_map(O.case_map('installation_type', C.WIND_INSTALLATION_MAPPING), C.TECHNOLOGY_MAPPING['wind'])} AS technology FROM clean WHERE installation_type <> 'Unknown'",
)
def b15(spark, d):
    cols = {"capacity": "capacity_mw_raw", "installation": "installation_type", "start": "start_year_raw", "retired": "retired_year_raw", "location_id": "gem_location_id", "unit_id": "gem_unit_id", "plant_name": "plant_name", "unit_name": "unit_name"}
    return P.prepare_wind_tracker(tracker(spark, d), cols=cols).select(F.regexp_extract("powerplant_id", "-(G.*)$", 1).alias("gem_unit_id"), "technology")


@query("B16_non_negative_or_null", CLEAN_CTE + "SELECT gem_unit_id, CASE WHEN res_vol_km3 >= 0 THEN res_vol_km3 END AS reservoir_km3 FROM clean")
def b16(spark, d):
    return _clean_tracker(spark, d).select("gem_unit_id", X.non_negative_or_null("res_vol_km3").alias("reservoir_km3"))


@query("B19_id_prefix", "SELECT 'TZ-SAM_' || CAST(s_suppkey AS VARCHAR) AS powerplant_id, 'TZ-SAM cluster ' || CAST(s_suppkey AS VARCHAR) AS name FROM supplier")
def b19(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet")
    return s.select(X.with_prefix("TZ-SAM_", "s_suppkey").alias("powerplant_id"), X.with_prefix("TZ-SAM cluster ", "s_suppkey").alias("name"))


# ---------------------------------------------------------------------------
# C, D: filters and fuel classes
# ---------------------------------------------------------------------------
PLANTS_CTE = O.ctes(**O.BASE)


@query(
    "C1_filter_years",
    PLANTS_CTE + f"""SELECT powerplant_id,
  coalesce(start_year <= {Y} AND {Y} < end_year, false) AS operating,
  coalesce(start_year > {Y}, false) AS future, coalesce({Y} >= end_year, false) AS past FROM og_plants""",
)
def c1(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    return p.select(
        "powerplant_id",
        *[F.coalesce(X.year_predicate(Y, h), F.lit(False)).alias(h) for h in ("operating", "future", "past")],
    )


@query("C3_positive_capacity", CLEAN_CTE + "SELECT gem_unit_id FROM clean WHERE capacity_mw_raw > 0")
def c3(spark, d):
    return _clean_tracker(spark, d).where(F.col("capacity_mw_raw") > 0).select("gem_unit_id")


@query("D1_parse_fuel_set", O.ctes(tracker=O.TRACKER, og_clean=O.OG_CLEAN) + "SELECT gem_unit_id, array_to_string(fuels, '|') AS fuels FROM og_clean")
def d1(spark, d):
    t = _clean_tracker(spark, d)
    return t.select("gem_unit_id", F.array_join(parse_fuel_set("fuel_raw", C.FUEL_MAPPING, "fossil gas: unknown"), "|").alias("fuels"))


@query("D2_encode_sets", PLANTS_CTE + "SELECT fuel_class, unnest(fuels) AS fuel FROM og_codes")
def d2(spark, d):
    _, classes = og_plants(spark, d, with_country=False)
    return classes


@query("D3_harmonise_classes", O.ctes(**O.BASE, **O.COAL, **O.BIO, fc_classes=O.FC_CLASSES) + "SELECT fuel_class, unnest(fuels) AS fuel FROM fc_classes")
def d3(spark, d):
    return burners(spark, d)[2]


def burners(spark, d):
    """(bioenergy, fossil, classes) of the three burner trackers."""
    bio_cols = dict(OG_FIXTURE_COLS, conversion="planned_retire_raw", unit_id="gem_unit_id", plant_name="plant_name")
    return P.prepare_burners(
        tracker(spark, d), tracker(spark, d), coal_raw(spark, d), FX.FIXTURE_TECH_MAP, FX.FIXTURE_TECH_MAP,
        bio_cols=bio_cols, og_cols=OG_FIXTURE_COLS, coal_cols=COAL_FIXTURE_COLS,
    )


@query(
    "P2_prepare_fossil",
    O.ctes(**O.BASE, **O.COAL, **O.BIO, fc_classes=O.FC_CLASSES, fossil=O.FOSSIL)
    + f"SELECT {_sel(PLANT_OUT)}, ccs, chp, fuel_class FROM fossil",
)
def p2(spark, d):
    return burners(spark, d)[1].select(*PLANT_OUT, "ccs", "chp", "fuel_class")


@query(
    "C2_scenario_filter",
    O.ctes(**O.BASE) + "\nUNION ALL\n".join(f"SELECT '{name}' AS scenario, powerplant_id FROM og_plants WHERE status IN ({', '.join(repr(v) for v in values)})" for name, values in (
        ("historical", ("operating", "retired")), ("construction", ("operating", "retired", "construction")),
        ("pre_construction", ("operating", "retired", "construction", "pre-construction")), ("announced", ("operating", "retired", "construction", "pre-construction", "announced")))),
)
def c2(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    parts = [impute.scenario_filter(p, name).select(F.lit(name).alias("scenario"), "powerplant_id") for name in ("historical", "construction", "pre_construction", "announced")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("C4_stats_in_category_year", O.ctes(**O.STATS) + f"SELECT country_id, category, capacity_mw FROM stats WHERE year = {Y} AND category IN ('hydropower', 'pumped storage')")
def c4(spark, d):
    return stats(spark, d).where(X.stats_category_predicate(Y, C.EIA_CAT_MAPPING["hydropower"])).select("country_id", "category", "capacity_mw")


@query(
    "D4_remap_classes",
    O.ctes(**O.BASE, **O.COAL, **O.BIO, fc_classes=O.FC_CLASSES) + "SELECT p.powerplant_id, f.fuel_class FROM coal_plants p JOIN coal_codes c USING (fuel_class) JOIN fc_classes f USING (fuels)",
)
def d4(spark, d):
    coal, coal_classes = P.prepare_coal(coal_raw(spark, d), FX.FIXTURE_TECH_MAP, cols=COAL_FIXTURE_COLS)
    return fuel_classes.remap_classes(coal, coal_classes, burners(spark, d)[2]).select("powerplant_id", "fuel_class")


def _equal_earth_sql(lon: str, lat: str) -> tuple[str, str]:
    """Equal Earth on the WGS 84 ellipsoid, written from its published formulas and constants (a, 1/f, A1 to A4)."""
    flat = "(1e0 / 298.257223563e0)"
    e2 = f"({flat} * (2 - {flat}))"
    e = f"sqrt({e2})"
    authalic = lambda s: f"((1 - {e2}) * ({s} / (1 - {e2} * {s} * {s}) - ln((1 - {e} * {s}) / (1 + {e} * {s})) / (2 * {e})))"
    pole = authalic("1e0")
    radius = f"(6378137e0 * sqrt({pole} / 2))"
    beta = f"asin(least(greatest({authalic(f'sin(radians({lat}))')} / {pole}, -1e0), 1e0))"
    th = f"asin(sqrt(3e0) / 2 * sin({beta}))"
    slope = f"(1.340264e0 - 3 * 0.081106e0 * power({th}, 2) + 7 * 0.000893e0 * power({th}, 6) + 9 * 0.003796e0 * power({th}, 8))"
    x = f"2 * sqrt(3e0) / 3 * {radius} * radians({lon}) * cos({th}) / {slope}"
    y = f"{radius} * (1.340264e0 * {th} - 0.081106e0 * power({th}, 3) + 0.000893e0 * power({th}, 7) + 0.003796e0 * power({th}, 9))"
    return x, y


_EE_X, _EE_Y = _equal_earth_sql("lon", "lat")


# ---------------------------------------------------------------------------
# E: geometry
# ---------------------------------------------------------------------------
GEO_CTE = O.ctes(**O.BASE, **O.SHAPES)


@query("E3_points_in_shapes", GEO_CTE + O.pip("og_plants", "edges", "lon", "lat", "powerplant_id"))
def e3(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    _, e = shapes(spark, d)
    return geometry.points_in_shapes(p.select("powerplant_id", "lon", "lat"), e, B, x="lon", y="lat").select("powerplant_id", "shape_id")


@query(
    "E4_points_within_shapes",
    O.ctes(**O.FAC) + O.pip("tracker_points", "facility_edges", "lon", "lat", "powerplant_id", boundary="exclude"),
)
def e4(spark, d):
    tp = FX.stand_in(spark, d, FX.TRACKER_POINTS_SQL)
    fe = FX.stand_in(spark, d, FX.FACILITY_EDGES_SQL)
    return geometry.points_in_shapes(tp.select("powerplant_id", "lon", "lat"), fe, 0.5, x="lon", y="lat", boundary="exclude").select("powerplant_id", "shape_id")


BUFFER = 0.05
FUTURE = "('announced', 'pre-construction', 'construction', 'retired')"


@query(
    "E5_anti_within_distance",
    O.ctes(**O.FAC, fut=f"SELECT * FROM tracker_points WHERE status IN {FUTURE}",
           inside=O.pip("fut", "facility_edges", "lon", "lat", "powerplant_id"),
           near=f"SELECT DISTINCT p.powerplant_id FROM fut p JOIN facility_edges e ON p.lat BETWEEN least(e.y1, e.y2) - {BUFFER} AND greatest(e.y1, e.y2) + {BUFFER} WHERE {O.seg_dist('p.lon', 'p.lat')} <= {BUFFER}")
    + "SELECT powerplant_id FROM fut WHERE powerplant_id NOT IN (SELECT powerplant_id FROM inside) AND powerplant_id NOT IN (SELECT powerplant_id FROM near)",
)
def e5(spark, d):
    tp = FX.stand_in(spark, d, FX.TRACKER_POINTS_SQL)
    fe = FX.stand_in(spark, d, FX.FACILITY_EDGES_SQL)
    fut = tp.where(F.col("status").isin("announced", "pre-construction", "construction", "retired"))
    near = geometry.points_within_distance(fut.select("powerplant_id", "lon", "lat"), fe, BUFFER, 0.5, x="lon", y="lat", pairs=False)
    return fut.join(near.select("powerplant_id"), on="powerplant_id", how="left_anti").select("powerplant_id")


NEAREST_SQL = (
    GEO_CTE.replace("WITH ", "WITH ", 1)
    + ", inside AS (" + O.pip("og_plants", "edges", "lon", "lat", "powerplant_id") + "),\n"
    + f"""d AS (SELECT p.powerplant_id, s.shape_id,
    CASE WHEN i.shape_id IS NOT NULL THEN 0e0 ELSE min({O.seg_dist('p.lon', 'p.lat')}) END AS distance
  FROM og_plants p JOIN shapes s ON s.country_id = p.country_id AND s.shape_class = 'land'
  JOIN edges e ON e.shape_id = s.shape_id
  LEFT JOIN inside i ON i.powerplant_id = p.powerplant_id AND i.shape_id = s.shape_id
  GROUP BY p.powerplant_id, s.shape_id, i.shape_id)
SELECT powerplant_id, arg_min(shape_id, (distance, shape_id)) AS shape_id, min(distance) AS distance FROM d GROUP BY 1"""
)


@query("E6_nearest_shape", NEAREST_SQL)
def e6(spark, d):
    p, _ = og_plants(spark, d)
    s, e = shapes(spark, d)
    pts = p.select("powerplant_id", "lon", "lat", "country_id").withColumn("shape_class", F.lit("land"))
    near = geometry.nearest_shape(pts, s, e, x="lon", y="lat", band=B)
    return near.select("powerplant_id", "shape_id", "distance")


REP_SQL = """
ext AS (SELECT shape_id, (min(least(y1, y2)) + max(greatest(y1, y2))) / 2 AS cy FROM edges GROUP BY 1),
scan AS (SELECT e.shape_id,
    CASE WHEN max(CASE WHEN e.y1 > x.cy THEN NULL ELSE e.y1 END) IS NULL THEN min(CASE WHEN e.y1 > x.cy THEN e.y1 END)
         WHEN min(CASE WHEN e.y1 > x.cy THEN e.y1 END) IS NULL THEN max(CASE WHEN e.y1 <= x.cy THEN e.y1 END)
         ELSE (max(CASE WHEN e.y1 <= x.cy THEN e.y1 END) + min(CASE WHEN e.y1 > x.cy THEN e.y1 END)) / 2 END AS sy
  FROM edges e JOIN ext x USING (shape_id) GROUP BY 1),
xs AS (SELECT e.shape_id, s.sy, e.x1 + (s.sy - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) AS cx
  FROM edges e JOIN scan s USING (shape_id) WHERE (e.y1 > s.sy) <> (e.y2 > s.sy)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY shape_id ORDER BY cx) AS rn FROM xs),
spans AS (SELECT a.shape_id, a.sy, b.cx - a.cx AS w, (a.cx + b.cx) / 2 AS mx, a.rn
  FROM ranked a JOIN ranked b ON a.shape_id = b.shape_id AND b.rn = a.rn + 1 WHERE a.rn % 2 = 1)
SELECT shape_id, arg_max(mx, (w, -rn)) AS rx, any_value(sy) AS ry FROM spans GROUP BY 1"""


@query("E8_representative_point", O.ctes(**O.SHAPES).rstrip() + "," + REP_SQL)
def e8(spark, d):
    _, e = shapes(spark, d)
    return geometry.representative_points(e)


E10_SQL = (
    NEAREST_SQL.replace(
        "SELECT powerplant_id, arg_min(shape_id, (distance, shape_id)) AS shape_id, min(distance) AS distance FROM d GROUP BY 1",
        "",
    ).rstrip()
    + f""",
best AS (SELECT powerplant_id, arg_min(shape_id, (distance, shape_id)) AS shape_id FROM d GROUP BY 1),
pinside AS (SELECT p.powerplant_id, e.shape_id, e.part,
    sum(CASE WHEN (e.y1 > p.lat) <> (e.y2 > p.lat) AND p.lon < e.x1 + (p.lat - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) % 2 = 1 AS ins
  FROM og_plants p JOIN best b USING (powerplant_id) JOIN edges e ON e.shape_id = b.shape_id AND p.lat BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)
  GROUP BY 1, 2, 3),
pd AS (SELECT p.powerplant_id, e.shape_id, e.part,
    CASE WHEN coalesce(any_value(pi.ins), false) THEN 0e0 ELSE min({O.seg_dist('p.lon', 'p.lat')}) END AS dd
  FROM og_plants p JOIN best b USING (powerplant_id) JOIN edges e ON e.shape_id = b.shape_id
  LEFT JOIN pinside pi ON pi.powerplant_id = p.powerplant_id AND pi.part = e.part
  GROUP BY 1, 2, 3)
SELECT powerplant_id, shape_id, arg_min(part, (dd, part)) AS part FROM pd GROUP BY 1, 2"""
)


@query("E10_nearest_part", E10_SQL)
def e10(spark, d):
    p, _ = og_plants(spark, d)
    s, e = shapes(spark, d)
    pts = p.select("powerplant_id", "lon", "lat", "country_id").withColumn("shape_class", F.lit("land"))
    near = geometry.nearest_shape(pts, s, e, x="lon", y="lat", band=B)
    return near.select("powerplant_id", "shape_id", "part")


OV_CTE = O.ctes(**O.BASE, **O.SHAPES_OV, m=O.pip("og_plants", "edges_ov", "lon", "lat", "powerplant_id"))


@query("E12_detect_overlaps", OV_CTE + "SELECT powerplant_id, shape_id FROM m WHERE powerplant_id IN (SELECT powerplant_id FROM m GROUP BY 1 HAVING count(*) > 1)")
def e12(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    _, e = shapes(spark, d, overlap=True)
    m = geometry.points_in_shapes(p.select("powerplant_id", "lon", "lat"), e, B, x="lon", y="lat")
    return geometry.detect_overlaps(m).select("powerplant_id", "shape_id")


@query(
    "E13_split_capacity",
    OV_CTE
    + """, j AS (SELECT m.powerplant_id, m.shape_id, p.output_capacity_mw,
    count(*) OVER (PARTITION BY m.powerplant_id) AS n,
    row_number() OVER (PARTITION BY m.powerplant_id ORDER BY m.shape_id) - 1 AS k
  FROM m JOIN og_plants p USING (powerplant_id))
SELECT CASE WHEN n > 1 THEN powerplant_id || '_duplicate_' || CAST(k AS VARCHAR) ELSE powerplant_id END AS powerplant_id,
  shape_id, CASE WHEN n > 1 THEN output_capacity_mw / n ELSE output_capacity_mw END AS output_capacity_mw, n > 1 AS split FROM j""",
)
def e13(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    _, e = shapes(spark, d, overlap=True)
    m = geometry.points_in_shapes(p.select("powerplant_id", "lon", "lat", "output_capacity_mw"), e, B, x="lon", y="lat")
    return geometry.split_capacity(m).select("powerplant_id", "shape_id", "output_capacity_mw", "split")


TARGET = {"igcc": "maritime"}


@query(
    "E14_require_target_shape",
    O.ctes(**O.BASE, **O.SHAPES)
    + """SELECT technology, country_id, 'maritime' AS target_shape_class, count(*) AS count FROM og_plants p
WHERE technology = 'igcc' AND NOT EXISTS (SELECT 1 FROM shapes s WHERE s.country_id = p.country_id AND s.shape_class = 'maritime')
GROUP BY 1, 2""",
)
def e14(spark, d):
    p, _ = og_plants(spark, d)
    s, _ = shapes(spark, d)
    cand = p.withColumn("target_shape_class", F.try_element_at(X.map_literal(TARGET), F.col("technology"))).where(F.col("target_shape_class").isNotNull())
    _, missing = geometry.require_target_shape(cand, s, "drop")
    return geometry.missing_shape_summary(missing)


@query(
    "E16_assign_country",
    GEO_CTE + ", m AS (" + O.pip("og_plants", "edges", "lon", "lat", "powerplant_id") + ")\n"
    + "SELECT m.powerplant_id, s.country_id, m.shape_id FROM m JOIN shapes s USING (shape_id)",
)
def e16(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    s, e = shapes(spark, d)
    return geometry.assign_country(p, s, e, B).select("powerplant_id", "country_id", "shape_id")


#: A ring that passes through itself, added to the shapes for the polygon checks.
_BOW = [("BOW", 0, 0, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip([(0, 0), (4, 4), (4, 0), (0, 1)], [(4, 4), (4, 0), (0, 1), (0, 0)]))]


def _side(p, e):
    return f"sign(({e}.x2 - {e}.x1) * ({p[1]} - {e}.y1) - ({e}.y2 - {e}.y1) * ({p[0]} - {e}.x1))"


@query(
    "E17_polygon_checks",
    O.ctes(**O.SHAPES_OV, every="SELECT * FROM edges_ov UNION ALL SELECT * FROM (VALUES " + ", ".join(f"('BOW', 0, 0, {r[3]}, {r[4]}, {r[5]}, {r[6]}, {r[7]})" for r in _BOW) + ") AS b")
    + f""", cross_ AS (SELECT DISTINCT a.shape_id, a.part, a.ring FROM every a JOIN every b ON a.shape_id = b.shape_id AND a.part = b.part AND a.ring = b.ring AND a.seq < b.seq
  WHERE {_side(('b.x1', 'b.y1'), 'a')} * {_side(('b.x2', 'b.y2'), 'a')} < 0 AND {_side(('a.x1', 'a.y1'), 'b')} * {_side(('a.x2', 'a.y2'), 'b')} < 0),
r AS (SELECT shape_id, part, ring, count(*) >= 3 AS enough_vertices,
    abs(sum(x1 * y2 - x2 * y1) / 2) > 0 AS non_zero_area,
    list_sort(list(struct_pack(a := x1, b := y1))) = list_sort(list(struct_pack(a := x2, b := y2))) AS closed
  FROM every GROUP BY ALL),
f AS (SELECT r.*, c.shape_id IS NULL AS simple FROM r LEFT JOIN cross_ c ON r.shape_id = c.shape_id AND r.part = c.part AND r.ring = c.ring)
SELECT shape_id, bool_and(closed) AS closed, bool_and(enough_vertices) AS enough_vertices, bool_and(non_zero_area) AS non_zero_area, bool_and(simple) AS simple,
  bool_and(closed) AND bool_and(enough_vertices) AND bool_and(non_zero_area) AND bool_and(simple) AS valid FROM f GROUP BY 1""",
)
def e17(spark, d):
    _, e = shapes(spark, d, overlap=True)
    bow = spark.createDataFrame(_BOW, R.EDGE_SCHEMA)
    return geometry.polygon_checks(e.select(*bow.columns).unionByName(bow))


def _utm_sql(lon, lat, epsg):
    """Easting and northing by the Krueger series, written out term by term."""
    meridian, false_north, flattening = geometry.utm_zone(epsg)
    radius, series, _ = geometry.krueger_series(flattening)
    e, k = (flattening * (2 - flattening)) ** 0.5, 0.9996 * radius
    t = f"sinh(atanh(sin(radians({lat}))) - {e!r} * atanh({e!r} * sin(radians({lat}))))"
    base = f"SELECT *, atan2({t}, cos(radians({lon} - {meridian}))) AS xi, asinh(sin(radians({lon} - {meridian})) / sqrt(power({t}, 2) + power(cos(radians({lon} - {meridian})), 2))) AS eta"
    x = " + ".join(["eta"] + [f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(series, 1)])
    y = " + ".join(["xi"] + [f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(series, 1)])
    return base, f"500000 + {k!r} * ({x})", f"{false_north!r} + {k!r} * ({y})"


_UTM_BASE, _UTM_X, _UTM_Y = _utm_sql("lon", "lat", 32733)
_NEAR_UTM = "lon BETWEEN -20 AND 50 AND lat BETWEEN -80 AND 84"


@query("E1_project_utm", PLANTS_CTE.rstrip() + f", u AS ({_UTM_BASE} FROM og_plants WHERE {_NEAR_UTM}) SELECT powerplant_id, {_UTM_X} AS east, {_UTM_Y} AS north FROM u")
def e1u(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    x, y = geometry.project("lon", "lat", 32733)
    return p.where(_NEAR_UTM).select("powerplant_id", x.alias("east"), y.alias("north"))


def _laea_sql():
    rq, s0, c0, stretch = geometry.laea_constants(3035)
    f = 1 / 298.257222101
    e2 = f * (2 - f)
    e = e2**0.5
    q = lambda s: f"((1 - {e2!r}) * ({s} / (1 - {e2!r} * {s} * {s}) - ln((1 - {e!r} * {s}) / (1 + {e!r} * {s})) / (2 * {e!r})))"
    sine, around = f"({q('sin(radians(lat))')} / {q('1e0')})", "radians(lon - 10)"
    b = f"({rq!r} * sqrt(2 / (1 + {s0!r} * sb + {c0!r} * cb * cos({around}))))"
    return (
        f"SELECT *, {sine} AS sb, sqrt(1 - power({sine}, 2)) AS cb",
        f"4321000 + {b} * {stretch!r} * cb * sin({around})",
        f"3210000 + {b} / {stretch!r} * ({c0!r} * sb - {s0!r} * cb * cos({around}))",
    )


_LAEA_BASE, _LAEA_X, _LAEA_Y = _laea_sql()


@query("E1_project_laea", PLANTS_CTE.rstrip() + f", u AS ({_LAEA_BASE} FROM og_plants WHERE {_NEAR_UTM}) SELECT powerplant_id, {_LAEA_X} AS east, {_LAEA_Y} AS north FROM u")
def e1l(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    x, y = geometry.project("lon", "lat", 3035)
    return p.where(_NEAR_UTM).select("powerplant_id", x.alias("east"), y.alias("north"))


@query("E1_unproject_grids", PLANTS_CTE + f"SELECT powerplant_id, epsg, lon, lat FROM og_plants, (VALUES (32733), (25833), (3035)) AS v(epsg) WHERE {_NEAR_UTM}")
def e1ug(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    out = None
    for epsg in (32733, 25833, 3035):
        x, y = geometry.project("lon", "lat", epsg)
        there = p.where(_NEAR_UTM).select("powerplant_id", x.alias("east"), y.alias("north"))
        lon, lat = geometry.unproject("east", "north", epsg)
        back = there.select("powerplant_id", F.lit(epsg).alias("epsg"), F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))
        out = back if out is None else out.unionByName(back)
    return out


PROJ_SQL = """SELECT powerplant_id, 6378137e0 * radians(lon) AS x3857,
  6378137e0 * ln(tan(pi() / 4 + radians(lat) / 2)) AS y3857 FROM og_plants"""


@query("E1_project_3857", PLANTS_CTE + PROJ_SQL)
def e1(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    x, y = geometry.project("lon", "lat", 3857)
    return p.select("powerplant_id", x.alias("x3857"), y.alias("y3857"))


@query("E1_unproject", PLANTS_CTE + "SELECT powerplant_id, epsg, lon, lat FROM og_plants, (VALUES (3857), (8857)) AS v(epsg) WHERE lat BETWEEN -80 AND 80")
def e1c(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    p = p.where(F.col("lat").between(-80, 80)).select("powerplant_id", "lon", "lat")
    parts = []
    for epsg in (3857, 8857):
        x, y = geometry.project("lon", "lat", epsg)
        lon, lat = geometry.unproject("x", "y", epsg)
        parts.append(p.select("powerplant_id", x.alias("x"), y.alias("y")).select("powerplant_id", F.lit(epsg).alias("epsg"), lon.alias("lon"), lat.alias("lat")))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# F: imputation
# ---------------------------------------------------------------------------
AGES_CTE = O.ctes(**O.BASE, **O.AGES)


@query("F1_impute_start_year", AGES_CTE + "SELECT powerplant_id, start_year FROM f1")
def f1(spark, d):
    p, _ = og_plants(spark, d)
    return impute.impute_start_year(impute.scenario_filter(p, "construction"), FX.FIXTURE_LIFETIMES).select("powerplant_id", "start_year")


@query("F2_impute_end_year", AGES_CTE + "SELECT powerplant_id, end_year FROM f2")
def f2(spark, d):
    p, _ = og_plants(spark, d)
    s = impute.impute_start_year(impute.scenario_filter(p, "construction"), FX.FIXTURE_LIFETIMES)
    return impute.impute_end_year(s, FX.FIXTURE_LIFETIMES, FX.FIXTURE_DELAYS, Y).select("powerplant_id", "end_year")


@query("F3_impute_status", AGES_CTE + "SELECT powerplant_id, status FROM f4")
def f3(spark, d):
    return aged_plants(spark, d).select("powerplant_id", "status")


@query("F4_impute_time", AGES_CTE + f"SELECT {_sel(PLANT_OUT)}, country_id FROM f4")
def f4(spark, d):
    return aged_plants(spark, d).select(*PLANT_OUT, "country_id")


F5_SQL = O.ctes(**O.FAC, w=O.pip("tracker_points", "facility_edges", "lon", "lat", "powerplant_id", boundary="exclude")) + """,
j AS (SELECT w.shape_id, t.* FROM w JOIN tracker_points t USING (powerplant_id)),
yrs AS (SELECT shape_id, round_even(avg(start_year), 0) AS s, round_even(avg(end_year), 0) AS e FROM j GROUP BY 1),
sc AS (SELECT shape_id, status, count(*) AS n FROM j WHERE status IS NOT NULL GROUP BY 1, 2),
mx AS (SELECT shape_id, max(n) AS m FROM sc GROUP BY 1),
md AS (SELECT sc.shape_id, any_value(sc.status) AS st FROM sc JOIN mx ON sc.shape_id = mx.shape_id AND sc.n = mx.m GROUP BY 1 HAVING count(*) = 1)
SELECT f.cluster_id AS shape_id, f.capacity_mw AS output_capacity_mw, coalesce(y.s, f.start_year) AS start_year,
  y.e AS end_year, coalesce(md.st, 'operating') AS status
FROM facilities f LEFT JOIN yrs y ON y.shape_id = f.cluster_id LEFT JOIN md ON md.shape_id = f.cluster_id"""


def facilities_df(spark, d):
    f = FX.stand_in(spark, d, FX.FACILITIES_SQL)
    return f.select(
        F.col("cluster_id").alias("shape_id"), F.col("capacity_mw").alias("output_capacity_mw"),
        "start_year", F.lit(None).cast("double").alias("end_year"), F.lit("operating").alias("status"),
    )


@query("F5_fill_from_points", F5_SQL)
def f5(spark, d):
    tp = FX.stand_in(spark, d, FX.TRACKER_POINTS_SQL)
    fe = FX.stand_in(spark, d, FX.FACILITY_EDGES_SQL)
    within = geometry.points_in_shapes(tp.select("lon", "lat", "start_year", "end_year", "status"), fe, 0.5, x="lon", y="lat", boundary="exclude")
    return impute.fill_from_points(facilities_df(spark, d), within)


# ---------------------------------------------------------------------------
# G: capacity and statistics
# ---------------------------------------------------------------------------
STAT_CTE = O.ctes(**O.BASE, **O.AGES, **O.STATS)
EXPECTED = f"SELECT country_id, sum(capacity_mw) AS expected FROM stats WHERE year = {Y} AND category IN ('fossil fuels') GROUP BY 1"


@query("G8_expected_capacity", O.ctes(**O.STATS) + EXPECTED)
def g8(spark, d):
    return capacity.expected_capacity(stats(spark, d), Y, "fossil")


ADJ_SQL = f""", ex AS ({EXPECTED}), op AS (SELECT * FROM f4 WHERE start_year <= {Y} AND {Y} < end_year),
adj AS (SELECT o.* REPLACE (o.output_capacity_mw / s.t * ex.expected AS output_capacity_mw) FROM op o
  JOIN ex ON ex.country_id = o.country_id AND ex.expected > 0
  JOIN (SELECT country_id, sum(output_capacity_mw) AS t FROM op GROUP BY 1) s ON s.country_id = o.country_id),
allp AS (SELECT * FROM f4 WHERE NOT coalesce(start_year <= {Y} AND {Y} < end_year, false) UNION ALL SELECT * FROM adj)"""


@query("G2_adjust_capacity", STAT_CTE.rstrip() + ADJ_SQL + f"\nSELECT {_sel(PLANT_OUT)}, country_id FROM allp")
def g2(spark, d):
    return capacity.adjust_capacity(aged_plants(spark, d), stats(spark, d), Y, "fossil").select(*PLANT_OUT, "country_id")


@query(
    "G1_scale_to_total",
    STAT_CTE.rstrip() + f""", ex AS ({EXPECTED}), op AS (SELECT * FROM f4 WHERE start_year <= {Y} AND {Y} < end_year)
SELECT o.powerplant_id, o.output_capacity_mw / s.t * ex.expected AS output_capacity_mw FROM op o
JOIN ex ON ex.country_id = o.country_id
JOIN (SELECT country_id, sum(output_capacity_mw) AS t FROM op GROUP BY 1) s ON s.country_id = o.country_id""",
)
def g1(spark, d):
    op, _ = capacity.operating_split(aged_plants(spark, d), Y)
    return capacity.scale_to_total(op, capacity.expected_capacity(stats(spark, d), Y, "fossil")).select("powerplant_id", "output_capacity_mw")


GROUPS = ["category", "technology", "chp", "ccs", "fuel_class"]
AGG_SQL = f""", op AS (SELECT * FROM f4 WHERE start_year <= {Y} AND {Y} < end_year),
m AS ({O.pip('op', 'edges', 'lon', 'lat', 'powerplant_id')}),
agg AS (SELECT m.shape_id, s.country_id, {_sel('o.' + g for g in GROUPS)}, sum(o.output_capacity_mw) AS output_capacity_mw, {Y} AS reference_year
  FROM m JOIN op o USING (powerplant_id) JOIN shapes s ON s.shape_id = m.shape_id
  GROUP BY m.shape_id, s.country_id, {_sel('o.' + g for g in GROUPS)} HAVING sum(o.output_capacity_mw) > 0)"""
AGG_CTE = O.ctes(**O.BASE, **O.AGES, **O.SHAPES).rstrip() + AGG_SQL


def aggregated_df(spark, d):
    s, e = shapes(spark, d)
    return capacity.aggregate_capacity(aged_plants(spark, d), s, e, Y, B)


@query("G4_aggregate_capacity", AGG_CTE + "\nSELECT * FROM agg")
def g4(spark, d):
    return aggregated_df(spark, d)


@query(
    "G3_adjust_aggregated",
    O.ctes(**O.BASE, **O.AGES, **O.SHAPES, **O.STATS).rstrip() + AGG_SQL + f""",
ex AS (SELECT country_id, coalesce(sum(capacity_mw), 0) AS expected FROM stats WHERE year = {Y} AND category IN ('fossil fuels') GROUP BY 1)
SELECT a.shape_id, a.country_id, a.technology, a.output_capacity_mw / t.t * ex.expected AS output_capacity_mw
FROM agg a JOIN ex USING (country_id) JOIN (SELECT country_id, sum(output_capacity_mw) AS t FROM agg GROUP BY 1) t USING (country_id)""",
)
def g3(spark, d):
    out = capacity.adjust_aggregated(aggregated_df(spark, d), stats(spark, d), Y, "fossil")
    return out.select("shape_id", "country_id", "technology", "output_capacity_mw")


G5_SQL = O.ctes(**O.STATS, **O.SHAPES, st=STATS_ALL) + """, ok AS (
  SELECT country_id FROM st WHERE NOT (country_id = 'N09' AND category = 'tide and wave')
  GROUP BY 1 HAVING count(DISTINCT category) = 10)
SELECT year, category, capacity_mw / 1000 * 1000 AS capacity_mw, country_id FROM st
WHERE country_id IN (SELECT country_id FROM ok) AND country_id IN (SELECT country_id FROM shapes)"""


@query("G5_national_statistics", G5_SQL)
def g5(spark, d):
    s, _ = shapes(spark, d)
    st, _ = capacity.national_statistics(raw_series(spark, d), s)
    return st


@query(
    "G6_missing_countries",
    O.ctes(**O.STATS, **O.SHAPES, st=STATS_ALL) + """SELECT DISTINCT country_id FROM shapes WHERE country_id NOT IN (
  SELECT country_id FROM st WHERE NOT (country_id = 'N09' AND category = 'tide and wave') GROUP BY 1 HAVING count(DISTINCT category) = 10)""",
)
def g6(spark, d):
    s, _ = shapes(spark, d)
    _, missing = capacity.national_statistics(raw_series(spark, d), s)
    return missing


_G7_SQL = f"""{G5_SQL.replace("SELECT year, category, capacity_mw / 1000", ", g5 AS (SELECT year, category, capacity_mw / 1000")}),
off AS (SELECT * REPLACE (CASE WHEN category = 'total' AND country_id = 'N01' THEN capacity_mw * 1.01e0 ELSE capacity_mw END AS capacity_mw) FROM g5),
cases AS (SELECT 'as published' AS name, * FROM g5 UNION ALL SELECT 'one total off' AS name, * FROM off),
sums AS (SELECT name, coalesce(sum(capacity_mw) FILTER (category = 'total'), 0) AS total_sum, coalesce(sum(capacity_mw) FILTER (category <> 'total'), 0) AS category_sum FROM cases GROUP BY 1)
SELECT name, total_sum, category_sum, abs(total_sum - category_sum) <= 1e-9 * greatest(abs(total_sum), abs(category_sum)) AS ok FROM sums"""


@query("G7_statistics_checksum", _G7_SQL)
def g7(spark, d):
    s, _ = shapes(spark, d)
    st, _ = capacity.national_statistics(raw_series(spark, d), s)
    off = st.withColumn("capacity_mw", F.when((F.col("category") == "total") & (F.col("country_id") == "N01"), F.col("capacity_mw") * 1.01).otherwise(F.col("capacity_mw")))
    checks = [capacity.split_total(rows)[2].select(F.lit(name).alias("name"), "*") for name, rows in (("as published", st), ("one total off", off))]
    return checks[0].unionByName(checks[1])


@query("G5_G7_prepare_statistics", f"""{G5_SQL.replace("SELECT year, category, capacity_mw / 1000", ", g5 AS (SELECT year, category, capacity_mw / 1000")})
SELECT category = 'total' AS is_total, year, category, capacity_mw, country_id FROM g5""")
def statistics_job(spark, d):
    s, _ = shapes(spark, d)
    total, categories, _ = P.prepare_statistics(raw_series(spark, d), s)
    return total.withColumn("is_total", F.lit(True)).unionByName(categories.withColumn("is_total", F.lit(False)))


# ---------------------------------------------------------------------------
# H: raster
# ---------------------------------------------------------------------------
H1_SQL = f""", tot AS (SELECT country_id, sum(capacity_mw) AS t FROM stats WHERE year = {Y} AND category IN ('solar') GROUP BY 1),
lg AS (SELECT country_id, sum(output_capacity_mw) AS l FROM agg GROUP BY 1),
miss AS (SELECT country_id, CASE WHEN t - l >= 0 THEN t - l ELSE 0e0 END AS output_capacity_mw FROM tot JOIN lg USING (country_id) WHERE t - l IS NOT NULL)"""
H_CTE = O.ctes(**O.BASE, **O.AGES, **O.SHAPES, **O.STATS, **O.PIXELS).rstrip() + AGG_SQL + H1_SQL


@query("H1_missing_capacity", H_CTE + "\nSELECT * FROM miss")
def h1(spark, d):
    return raster.missing_capacity(stats(spark, d), aggregated_df(spark, d), Y, "solar")


H2_SQL = f""",
land AS (SELECT e.* FROM edges e JOIN shapes s USING (shape_id) WHERE s.shape_class = 'land'),
pxid AS (SELECT *, CAST(prow AS VARCHAR) || '_' || CAST(pcol AS VARCHAR) AS pid FROM pixels),
pc AS (SELECT DISTINCT p.prow, p.pcol, p.x, p.y, p.value, s.country_id FROM ({O.pip('pxid', 'land', 'x', 'y', 'pid')}) m
  JOIN pxid p USING (pid) JOIN shapes s USING (shape_id)),
spread AS (SELECT pc.prow, pc.pcol, pc.x, pc.y, sum(pc.value / t.s * miss.output_capacity_mw) AS value
  FROM pc JOIN (SELECT country_id, sum(value) AS s FROM pc GROUP BY 1) t USING (country_id) JOIN miss USING (country_id)
  GROUP BY 1, 2, 3, 4)"""


def proxy_df(spark, d):
    s, e = shapes(spark, d)
    totals = raster.missing_capacity(stats(spark, d), aggregated_df(spark, d), Y, "solar")
    land, land_edges = geometry.country_borders(s, e)
    return raster.disaggregate_by_proxy(totals, pixels(spark, d), land, land_edges, B)


@query("H2_disaggregate_by_proxy", H_CTE + H2_SQL + "\nSELECT * FROM spread")
def h2(spark, d):
    return proxy_df(spark, d)


@query(
    "H3_zonal_sum",
    O.ctes(**O.SHAPES, **O.PIXELS).rstrip()
    + ", pxid AS (SELECT *, CAST(prow AS VARCHAR) || '_' || CAST(pcol AS VARCHAR) AS pid FROM pixels)\n"
    + f"SELECT m.shape_id, s.country_id, sum(p.value) AS sum FROM ({O.pip('pxid', 'edges', 'x', 'y', 'pid')}) m JOIN pxid p USING (pid) JOIN shapes s USING (shape_id) GROUP BY 1, 2",
)
def h3(spark, d):
    s, e = shapes(spark, d)
    return raster.zonal_sum(pixels(spark, d), s, e, B)


GRID = pixel_shares.Grid(left=-179.9983, top=90.0023, width=0.6, height=0.6)
# each edge clipped to each pixel square it can matter to; the area right of it, by trapezoids between the square's sides
SHARES_SQL = """,
turns AS (SELECT shape_id, part, ring, sign(sum(x1 * y2 - x2 * y1)) * CASE WHEN ring = 0 THEN 1 ELSE -1 END AS side FROM edges GROUP BY 1, 2, 3),
boxes AS (SELECT shape_id, min(x1) AS xl, max(x1) AS xh, min(y1) AS yl, max(y1) AS yh FROM edges GROUP BY 1),
squares AS (SELECT prow, pcol, x, y, value, -179.9983e0 + 0.6e0 * pcol AS l, 90.0023e0 - 0.6e0 * (prow + 1) AS d FROM pixels),
clipped AS (SELECT p.prow, p.pcol, e.shape_id, p.l, t.side, e.x1, e.x2, e.y1, e.y2,
    least(greatest((p.d - e.y1) / (e.y2 - e.y1), 0e0), 1e0) AS ta, least(greatest((p.d + 0.6e0 - e.y1) / (e.y2 - e.y1), 0e0), 1e0) AS tb
  FROM squares p JOIN boxes b ON p.l < b.xh AND p.l + 0.6e0 > b.xl AND p.d < b.yh AND p.d + 0.6e0 > b.yl
  JOIN edges e ON e.shape_id = b.shape_id AND e.y1 <> e.y2 AND least(e.y1, e.y2) < p.d + 0.6e0 AND greatest(e.y1, e.y2) > p.d
  JOIN turns t ON t.shape_id = e.shape_id AND t.part = e.part AND t.ring = e.ring),
ends AS (SELECT *, x1 + ta * (x2 - x1) - l AS ua, x1 + tb * (x2 - x1) - l AS ub, (y2 - y1) * (tb - ta) AS dy FROM clipped),
marks AS (SELECT *, CASE WHEN ua = ub THEN 0e0 ELSE least(greatest(-ua / (ub - ua), 0e0), 1e0) END AS m0,
    CASE WHEN ua = ub THEN 0e0 ELSE least(greatest((0.6e0 - ua) / (ub - ua), 0e0), 1e0) END AS m1 FROM ends),
bent AS (SELECT *, least(m0, m1) AS p, greatest(m0, m1) AS q, least(greatest(ua, 0e0), 0.6e0) AS f0, least(greatest(ub, 0e0), 0.6e0) AS f1 FROM marks),
kinks AS (SELECT *, least(greatest(ua + p * (ub - ua), 0e0), 0.6e0) AS fp, least(greatest(ua + q * (ub - ua), 0e0), 0.6e0) AS fq FROM bent),
shares AS (SELECT prow, pcol, shape_id,
    sum(side * sign(y2 - y1) * abs(dy) * (p * (f0 + fp) / 2 + (q - p) * (fp + fq) / 2 + (1 - q) * (fq + f1) / 2 - 0.6e0)) / 0.36e0 AS share
  FROM kinks GROUP BY 1, 2, 3)"""


@query(
    "H2_disaggregate_by_share",
    H_CTE + SHARES_SQL + """,
weights AS (SELECT q.prow, q.pcol, q.x, q.y, s.country_id, sum(q.value * h.share) AS w FROM shares h JOIN squares q USING (prow, pcol)
  JOIN shapes s USING (shape_id) WHERE s.shape_class = 'land' AND h.share > 1e-12 GROUP BY 1, 2, 3, 4, 5)
SELECT w.prow, w.pcol, w.x, w.y, w.country_id, w.w / t.s * miss.output_capacity_mw AS value
FROM weights w JOIN (SELECT country_id, sum(w) AS s FROM weights GROUP BY 1) t USING (country_id) JOIN miss USING (country_id)""",
)
def h2_share(spark, d):
    s, e = shapes(spark, d)
    totals = raster.missing_capacity(stats(spark, d), aggregated_df(spark, d), Y, "solar")
    land, land_edges = geometry.country_borders(s, e)
    return pixel_shares.disaggregate_by_share(totals, pixels(spark, d), land, land_edges, GRID)


@query(
    "H3_zonal_sum_by_share",
    O.ctes(**O.SHAPES, **O.PIXELS).rstrip() + SHARES_SQL + """
SELECT h.shape_id, s.country_id, sum(q.value * h.share) AS sum FROM shares h JOIN squares q USING (prow, pcol) JOIN shapes s USING (shape_id)
WHERE h.share > 1e-12 GROUP BY 1, 2""",
)
def h3_share(spark, d):
    s, e = shapes(spark, d)
    return pixel_shares.zonal_sum_by_share(pixels(spark, d), s, e, GRID)


@query(
    "H4_combine_solar",
    H_CTE + ", pxid AS (SELECT *, CAST(prow AS VARCHAR) || '_' || CAST(pcol AS VARCHAR) AS pid FROM pixels),\n"
    + f"""roof AS (SELECT m.shape_id, s.country_id, CASE WHEN m.shape_id <> 'S01_L' THEN sum(p.value) - 1500 END AS sum FROM ({O.pip('pxid', 'edges', 'x', 'y', 'pid')}) m JOIN pxid p USING (pid) JOIN shapes s USING (shape_id) GROUP BY 1, 2)
SELECT shape_id, country_id, 'solar' AS category, 'rooftop pv' AS technology, sum AS output_capacity_mw FROM roof WHERE sum > 0
UNION ALL SELECT shape_id, country_id, category, technology, output_capacity_mw FROM agg WHERE output_capacity_mw > 0""",
)
def h4(spark, d):
    s, e = shapes(spark, d)
    roof = raster.zonal_sum(pixels(spark, d), s, e, B).withColumn("sum", F.when(F.col("shape_id") != "S01_L", F.col("sum") - 1500))
    return raster.combine_solar(roof, aggregated_df(spark, d), "rooftop pv").select("shape_id", "country_id", "category", "technology", "output_capacity_mw")


@query(
    "E11_country_pixels",
    O.ctes(**O.SHAPES_OV, **O.PIXELS).rstrip() + """,
land AS (SELECT e.* FROM edges_ov e JOIN shapes_ov s USING (shape_id) WHERE s.shape_class = 'land'),
pxid AS (SELECT *, CAST(prow AS VARCHAR) || '_' || CAST(pcol AS VARCHAR) AS pid FROM pixels)\n"""
    + f"SELECT DISTINCT p.prow, p.pcol, s.country_id FROM ({O.pip('pxid', 'land', 'x', 'y', 'pid')}) m JOIN pxid p USING (pid) JOIN shapes_ov s USING (shape_id)",
)
def e11(spark, d):
    s, e = shapes(spark, d, overlap=True)
    land, land_edges = geometry.country_borders(s, e)
    return raster.pixel_countries(pixels(spark, d), land, land_edges, B).select("prow", "pcol", "country_id")


@query(
    "P11_adjusted_solar",
    H_CTE + H2_SQL + f""",
spid AS (SELECT *, CAST(prow AS VARCHAR) || '_' || CAST(pcol AS VARCHAR) AS pid FROM spread),
roof AS (SELECT m.shape_id, s.country_id, sum(p.value) AS output_capacity_mw FROM ({O.pip('spid', 'edges', 'x', 'y', 'pid')}) m
  JOIN spid p USING (pid) JOIN shapes s USING (shape_id) GROUP BY 1, 2)
SELECT shape_id, country_id, 'solar' AS category, 'rooftop pv' AS technology, output_capacity_mw,
  CAST(NULL AS BOOLEAN) AS chp, CAST(NULL AS BOOLEAN) AS ccs, CAST(NULL AS VARCHAR) AS fuel_class FROM roof WHERE output_capacity_mw > 0
UNION ALL SELECT shape_id, country_id, category, technology, output_capacity_mw, chp, ccs, fuel_class FROM agg""",
)
def p11(spark, d):
    s, e = shapes(spark, d)
    out = P.adjusted_solar(stats(spark, d), aggregated_df(spark, d), pixels(spark, d), s, e, B, Y, technology="rooftop pv")
    return out.select("shape_id", "country_id", "category", "technology", "output_capacity_mw", "chp", "ccs", "fuel_class")


@query(
    "H5_coarsen",
    O.ctes(**O.PIXELS) + """SELECT CAST(floor(prow / 7) AS INTEGER) AS brow, CAST(floor(pcol / 7) AS INTEGER) AS bcol,
  avg(value) AS value, avg(x) AS x, avg(y) AS y FROM pixels WHERE prow < 294 AND pcol < 595 GROUP BY 1, 2""",
)
def h5(spark, d):
    return raster.coarsen(pixels(spark, d), 7, FX.PIXEL_ROWS, FX.PIXEL_COLS)


# ---------------------------------------------------------------------------
# I: quality
# ---------------------------------------------------------------------------
def _rule_sql(rule: quality.Rule, table: str) -> str:
    c = rule.column
    if rule.kind == "unique":
        return (f"SELECT '{rule.name}' AS rule, coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM {table} "
                f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)), 0)::BIGINT AS failures")
    if rule.kind == "not_null":
        cond = f"{c} IS NULL"
    elif rule.kind == "isin":
        cond = f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(repr(v) for v in rule.arg)})"
    elif rule.kind == "gt":
        cond = f"{c} IS NOT NULL AND NOT {c} > {rule.arg}"
    elif rule.kind == "ge":
        cond = f"{c} IS NOT NULL AND NOT {c} >= {rule.arg}"
    else:
        cond = f"{c} IS NOT NULL AND NOT length({c}) BETWEEN {rule.arg[0]} AND {rule.arg[1]}"
    return f"SELECT '{rule.name}' AS rule, count_if({cond})::BIGINT AS failures FROM {table}"


_I2_COLS = set(PLANT_OUT) | {"ccs", "chp", "fuel_class", "country_id"}
_I2_RULES = [r for r in quality.stage_rules(FX.FIXTURE_TECH_MAP.values(), "prepare") if r.column in _I2_COLS]


@query("I2_check_rules", O.ctes(**O.BASE) + "\nUNION ALL\n".join(_rule_sql(r, "og_plants") for r in _I2_RULES))
def i2(spark, d):
    p, _ = og_plants(spark, d)
    rules = quality.stage_rules(FX.FIXTURE_TECH_MAP.values(), "prepare")
    return quality.check_rules(p, rules)


_I3_WANT = {
    "prepare": [("status", ("announced", "construction", "operating", "pre-construction", "retired"))],
    "impute": [("status", ("operating", "planned", "retired")), ("start_year", None), ("end_year", None)],
}


@query(
    "I3_stage_rules",
    O.ctes(**O.BASE) + "\nUNION ALL\n".join(
        f"SELECT '{stage}' AS stage, '{column}' AS column_name, '{'isin' if values else 'not_null'}' AS kind, "
        + (f"count_if({column} IS NOT NULL AND {column} NOT IN ({', '.join(repr(v) for v in values)}))" if values else f"count_if({column} IS NULL)") + "::BIGINT AS failures FROM og_plants"
        for stage, wanted in _I3_WANT.items() for column, values in wanted
    ),
)
def i3(spark, d):
    p, _ = og_plants(spark, d)
    out = None
    for stage, wanted in _I3_WANT.items():
        keep = {(column, "isin" if values else "not_null") for column, values in wanted}
        rules = [r for r in quality.stage_rules(FX.FIXTURE_TECH_MAP.values(), stage) if (r.column, r.kind) in keep]
        part = quality.check_rules(p, rules).select(F.lit(stage).alias("stage"), F.split("rule", ":")[0].alias("column_name"), F.split("rule", ":")[1].alias("kind"), "failures")
        out = part if out is None else out.unionByName(part)
    return out


@query("I5_mismatched_ids", O.ctes(**O.SHAPES, **O.SHAPES_OV) + "SELECT shape_id FROM shapes_ov WHERE shape_id NOT IN (SELECT shape_id FROM shapes)")
def i5(spark, d):
    a, _ = shapes(spark, d)
    b, _ = shapes(spark, d, overlap=True)
    return quality.mismatched_ids(a, b)


# ---------------------------------------------------------------------------
# J: report tables
# ---------------------------------------------------------------------------
@query(
    "J1_capacity_buildup",
    AGES_CTE + """, b AS (SELECT CAST(floor(min(start_year)) AS INTEGER) AS y0, CAST(floor(max(end_year)) AS INTEGER) AS y1 FROM f4),
spine AS (SELECT c.country_id, t.technology, CAST(g.year AS INTEGER) AS year FROM (SELECT DISTINCT country_id FROM f4) c
  JOIN (SELECT DISTINCT technology FROM f4) t ON true JOIN (SELECT unnest(range(y0, y1 + 1)) AS year FROM b) g ON true)
SELECT s.country_id, s.technology, s.year, coalesce(sum(f.output_capacity_mw), 0e0) AS output_capacity_mw
FROM spine s LEFT JOIN f4 f ON f.country_id = s.country_id AND f.technology = s.technology AND f.start_year <= s.year AND s.year < f.end_year
GROUP BY 1, 2, 3""",
)
def j1(spark, d):
    return reports.capacity_buildup(aged_plants(spark, d))


J3_CATS = [c for c in C.EIA_CATEGORY_IDS if c != "total"]


@query(
    "J3_statistics_pivot",
    O.ctes(**O.STATS) + "SELECT country_id, year, "
    + ", ".join(f"coalesce(sum(CASE WHEN category = '{c}' THEN capacity_mw END), 0e0) AS mw_{c.replace(' ', '_')}" for c in J3_CATS)
    + ", sum(capacity_mw) AS total_mw FROM stats GROUP BY 1, 2",
)
def j3(spark, d):
    st = stats(spark, d)
    total = st.groupBy("year", "country_id").agg(F.sum("capacity_mw").alias("capacity_mw")).withColumn("category", F.lit("total"))
    return reports.statistics_pivot(st, total, J3_CATS)


@query(
    "J4_capacity_by_shape",
    O.ctes(**O.BASE, **O.AGES, **O.SHAPES).rstrip() + AGG_SQL
    + "\nSELECT s.shape_id, nullif(a.t, 0) AS output_capacity_mw FROM shapes s LEFT JOIN (SELECT shape_id, sum(output_capacity_mw) AS t FROM agg GROUP BY 1) a USING (shape_id)",
)
def j4(spark, d):
    s, _ = shapes(spark, d)
    return reports.capacity_by_shape(aggregated_df(spark, d), s)


@query(
    "J2_adjustment_comparison",
    STAT_CTE.rstrip() + ADJ_SQL + f""",
eia AS (SELECT * FROM stats WHERE year = {Y} AND category IN ('fossil fuels')),
u AS (SELECT country_id, technology AS label, sum(output_capacity_mw) AS capacity_mw, 'unadjusted' AS source FROM op
      WHERE country_id IN (SELECT country_id FROM eia) GROUP BY 1, 2),
a AS (SELECT country_id, technology AS label, sum(output_capacity_mw) AS capacity_mw, 'adjusted' AS source FROM allp
      WHERE start_year <= {Y} AND {Y} < end_year GROUP BY 1, 2),
s AS (SELECT country_id, category AS label, sum(capacity_mw) AS capacity_mw, 'statistics' AS source FROM eia
      WHERE country_id IN (SELECT country_id FROM u UNION SELECT country_id FROM a) GROUP BY 1, 2),
lng AS (SELECT * FROM u UNION ALL SELECT * FROM a UNION ALL SELECT * FROM s),
tot AS (SELECT country_id, 'total' AS label, sum(capacity_mw) AS capacity_mw, source FROM lng GROUP BY country_id, source),
al AS (SELECT * FROM lng UNION ALL SELECT * FROM tot)
SELECT al.country_id, al.label, al.capacity_mw, al.source,
  CASE WHEN t.capacity_mw <> 0 THEN al.capacity_mw / t.capacity_mw * 100 END AS share_of_adjusted
FROM al LEFT JOIN (SELECT * FROM tot WHERE source = 'adjusted') t USING (country_id)""",
)
def j2(spark, d):
    un = cut_lineage(aged_plants(spark, d))  # a published table that both sides read
    st = cut_lineage(stats(spark, d))
    adj = capacity.adjust_capacity(un, st, Y, "fossil")
    return reports.adjustment_comparison(un, adj, st, Y, "fossil").select("country_id", "label", "capacity_mw", "source", "share_of_adjusted")


# ---------------------------------------------------------------------------
# Jobs needing point placement (rows-only checks) and their report
# ---------------------------------------------------------------------------
def unadjusted_df(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    s, e = shapes(spark, d)
    loc = C.LocationSettings(inner_distance=0.5, on_overlap="raise", on_shape_class_error="drop", shape_class=FX.FIXTURE_SHAPE_CLASS)
    imp = C.ImputationSettings(scenario="construction", lifetime_years=FX.FIXTURE_LIFETIMES, retirement_delay_years=FX.FIXTURE_DELAYS)
    return P.unadjusted_plants(p, s, e, B, imp, loc, Y, tech_values=FX.FIXTURE_TECH_MAP.values())


RELOC_CTE = O.ctes(**O.BASE, **O.SHAPES, **O.relocation(0.5, FX.FIXTURE_SHAPE_CLASS))


@query("E15_relocate", RELOC_CTE + "SELECT powerplant_id, country_id, technology, lon, lat, moved FROM reloc")
def e15(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    s, e = shapes(spark, d)
    assigned = geometry.assign_country(p, s, e, B).drop("shape_id")
    return relocate(assigned, s, e, B, FX.FIXTURE_SHAPE_CLASS, 0.5, "drop").select("powerplant_id", "country_id", "technology", "lon", "lat", "moved")


_PLACING = {k: v for k, v in O.relocation(0.5, {}).items() if k in ("m0", "pin", "pdist", "bpart", "pedges", "contact", "ray", "hitsr", "placed")}
_PLACING = {"m0": _PLACING.pop("m0")} | dict(
    target="SELECT country_id, min(shape_id) AS shape_id FROM shapes GROUP BY 1",
    mv="SELECT p.* FROM og_plants p JOIN target t USING (country_id) WHERE NOT EXISTS (SELECT 1 FROM m0 WHERE m0.powerplant_id = p.powerplant_id AND m0.shape_id = t.shape_id)",
    best="SELECT powerplant_id, shape_id FROM mv JOIN target USING (country_id)",
) | _PLACING


@query("E9_place_inside", O.ctes(**O.BASE, **O.SHAPES, **_PLACING) + "SELECT powerplant_id, nx AS new_x, ny AS new_y FROM placed")
def e9(spark, d):
    """Plants outside the first shape of their country, moved just inside it."""
    p, _ = og_plants(spark, d)
    s, e = shapes(spark, d)
    target = s.groupBy("country_id").agg(F.min("shape_id").alias("target"))
    aimed = cut_lineage(p.select("powerplant_id", "lon", "lat", "country_id").join(target, on="country_id"))
    index = geometry.part_index(e, B)
    held = geometry.points_in_shapes(aimed, e, B, x="lon", y="lat", index=index[0], index_size=index[1]).where(F.col("shape_id.shape_id") == F.col("target"))
    out = aimed.join(held.select("powerplant_id").distinct(), on="powerplant_id", how="left_anti").withColumnRenamed("target", "shape_id")
    return place_inside(out, e, 0.5, band=B, index=index)


P8_CTE = O.ctes(**O.BASE, **O.SHAPES, **O.relocation(0.5, FX.FIXTURE_SHAPE_CLASS), **O.aged_from("reloc"), **O.STATS)
P9_CTE = P8_CTE.rstrip() + ADJ_SQL
P10_SQL = P9_CTE + f""", opa AS (SELECT * FROM allp WHERE start_year <= {Y} AND {Y} < end_year),
ma AS ({O.pip('opa', 'edges', 'lon', 'lat', 'powerplant_id')})
SELECT ma.shape_id, s.country_id, {_sel('o.' + g for g in GROUPS)}, sum(o.output_capacity_mw) AS output_capacity_mw, {Y} AS reference_year
FROM ma JOIN opa o USING (powerplant_id) JOIN shapes s ON s.shape_id = ma.shape_id
GROUP BY ma.shape_id, s.country_id, {_sel('o.' + g for g in GROUPS)} HAVING sum(o.output_capacity_mw) > 0"""


@query("P8_unadjusted_plants", P8_CTE + f"SELECT {_sel(PLANT_OUT)}, country_id, moved FROM f4")
def p8(spark, d):
    return unadjusted_df(spark, d).select(*PLANT_OUT, "country_id", "moved")


@query("P9_adjusted_plants", P9_CTE + f"\nSELECT {_sel(PLANT_OUT)}, country_id FROM allp")
def p9(spark, d):
    return P.adjusted_plants(unadjusted_df(spark, d), stats(spark, d), Y, "fossil").select(*PLANT_OUT, "country_id")


@query("P10_aggregated", P10_SQL)
def p10(spark, d):
    s, e = shapes(spark, d)
    adj = P.adjusted_plants(unadjusted_df(spark, d), stats(spark, d), Y, "fossil")
    return P.aggregated(adj, s, e, Y, B)


@query(
    "J5_relocation_summary",
    P8_CTE + """SELECT count(*) AS n_plants, count_if(NOT split AND NOT moved) AS n_valid,
  count_if(split) AS n_split, count_if(moved) AS n_moved FROM f4""",
)
def j5(spark, d):
    return reports.relocation_summary(unadjusted_df(spark, d))


P6_SQL = (
    F5_SQL.replace(
        "SELECT f.cluster_id AS shape_id, f.capacity_mw AS output_capacity_mw",
        ", filled AS (SELECT f.cluster_id AS shape_id, f.capacity_mw AS output_capacity_mw",
    )
    + "),\nedges AS (SELECT * FROM facility_edges),"
    + REP_SQL.replace("SELECT shape_id, arg_max(mx, (w, -rn)) AS rx, any_value(sy) AS ry FROM spans GROUP BY 1",
                      ", rep AS (SELECT shape_id, arg_max(mx, (w, -rn)) AS rx, any_value(sy) AS ry FROM spans GROUP BY 1),")
    + f"""
fut AS (SELECT * FROM tracker_points WHERE status IN {FUTURE}),
futp AS (SELECT powerplant_id, {_EE_X} AS px, {_EE_Y} AS py FROM fut),
fep AS (SELECT shape_id, {_equal_earth_sql('x1', 'y1')[0]} AS x1, {_equal_earth_sql('x1', 'y1')[1]} AS y1, {_equal_earth_sql('x2', 'y2')[0]} AS x2, {_equal_earth_sql('x2', 'y2')[1]} AS y2 FROM facility_edges),
inside AS ({O.pip("futp", "fep", "px", "py", "powerplant_id")}),
near AS (SELECT DISTINCT p.powerplant_id FROM futp p JOIN fep e ON p.py BETWEEN least(e.y1, e.y2) - 1000 AND greatest(e.y1, e.y2) + 1000
  WHERE {O.seg_dist('p.px', 'p.py')} <= 1000)
SELECT 'TZ-SAM_' || f.shape_id AS powerplant_id, 'TZ-SAM cluster ' || f.shape_id AS name, 'solar' AS category, 'utility pv' AS technology,
  f.output_capacity_mw, f.start_year, f.end_year, f.status, r.rx AS lon, r.ry AS lat
FROM filled f JOIN rep r USING (shape_id)
UNION ALL
SELECT {_sel(PLANT_OUT)} FROM fut WHERE powerplant_id NOT IN (SELECT powerplant_id FROM inside) AND powerplant_id NOT IN (SELECT powerplant_id FROM near)"""
)


@query("P6_large_solar", P6_SQL)
def p6(spark, d):
    tp = FX.stand_in(spark, d, FX.TRACKER_POINTS_SQL)
    fe = FX.stand_in(spark, d, FX.FACILITY_EDGES_SQL)
    return P.prepare_large_solar(facilities_df(spark, d), fe, tp)


# ---------------------------------------------------------------------------
# Other category jobs on the tracker stand-in
# ---------------------------------------------------------------------------
def _cat_sql(category: str, tech: str, start: str, end: str, extra: str = "", where: str = "") -> str:
    return f"""SELECT 'GEM_' || gem_location_id || '-' || gem_unit_id AS powerplant_id,
  plant_name || '-' || coalesce(unit_name, 'nan') AS name, '{category}' AS category, {tech} AS technology,
  capacity_mw_raw AS output_capacity_mw, {start} AS start_year, {end} AS end_year,
  {O.case_map('status', C.STATUS_MAPPING)} AS status, longitude AS lon, latitude AS lat{extra}
FROM clean {where}"""


@query(
    "P1_prepare_bioenergy",
    O.ctes(**O.BASE, **O.COAL, **O.BIO, fc_classes=O.FC_CLASSES, clean=O.CLEAN)
    + _cat_sql(
        "bioenergy", "'bioenergy turbine'",
        "CASE WHEN planned_retire_raw IS NOT NULL THEN TRY_CAST(planned_retire_raw AS DOUBLE) ELSE TRY_CAST(start_year_raw AS DOUBLE) END",
        "TRY_CAST(retired_year_raw AS DOUBLE)",
        ", false AS ccs, false AS chp, k.fuel_class",
    ).replace("FROM clean ", "FROM bio_clean JOIN fc_classes k USING (fuels) "),
)
def p1(spark, d):
    return burners(spark, d)[0]


@query(
    "P3_prepare_geothermal",
    CLEAN_CTE + _cat_sql("geothermal", O.tech_sql("technology_raw", FX.FIXTURE_TECH_MAP), "TRY_CAST(start_year_raw AS DOUBLE)", "TRY_CAST(retired_year_raw AS DOUBLE)"),
)
def p3(spark, d):
    return P.prepare_geothermal(tracker(spark, d), tech_map=FX.FIXTURE_TECH_MAP, cols=dict(OG_FIXTURE_COLS, plant_name="plant_name"))


@query(
    "P4_prepare_hydropower",
    O.ctes(tracker=O.TRACKER) + f"""SELECT 'GloHydroRes_' || gem_unit_id AS powerplant_id, plant_name AS name, 'hydropower' AS category,
  {O.case_map("coalesce(plant_type, 'unknown')", C.TECHNOLOGY_MAPPING['hydropower'])} AS technology,
  capacity_mw_raw AS output_capacity_mw, TRY_CAST(start_year_raw AS DOUBLE) AS start_year, CAST(NULL AS DOUBLE) AS end_year,
  'operating' AS status, longitude AS lon, latitude AS lat, CASE WHEN res_vol_km3 >= 0 THEN res_vol_km3 END AS reservoir_km3
FROM tracker WHERE capacity_mw_raw IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL""",
)
def p4(spark, d):
    raw = tracker(spark, d).select(
        F.col("gem_unit_id").alias("ID"), F.col("plant_name").alias("name"), "plant_type",
        F.col("capacity_mw_raw").alias("capacity_mw"), F.col("longitude").alias("plant_lon"),
        F.col("latitude").alias("plant_lat"), X.coerce_year("start_year_raw").alias("year"), "res_vol_km3",
    )
    return P.prepare_hydropower(raw)


@query(
    "P5_prepare_nuclear",
    CLEAN_CTE + _cat_sql("nuclear", O.tech_sql("technology_raw", FX.FIXTURE_TECH_MAP), "TRY_CAST(start_year_raw AS DOUBLE)", "TRY_CAST(retired_year_raw AS DOUBLE)"),
)
def p5(spark, d):
    cols = dict(OG_FIXTURE_COLS, plant_name="plant_name", start_date="start_year_raw", end_date="retired_year_raw")
    return P.prepare_nuclear(tracker(spark, d), tech_map=FX.FIXTURE_TECH_MAP, cols=cols)


@query(
    "P7_prepare_wind",
    CLEAN_CTE + _cat_sql(
        "wind", O.case_map("installation_type", C.WIND_INSTALLATION_MAPPING),
        "TRY_CAST(start_year_raw AS DOUBLE)", "TRY_CAST(retired_year_raw AS DOUBLE)",
        where="WHERE installation_type IS NOT NULL AND installation_type <> 'Unknown'",
    ),
)
def p7(spark, d):
    cols = dict(OG_FIXTURE_COLS, plant_name="plant_name", unit_name="unit_name", installation="installation_type")
    return P.prepare_wind_tracker(tracker(spark, d), cols=cols)


# ---------------------------------------------------------------------------
# Exclusive shapes (checked by point membership: in i and in no other)
# ---------------------------------------------------------------------------
@query(
    "E7_exclusive_shapes",
    OV_CTE + "SELECT powerplant_id, any_value(shape_id) AS shape_id FROM m GROUP BY 1 HAVING count(*) = 1",
)
def e7(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    s, e = shapes(spark, d, overlap=True)
    excl = overlay.build_exclusive_shapes(s, e, B)
    return geometry.points_in_shapes(p.select("powerplant_id", "lon", "lat"), excl, B, x="lon", y="lat").select("powerplant_id", "shape_id")


@query(
    "E16_assign_country_split",
    OV_CTE + """, j AS (SELECT m.powerplant_id, m.shape_id, s.country_id, p.output_capacity_mw,
    count(*) OVER (PARTITION BY m.powerplant_id) AS n,
    row_number() OVER (PARTITION BY m.powerplant_id ORDER BY m.shape_id) - 1 AS k
  FROM m JOIN og_plants p USING (powerplant_id) JOIN shapes_ov s USING (shape_id))
SELECT CASE WHEN n > 1 THEN powerplant_id || '_duplicate_' || CAST(k AS VARCHAR) ELSE powerplant_id END AS powerplant_id,
  shape_id, country_id, CASE WHEN n > 1 THEN output_capacity_mw / n ELSE output_capacity_mw END AS output_capacity_mw, n > 1 AS split FROM j""",
)
def e16s(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    s, e = shapes(spark, d, overlap=True)
    excl = overlay.build_exclusive_shapes(s, e, B)
    out = geometry.assign_country(p, s, e, B, on_overlap="split_capacity", exclusive=excl, inner_distance=0.5)
    return out.select("powerplant_id", "shape_id", "country_id", "output_capacity_mw", "split")


def _read_back(spark, attrs, edges, name):
    """Shapes after a round trip through the polygon sink and reader."""
    from capgrid.sources.sinks import write_geo_polygons

    path = _scratch(spark, name)
    write_geo_polygons(attrs, edges, path)
    return R.read_geo_polygons(spark, path)


@query(
    "E7_exclusive_areas",
    O.ctes(**O.SHAPES_OV).rstrip() + "," + O.sweep("edges_ov", "0") + """
SELECT shapes[1] AS shape_id, round(sum((xb - xa) * (hi - lo)), 4) AS area FROM sw_cover WHERE len(shapes) = 1 GROUP BY 1""",
)
def e7a(spark, d):
    s, e = shapes(spark, d, overlap=True)
    _, edges = _read_back(spark, s.select("shape_id"), overlay.build_exclusive_shapes(s, e, B), "exclusive")
    return rings.shape_areas(edges).select("shape_id", F.round("area", 4).alias("area"))


STARS = dict(stars=FX.duck(FX.stars_sql()))


@query(
    "E17_make_valid",
    O.ctes(**STARS).rstrip() + "," + O.sweep("stars", "shape_id") + """
SELECT scope AS shape_id, round(sum((xb - xa) * (hi - lo)), 4) AS area, true AS valid FROM sw_cover GROUP BY 1""",
)
def e17v(spark, d):
    repaired = cut_lineage(rings.make_valid(FX.stand_in(spark, d, FX.stars_sql()), 0.25))
    ids = repaired.select("shape_id").distinct()
    _, edges = _read_back(spark, ids, repaired, "repaired")
    edges = cut_lineage(edges)
    checks = geometry.polygon_checks(edges).join(rings.ring_conflicts(edges, 0.25), on="shape_id")
    fine = F.col("valid") & (F.col("crossings") + F.col("shared_edges") + F.col("holes_outside") + F.col("nested_parts") == 0)
    return rings.shape_areas(edges).join(checks, on="shape_id").select("shape_id", F.round("area", 4).alias("area"), fine.alias("valid"))


def _side_of(p, e, k):
    return f"(({e}.x2 - {e}.x1) * ({p}.y{k} - {e}.y1) - ({e}.y2 - {e}.y1) * ({p}.x{k} - {e}.x1))"


_PASS = " AND ".join(f"sign({_side_of(p, e, 1)}) * sign({_side_of(p, e, 2)}) < 0" for p, e in (("b", "a"), ("a", "b")))
_BETWEEN = lambda p, e, k: f"({_side_of(p, e, k)} = 0 AND {p}.x{k} BETWEEN least({e}.x1, {e}.x2) AND greatest({e}.x1, {e}.x2) AND {p}.y{k} BETWEEN least({e}.y1, {e}.y2) AND greatest({e}.y1, {e}.y2))"
_MEET = f"({_PASS}) OR " + " OR ".join(_BETWEEN(p, e, k) for p, e in (("b", "a"), ("a", "b")) for k in (1, 2))
_ALONG = lambda k: f"((a.x2 - a.x1) * (b.x{k} - a.x1) + (a.y2 - a.y1) * (b.y{k} - a.y1))"


@query(
    "E17_ring_conflicts",
    O.ctes(**STARS, e="SELECT *, (x1 + x2) / 2 AS px, (y1 + y2) / 2 AS py FROM stars").rstrip() + f""",
pairs AS (SELECT a.shape_id, ({_PASS}) AS crossing,
    ({_side_of('b', 'a', 1)} = 0 AND {_side_of('b', 'a', 2)} = 0 AND least(greatest({_ALONG(1)}, {_ALONG(2)}), (a.x2 - a.x1) ** 2 + (a.y2 - a.y1) ** 2) > greatest(least({_ALONG(1)}, {_ALONG(2)}), 0)) AS overlap
  FROM e a JOIN e b ON a.shape_id = b.shape_id AND (a.part, a.ring, a.seq) < (b.part, b.ring, b.seq)),
counted AS (SELECT shape_id, count(*) FILTER (crossing) AS crossings, count(*) FILTER (overlap) AS shared_edges FROM pairs GROUP BY 1),
mid AS (SELECT shape_id, part, ring, px, py FROM e WHERE seq = 0),
ins AS (SELECT m.shape_id, m.part, m.ring, e.part AS other,
    count(*) FILTER ((e.y1 > m.py) <> (e.y2 > m.py) AND m.px < e.x1 + (m.py - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) AND (m.ring = 0 OR e.ring = 0)) % 2 = 1 AS inside
  FROM mid m JOIN e ON m.shape_id = e.shape_id WHERE (m.ring > 0) = (e.part = m.part) GROUP BY ALL),
odd AS (SELECT shape_id, count(*) FILTER (ring > 0 AND NOT inside) AS holes_outside, count(DISTINCT part) FILTER (ring = 0 AND inside) AS nested_parts FROM ins GROUP BY 1)
SELECT c.shape_id, crossings, shared_edges, coalesce(holes_outside, 0) AS holes_outside, coalesce(nested_parts, 0) AS nested_parts FROM counted c LEFT JOIN odd USING (shape_id)""",
)
def e17r(spark, d):
    return rings.ring_conflicts(FX.stand_in(spark, d, FX.stars_sql()), 0.25)


@query(
    "E11_dissolved_borders",
    O.ctes(**O.SHAPES_OV, land="SELECT e.*, s.country_id FROM edges_ov e JOIN shapes_ov s USING (shape_id) WHERE s.shape_class = 'land'").rstrip() + "," + O.sweep("land", "country_id") + """
SELECT scope AS country_id, round(sum((xb - xa) * (hi - lo)), 4) AS area FROM sw_cover GROUP BY 1""",
)
def e11b(spark, d):
    s, e = shapes(spark, d, overlap=True)
    border = geometry.dissolved_borders(s, e, B)
    return rings.shape_areas(border).select(F.col("shape_id").alias("country_id"), F.round("area", 4).alias("area"))


@query("E11_border_pixels", ORACLES["E11_country_pixels"])
def e11c(spark, d):
    s, e = shapes(spark, d, overlap=True)
    border = geometry.dissolved_borders(s, e, B)
    names = border.select("shape_id", F.col("shape_id").alias("country_id")).distinct()
    return raster.pixel_countries(pixels(spark, d), names, border, B).select("prow", "pcol", "country_id")


@query(
    "E12_intersecting_shapes",
    O.ctes(**O.SHAPES_OV, **O.FAC, f="SELECT *, x1 AS px, y1 AS py FROM facility_edges", s="SELECT *, x1 AS px, y1 AS py FROM edges_ov").rstrip() + f""",
met AS (SELECT DISTINCT a.shape_id, b.shape_id AS other_id FROM f a JOIN s b ON least(a.x1, a.x2) <= greatest(b.x1, b.x2) AND least(b.x1, b.x2) <= greatest(a.x1, a.x2)
  AND least(a.y1, a.y2) <= greatest(b.y1, b.y2) AND least(b.y1, b.y2) <= greatest(a.y1, a.y2) WHERE {_MEET}),
start_f AS (SELECT shape_id || '|' || part || '|' || ring AS pid, * FROM f WHERE seq = 0),
start_s AS (SELECT shape_id || '|' || part || '|' || ring AS pid, * FROM s WHERE seq = 0)
SELECT shape_id, other_id FROM met
UNION SELECT split_part(pid, '|', 1) AS shape_id, shape_id AS other_id FROM ({O.pip('start_f', 's', 'px', 'py', 'pid')})
UNION SELECT shape_id, split_part(pid, '|', 1) AS other_id FROM ({O.pip('start_s', 'f', 'px', 'py', 'pid')})""",
)
def e12i(spark, d):
    _, e = shapes(spark, d, overlap=True)
    return rings.intersecting_shapes(FX.stand_in(spark, d, FX.FACILITY_EDGES_SQL), e, 1.0)


# ---------------------------------------------------------------------------
# File sources and the sink: the stand-in is written under the session's
# checkpoint folder (a fresh sub-folder per call) and read back through the
# library reader, so the reader itself is what is checked.
# ---------------------------------------------------------------------------
def _scratch(spark, name):
    import uuid

    from capgrid.session import scratch_path

    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("A9_read_pixels", O.ctes(**O.SHAPES, **O.PIXELS).rstrip()
       + ", pxid AS (SELECT *, CAST(prow AS VARCHAR) || '_' || CAST(pcol AS VARCHAR) AS pid FROM pixels)\n"
       + f"SELECT m.shape_id, s.country_id, sum(p.value) AS sum FROM ({O.pip('pxid', 'edges', 'x', 'y', 'pid')}) m JOIN pxid p USING (pid) JOIN shapes s USING (shape_id) GROUP BY 1, 2")
def a9(spark, d):
    path = _scratch(spark, "pixels")
    pixels(spark, d).write.parquet(path)
    s, e = shapes(spark, d)
    return raster.zonal_sum(R.read_pixels(spark, path), s, e, B)


@query(
    "A9_clustered_pixels",
    O.ctes(**O.SHAPES, **O.PIXELS).rstrip() + SHARES_SQL + """
SELECT h.shape_id, s.country_id, sum(q.value * h.share) AS sum FROM shares h JOIN squares q USING (prow, pcol) JOIN shapes s USING (shape_id)
WHERE h.share > 1e-12 AND s.country_id = 'N06' GROUP BY 1, 2""",
)
def a9_clustered(spark, d):
    """Zonal sums of one country; only row groups around it are read."""
    path = _scratch(spark, "clustered")
    clustered.write_clustered_pixels(pixels(spark, d), path)
    s, e = shapes(spark, d)
    own = s.where("country_id = 'N06'")
    edges = e.join(small(own.select("shape_id")), on="shape_id")
    near = clustered.read_clustered_pixels(spark, path, clustered.box_of_edges(edges, GRID.left, GRID.top, GRID.width, GRID.height))
    return pixel_shares.zonal_sum_by_share(near, own, edges, GRID)


@query("A10_write_output", AGG_CTE + "\nSELECT *, 'fixture' AS shapes, 'unadjusted' AS adjustment, 'fossil' AS category_part FROM agg")
def a10(spark, d):
    from capgrid.sources.sinks import write_output

    path = _scratch(spark, "published")
    write_output(aggregated_df(spark, d), path, "fixture", "unadjusted", "fossil")
    return spark.read.parquet(path)


_HYDRO_CSV_SQL = O.ctes(tracker=O.TRACKER) + f"""SELECT 'GloHydroRes_' || gem_unit_id AS powerplant_id, plant_name AS name, 'hydropower' AS category,
  {O.case_map("coalesce(plant_type, 'unknown')", C.TECHNOLOGY_MAPPING['hydropower'])} AS technology,
  capacity_mw_raw AS output_capacity_mw, TRY_CAST(start_year_raw AS DOUBLE) AS start_year, CAST(NULL AS DOUBLE) AS end_year,
  'operating' AS status, longitude AS lon, latitude AS lat, CASE WHEN res_vol_km3 >= 0 THEN res_vol_km3 END AS reservoir_km3
FROM tracker WHERE capacity_mw_raw IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL"""


@query("A5_read_hydro_csv", _HYDRO_CSV_SQL)
def a5(spark, d):
    path = _scratch(spark, "hydro-csv")
    tracker(spark, d).select(
        F.col("gem_unit_id").alias("ID"), F.col("plant_name").alias("name"), "plant_type",
        F.col("capacity_mw_raw").alias("capacity_mw"), F.col("longitude").alias("plant_lon"),
        F.col("latitude").alias("plant_lat"), X.coerce_year("start_year_raw").alias("year"), "res_vol_km3",
        F.lit("12.5").alias("head_m"),
    ).write.option("header", True).csv(path)
    return P.prepare_hydropower(R.read_hydro_csv(spark, path))


_MARKET_STATUS = {"operating": "Production", "retired": "Dismantled", "construction": "Construction", "announced": "Planned", "pre-construction": "Approved"}


@query(
    "A7_P7_wind_market",
    O.ctes(tracker=O.TRACKER) + f"""SELECT 'WEMI_' || CASE WHEN gem_unit_id LIKE '%7' THEN 'WF-' || substr(gem_unit_id, 2) WHEN gem_unit_id LIKE '%3' THEN 'A' || substr(gem_unit_id, 2)
    WHEN gem_unit_id LIKE '%64' THEN 'nan' ELSE substr(gem_unit_id, 2) END AS powerplant_id, plant_name AS name, 'wind' AS category,
  CASE WHEN technology_raw LIKE '%URGENT%' THEN 'offshore' ELSE 'onshore' END AS technology,
  floor(capacity_mw_raw * 1000) * 0.001e0 AS output_capacity_mw,
  TRY_CAST(start_year_raw AS DOUBLE) AS start_year, CAST(NULL AS DOUBLE) AS end_year,
  coalesce({O.case_map(O.case_map('status', _MARKET_STATUS), C.STATUS_MAPPING_WIND_MARKET)}, {O.case_map('status', _MARKET_STATUS, 'status')}) AS status,
  longitude AS lon, latitude AS lat
FROM tracker WHERE capacity_mw_raw IS NOT NULL AND latitude IS NOT NULL AND status IN ({', '.join(repr(k) for k in _MARKET_STATUS)})""",
)
def a7(spark, d):
    path = _scratch(spark, "wind-market")
    t = tracker(spark, d).where(F.col("status").isin(list(_MARKET_STATUS)))
    number = F.expr("substring(gem_unit_id, 2)")
    units = spark.createDataFrame([("(id)", "(text)", "(kW)", "(km)", "(date)", "(text)", "(deg)", "(deg)")],
                                  "ID string, Name string, `Total power` string, `Offshore\nShore distance` string, `Commissioning date` string, Status string, Latitude string, Longitude string")
    rows = t.select(
        F.when(F.col("gem_unit_id").endswith("7"), F.concat(F.lit("WF-"), number)).when(F.col("gem_unit_id").endswith("3"), F.concat(F.lit("A"), number))
        .when(~F.col("gem_unit_id").endswith("64"), number).alias("ID"), F.col("plant_name").alias("Name"),
        F.coalesce(F.floor(F.col("capacity_mw_raw") * 1000).cast("string"), F.lit("#ND")).alias("Total power"),
        F.when(F.col("technology_raw").contains("URGENT"), F.lit("Yes (8 km)")).otherwise(F.lit("No")).alias("Offshore\nShore distance"),
        F.coalesce(F.concat(F.lit("Q2 "), F.col("start_year_raw")), F.lit("#ND")).alias("Commissioning date"),
        F.coalesce(X.map_status("status", _MARKET_STATUS, keep_unmapped=True), F.lit("#ND")).alias("Status"),
        F.coalesce(F.col("latitude").cast("string"), F.lit("#ND")).alias("Latitude"),
        F.col("longitude").cast("string").alias("Longitude"),
    )
    units.unionByName(rows).write.option("header", True).csv(path)
    raw = R.read_sentinel_table(spark, path, units={"ID": "(id)", "Total power": "(kW)", "Latitude": "(deg)"})
    raw = raw.withColumn("Latitude", F.col("Latitude").cast("double")).withColumn("Longitude", F.col("Longitude").cast("double"))
    return P.prepare_wind_market(raw)


@query("A8_read_geo_polygons", GEO_CTE + O.pip("og_plants", "edges", "lon", "lat", "powerplant_id"))
def a8(spark, d):
    from capgrid.sources.sinks import write_geo_polygons

    path = _scratch(spark, "shapes-geoparquet")
    s, e = shapes(spark, d)
    write_geo_polygons(s, e, path)
    attrs, edges = R.read_geo_polygons(spark, path)
    p, _ = og_plants(spark, d, with_country=False)
    return geometry.points_in_shapes(p.select("powerplant_id", "lon", "lat"), edges, B, x="lon", y="lat").select("powerplant_id", "shape_id")


_EXCLUDED = ["GEM_L899-G0", "GEM_L769-C1"]


@query(
    "A11_combine_with_user_plants",
    O.ctes(**O.BASE, **O.COAL) + "SELECT powerplant_id, category FROM (SELECT powerplant_id, category FROM og_plants UNION ALL "
    "SELECT powerplant_id, category FROM coal_plants) WHERE powerplant_id NOT IN ('" + "', '".join(_EXCLUDED) + "')",
)
def a11(spark, d):
    og, _ = og_plants(spark, d, with_country=False)
    coal, _ = P.prepare_coal(coal_raw(spark, d), FX.FIXTURE_TECH_MAP, cols=COAL_FIXTURE_COLS)
    return R.combine_with_user_plants(og, [coal], _EXCLUDED).select("powerplant_id", "category")


@query("I1_conform", PLANTS_CTE + f"SELECT {_sel(PLANT_OUT)}, ccs, chp, fuel_class FROM og_plants")
def i1(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    return quality.conform(p, quality.PLANT_SCHEMA, optional=quality.PLANT_OPTIONAL)


@query("I4_single_category", PLANTS_CTE + "SELECT DISTINCT category FROM og_plants")
def i4(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    category = quality.single_category(p)
    return p.select("category").where(F.col("category") == category).distinct()


@query("B17_valid_points", CLEAN_CTE + "SELECT gem_unit_id, longitude AS lon, latitude AS lat FROM clean WHERE longitude BETWEEN -180 AND 180 AND latitude BETWEEN -90 AND 90")
def b17(spark, d):
    t = _clean_tracker(spark, d)
    return t.where(X.valid_lonlat("longitude", "latitude")).select("gem_unit_id", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))


@query("E1_project_8857", PLANTS_CTE + f"SELECT powerplant_id, {_EE_X} AS x8857, {_EE_Y} AS y8857 FROM og_plants")
def e1b(spark, d):
    p, _ = og_plants(spark, d, with_country=False)
    x, y = geometry.project("lon", "lat", 8857)
    return p.select("powerplant_id", x.alias("x8857"), y.alias("y8857"))
