"""Column functions, fuel sets, imputation and capacity rules on hand-written edge rows."""

import pytest
from pyspark.sql import functions as F

from capgrid import config as C
from capgrid.functions import columns as X
from capgrid.functions.fuels import parse_fuel_set
from capgrid.operators import capacity, fuel_classes, impute, quality
from capgrid.sources import readers as R


def test_drop_invalid_status_case_sensitive(spark):
    df = spark.createDataFrame([("a", "operating"), ("b", "shelved - inferred 2 y"), ("c", "Cancelled"), ("d", None)], "id string, status string")
    assert sorted(r.id for r in R.drop_invalid_status(df).collect()) == ["a", "c", "d"]


def test_technology_cleaning_and_strict_gate(spark):
    m = {"gas turbine": "ocgt", "unknown": "ocgt", "combined cycle": "ccgt"}
    df = spark.createDataFrame([("combined cycle/CCS",), (None,), ("unknown type",), ("gas turbine ",)], "t string")
    assert [r[0] for r in df.select(X.map_technology("t", m)).collect()] == ["ccgt", "ocgt", "ocgt", "ocgt"]
    bad = spark.createDataFrame([("steam",)], "t string")
    with pytest.raises(Exception, match="technology without an entry"):
        bad.select(X.map_technology("t", m)).collect()


def test_ac_capacity_ratings(spark):
    df = spark.createDataFrame([(10.0, "MWac"), (10.0, "MWp/dc"), (10.0, None), (10.0, "unknown")], "c double, r string")
    assert [r[0] for r in df.select(X.ac_capacity("c", "r", 1.25)).collect()] == [10.0, 8.0, 10.0, 10.0]
    with pytest.raises(Exception, match="unknown capacity rating"):
        spark.createDataFrame([(1.0, "kW")], "c double, r string").select(X.ac_capacity("c", "r", 1.25)).collect()


def test_end_year_chosen_before_parsing(spark):
    df = spark.createDataFrame([("unknown", "2040"), (None, "2040"), ("2030", None)], "ret string, plan string")
    assert [r[0] for r in df.select(X.first_present_number("ret", "plan")).collect()] == [None, 2040.0, 2030.0]


def test_mixed_dates_and_first_year(spark):
    df = spark.createDataFrame([("1974-03-15",), ("March 1974",), ("03/1974",), ("1974",), ("garbage",)], "d string")
    assert [r[0] for r in df.select(X.year_of_mixed_date("d")).collect()] == [1974.0] * 4 + [None]
    t = spark.createDataFrame([("Q3 2011 / 2012",), ("n/a",)], "d string")
    assert [r[0] for r in t.select(X.first_year_in_text("d")).collect()] == [2011.0, None]


def test_combined_text_nan(spark):
    df = spark.createDataFrame([("L1", None)], "a string, b string")
    assert df.select(X.combined_text(["a", "b"], prefix="GEM_")).first()[0] == "GEM_L1-nan"


def test_parse_fuel_set_edge_cells(spark):
    cells = [
        ("fossil gas: natural gas [60%], fossil liquids: diesel [40%]",),
        ("coal",),
        (None,),
        ("other: other",),
        ("other: unknown, fossil gas: LNG, fossil gas: natural gas",),
        ("industrial by-product: ",),
    ]
    df = spark.createDataFrame(cells, "f string")
    got = [r[0] for r in df.select(parse_fuel_set("f", C.FUEL_MAPPING, "fossil gas: unknown")).collect()]
    assert got == [["diesel", "natural gas"], ["brown coal"], ["natural gas"], ["natural gas"], ["natural gas"], ["solid waste"]]
    with pytest.raises(Exception, match="fuel without an entry"):
        spark.createDataFrame([("plutonium: pellets",)], "f string").select(parse_fuel_set("f", C.FUEL_MAPPING, "coal: unknown")).collect()


def test_encode_and_remap_classes(spark):
    df = spark.createDataFrame([("a", ["oil"]), ("b", ["coal", "oil"]), ("c", ["oil"]), ("d", ["coal"])], "id string, fuels array<string>")
    classes, coded = fuel_classes.encode_sets(df, "fuels", "x")
    codes = {r.id: r.fuel_class for r in coded.collect()}
    assert codes == {"d": "x0", "b": "x1", "a": "x2", "c": "x2"}
    other = spark.createDataFrame([("y0", "oil"), ("y1", "gas")], "fuel_class string, fuel string")
    new = fuel_classes.harmonise_classes([classes, other], prefix="fc")
    plants = coded.select("id", "fuel_class")
    remapped = {r.id: r.fuel_class for r in fuel_classes.remap_classes(plants, classes, new).collect()}
    new_sets = {r.fuel_class: tuple(r.fuels) for r in fuel_classes.sets_by_class(new).collect()}
    assert new_sets[remapped["b"]] == ("coal", "oil") and new_sets[remapped["a"]] == ("oil",)


IMPUTE_DDL = "powerplant_id string, country_id string, category string, technology string, status string, start_year double, end_year double, output_capacity_mw double"


def test_impute_start_year_half_even_and_lifetime(spark):
    rows = [
        ("a", "X", "c", "t", "operating", 2000.0, None, 1.0),
        ("b", "X", "c", "t", "operating", 2001.0, None, 1.0),
        ("c", "X", "c", "t", "operating", None, None, 1.0),  # mean 2000.5 -> 2000
        ("d", "Y", "c", "t", "operating", 2001.0, None, 1.0),
        ("e", "Y", "c", "t", "operating", 2002.0, None, 1.0),
        ("f", "Y", "c", "t", "operating", None, None, 1.0),  # mean 2001.5 -> 2002
        ("g", "Y", "c", "t", "operating", None, 2030.0, 1.0),  # lifetime: 2030 - 10
    ]
    df = spark.createDataFrame(rows, IMPUTE_DDL)
    got = {r.powerplant_id: r.start_year for r in impute.impute_start_year(df, {"t": 10}).collect()}
    assert got["c"] == 2000.0 and got["f"] == 2002.0 and got["g"] == 2020.0


def test_impute_end_year_and_status(spark):
    ref = 2023
    rows = [
        ("op_old", "X", "c", "t", "operating", 1990.0, None, 1.0),  # 2000 <= ref -> max(2000+5, 2024)
        ("op_rep", "X", "c", "t", "operating", 2000.0, 2023.0, 1.0),  # reported end overridden
        ("ret", "X", "c", "t", "retired", 2000.0, 2023.0, 1.0),
        ("fut", "X", "c", "t", "construction", 2025.0, 2020.0, 1.0),  # start>ref, end<=ref -> retired
        ("plan", "X", "c", "t", "construction", 2025.0, None, 1.0),
    ]
    df = spark.createDataFrame(rows, IMPUTE_DDL)
    out = impute.impute_status(impute.impute_end_year(df, {"t": 10}, {"t": 5}, ref), ref)
    got = {r.powerplant_id: (r.end_year, r.status) for r in out.collect()}
    assert got == {
        "op_old": (2024.0, "operating"),
        "op_rep": (2028.0, "operating"),
        "ret": (2023.0, "retired"),
        "fut": (2020.0, "retired"),
        "plan": (2035.0, "planned"),
    }


def test_fill_from_points_mode_ties(spark):
    fac = spark.createDataFrame([("F1", 1.0, 2010.0, None, "operating"), ("F2", 1.0, 2010.0, None, "operating")], "shape_id string, output_capacity_mw double, start_year double, end_year double, status string")
    pts = spark.createDataFrame(
        [("F1", 2000.0, None, "retired"), ("F1", 2001.0, None, "construction"), ("F2", 2001.0, 2030.0, "retired"), ("F2", 2002.0, 2031.0, "retired")],
        "shape_id string, start_year double, end_year double, status string",
    )
    got = {r.shape_id: (r.start_year, r.end_year, r.status) for r in impute.fill_from_points(fac, pts).collect()}
    assert got == {"F1": (2000.0, None, "operating"), "F2": (2002.0, 2030.0, "retired")}


def test_adjust_capacity_rules(spark):
    plants = spark.createDataFrame(
        [
            ("a", "X", "fossil", "t", "operating", 2000.0, 2030.0, 1.0),
            ("b", "X", "fossil", "t", "operating", 2000.0, 2030.0, 3.0),
            ("c", "Z", "fossil", "t", "operating", 2000.0, 2030.0, 5.0),  # zero statistic -> removed
            ("d", "X", "fossil", "t", "planned", 2030.0, 2050.0, 7.0),  # future -> unchanged
        ],
        IMPUTE_DDL,
    )
    stats = spark.createDataFrame([(2023, "fossil fuels", 8.0, "X"), (2023, "fossil fuels", 0.0, "Z")], "year int, category string, capacity_mw double, country_id string")
    got = {r.powerplant_id: r.output_capacity_mw for r in capacity.adjust_capacity(plants, stats, 2023, "fossil").collect()}
    assert got == {"a": 2.0, "b": 6.0, "d": 7.0}


def test_check_rules_counts(spark):
    df = spark.createDataFrame([("a", 1.0, "operating"), ("a", -1.0, "bogus"), (None, 2.0, None)], "powerplant_id string, output_capacity_mw double, status string")
    rules = [quality.Rule("powerplant_id", "unique"), quality.Rule("powerplant_id", "not_null"), quality.Rule("output_capacity_mw", "gt", 0),
             quality.Rule("status", "isin", C.PREPARED_STATUS), quality.Rule("status", "not_null")]
    got = {r.rule: r.failures for r in quality.check_rules(df, rules).collect()}
    assert got == {"powerplant_id:unique": 2, "powerplant_id:not_null": 1, "output_capacity_mw:gt": 1, "status:isin": 1, "status:not_null": 1}
    with pytest.raises(ValueError):
        quality.gate(df, rules, "raise")


def test_conform_strict(spark):
    df = spark.createDataFrame([("x", "1")], "a string, b string")
    schema = quality.T.StructType([quality.T.StructField("a", quality.T.StringType()), quality.T.StructField("b", quality.T.DoubleType())])
    assert quality.conform(df, schema).schema["b"].dataType == quality.T.DoubleType()
    with pytest.raises(ValueError):
        quality.conform(df.withColumn("c", F.lit(1)), schema)


def test_zero_denominators_give_null_not_errors(spark):
    from edge_tables import EDGE_DDL, square_edges

    from capgrid.operators import raster

    plants = spark.createDataFrame([("a", "X", 0.0), ("b", "X", 0.0)], "powerplant_id string, country_id string, output_capacity_mw double")
    expected = spark.createDataFrame([("X", 5.0)], "country_id string, expected double")
    assert [r.output_capacity_mw for r in capacity.scale_to_total(plants, expected).collect()] == [None, None]
    pixels = spark.createDataFrame([(0, 0, 0.5, 0.5, 0.0)], "prow int, pcol int, x double, y double, value double")
    shapes = spark.createDataFrame([("S", "X", "land")], "shape_id string, country_id string, shape_class string")
    edges = spark.createDataFrame(square_edges("S", 0, 0, 10, 10), EDGE_DDL)
    totals = spark.createDataFrame([("X", 7.0)], "country_id string, output_capacity_mw double")
    assert raster.disaggregate_by_proxy(totals, pixels, shapes, edges, 1.0).first()["value"] is None


def test_coarsen_to_budget(spark):
    from capgrid.operators import raster

    rows = [(r, c, float(c), float(r), float(r * 10 + c)) for r in range(10) for c in range(9)]
    pixels = spark.createDataFrame(rows, "prow int, pcol int, x double, y double, value double")
    assert raster.coarsen_factor(90, 10) == 3
    out = {(r.brow, r.bcol): r.value for r in raster.coarsen_to_budget(pixels, budget=10).collect()}
    # 10 x 9 grid, factor 3: the tenth row is trimmed, 3 x 3 blocks remain
    assert len(out) == 9 and out[(0, 0)] == sum(r * 10 + c for r in range(3) for c in range(3)) / 9


def test_unparsable_dates_can_stop_the_job(spark):
    dates = spark.createDataFrame([("1974-05-01",), (" ",), (None,)], "d string")
    strict = X.year_of_mixed_date("d", on_error="raise").alias("y")
    assert [r["y"] for r in dates.select(strict).collect()] == [1974.0, None, None]
    with pytest.raises(Exception, match="no known layout: sometime"):
        dates.union(spark.createDataFrame([("sometime",)], "d string")).select(strict).collect()
    with pytest.raises(ValueError):
        X.year_of_mixed_date("d", on_error="skip")
