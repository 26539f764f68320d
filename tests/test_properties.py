"""Invariants checked on generated inputs (hypothesis; few examples, Spark is slow to start jobs)."""

import math

from edge_tables import EDGE_DDL, square_edges
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from capgrid.operators import fuel_classes, geometry, impute, raster

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

caps = st.floats(min_value=0.001, max_value=1e4, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["A", "B", "C"]), caps), min_size=1, max_size=30))
def test_split_conserves_capacity(spark, rows):
    # one row per (plant, shape); a plant's capacity is the same on each of its rows
    seen, data = {}, []
    for pid, shape, cap in rows:
        key = (pid, shape)
        if key in seen:
            continue
        seen[key] = True
        data.append((f"p{pid}", shape, 0.0))
    base = {f"p{pid}": cap for pid, _, cap in rows}
    data = [(p, s_, base[p]) for p, s_, _ in data]
    df = spark.createDataFrame(data, "powerplant_id string, shape_id string, output_capacity_mw double")
    out = geometry.split_capacity(df).collect()
    totals = {}
    for r in out:
        root = r.powerplant_id.split("_duplicate_")[0]
        totals[root] = totals.get(root, 0.0) + r.output_capacity_mw
    assert all(math.isclose(totals[k], base[k], rel_tol=1e-9) for k in totals)
    assert len({r.powerplant_id for r in out}) == len(out)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.floats(0.1, 100.0)), min_size=1, max_size=40),
       st.floats(1.0, 1e5))
def test_disaggregation_conserves_country_total(spark, pix, total):
    cells = {(r, c): v for r, c, v in pix}
    pixels = spark.createDataFrame(
        [(r, c, c + 0.5, r + 0.5, v) for (r, c), v in cells.items()], "prow int, pcol int, x double, y double, value double"
    )
    shapes = spark.createDataFrame([("S", "X", "land")], "shape_id string, country_id string, shape_class string")
    edges = spark.createDataFrame(square_edges("S", 0, 0, 10, 10), EDGE_DDL)
    totals = spark.createDataFrame([("X", total)], "country_id string, output_capacity_mw double")
    spread = raster.disaggregate_by_proxy(totals, pixels, shapes, edges, 1.0)
    got = spread.agg(F.sum("value")).first()[0]
    assert math.isclose(got, total, rel_tol=1e-9)


years = st.one_of(st.none(), st.integers(1950, 2060).map(float))


@SETTINGS
@given(st.lists(st.tuples(years, years, st.sampled_from(["operating", "retired", "construction"])), min_size=1, max_size=30))
def test_status_is_a_function_of_years(spark, rows):
    ref = 2023
    df = spark.createDataFrame(
        [(f"p{i}", s, e, st_) for i, (s, e, st_) in enumerate(rows)], "powerplant_id string, start_year double, end_year double, status string"
    )
    out = {r.powerplant_id: r.status for r in impute.impute_status(df.dropna(subset=["start_year", "end_year"]), ref).collect()}
    for i, (s, e, _) in enumerate(rows):
        if s is None or e is None:
            continue
        want = "retired" if e <= ref else ("operating" if s <= ref else "planned")
        assert out[f"p{i}"] == want


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(["coal", "gas", "oil", "biomass"]), min_size=1, max_size=3, unique=True), min_size=1, max_size=20))
def test_fuel_codes_are_a_bijection(spark, sets):
    df = spark.createDataFrame([(f"p{i}", sorted(s)) for i, s in enumerate(sets)], "id string, fuels array<string>")
    classes, coded = fuel_classes.encode_sets(df, "fuels", "x")
    by_class = {r.fuel_class: tuple(r.fuels) for r in fuel_classes.sets_by_class(classes).collect()}
    assert len(set(by_class.values())) == len(by_class) == len({tuple(sorted(s)) for s in sets})
    codes = {r.id: r.fuel_class for r in coded.collect()}
    for i, s in enumerate(sets):
        assert by_class[codes[f"p{i}"]] == tuple(sorted(s))
    ranked = sorted(by_class.items(), key=lambda kv: kv[1])
    assert [k for k, _ in ranked] == [f"x{i}" for i in range(len(ranked))]


@SETTINGS
@given(st.lists(st.tuples(st.floats(-2, 12), st.floats(-2, 12)), min_size=1, max_size=30))
def test_within_is_subset_of_intersects(spark, pts):
    edges = spark.createDataFrame(square_edges("S", 0, 0, 10, 10) + square_edges("S", 2, 2, 4, 4, ring=1), EDGE_DDL)
    df = spark.createDataFrame([(f"p{i}", float(x), float(y)) for i, (x, y) in enumerate(pts)], "id string, x double, y double")
    inter = {r.id for r in geometry.points_in_shapes(df, edges, 1.0, boundary="include").collect()}
    within = {r.id for r in geometry.points_in_shapes(df, edges, 1.0, boundary="exclude").collect()}
    assert within <= inter
