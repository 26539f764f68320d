"""Work that must not be done twice or for shapes beside a point: index boxes and cells, points near any shape, shared rows."""

import random

import pytest
from pyspark.sql import functions as F

from capgrid.operators import geometry as G
from capgrid.operators import impute

EDGE_DDL = "shape_id string, part int, ring int, seq int, x1 double, y1 double, x2 double, y2 double"


def _ring(name, pts, closed=True):
    ends = [*zip(pts, pts[1:]), *([(pts[-1], pts[0])] if closed else [])]
    return [(name, 0, 0, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(ends)]


def _square(name, x, y, side=1.0):
    return _ring(name, [(x, y), (x + side, y), (x + side, y + side), (x, y + side)])


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_box_of_an_index_row_loses_no_match(spark):
    """Closed and open rings, more edges than the written-out test takes, points on a grid and beside it."""
    rng = random.Random(5)
    rows = []
    for k in range(12):
        pts = [(rng.randrange(-8, 9) / 2, rng.randrange(-8, 9) / 2) for _ in range(rng.choice([3, 4, 9]))]
        rows += _ring(f"s{k:02d}", pts, closed=k % 3 > 0)
    edges = spark.createDataFrame(rows, EDGE_DDL)
    at = [(x / 4, y / 4) for x in range(-24, 25) for y in range(-24, 25)] + [(rng.uniform(-6, 6), rng.uniform(-6, 6)) for _ in range(400)] + [(None, 1.0), (1.0, None)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(at)], "id int, x double, y double")
    closed = {f"s{k:02d}" for k in range(12) if k % 3}
    every = points.dropna().crossJoin(edges.groupBy("shape_id").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges")))
    ray = (G.crossing_count(F.col("edges"), F.col("x"), F.col("y")) % 2) == 1
    on, gap = G.on_boundary(F.col("edges"), F.col("x"), F.col("y")), G.min_edge_distance(F.col("edges"), F.col("x"), F.col("y"))
    tests = {("include", 0.0): ray | on, ("exclude", 0.0): ray & ~on, ("include", 0.3): ray | (gap <= 0.3)}
    truth = {k: {(r.id, r.shape_id) for r in every.where(t).collect()} for k, t in tests.items()}
    for xcell in (0.5, 5.6):
        for boundary, pad in (("include", 0.0), ("exclude", 0.0), ("include", 0.3)):
            index = G.band_index(edges, 0.7, pad, xcell).localCheckpoint()
            plain = index.withColumn("box", F.lit(None).cast(index.schema["box"].dataType))
            with_box, without = ({(r.id, r.shape_id) for r in G._probe(points, i, 0, 0.7, xcell, "x", "y", boundary, pad or None).collect()} for i in (index, plain))
            # left of an open ring the index alone finds points that no ray test does; of true matches the box loses none
            assert with_box <= without and not (without - with_box) & truth[boundary, pad]
            assert {m for m in with_box if m[1] in closed} == {m for m in truth[boundary, pad] if m[1] in closed} != set()


def test_cells_fit_narrow_shapes(spark):
    """a point meets the index rows of the shapes around it, not of all within eight band heights."""
    squares = [r for i in range(40) for r in _square(f"q{i:02d}", 0.3 * i, 0.13 * (i % 5), 0.25)]
    edges = spark.createDataFrame(squares, EDGE_DDL)
    index, _, xcell = G.fitted_index(edges, 0.5)
    assert xcell < 0.3 < G.default_xcell(0.5)
    assert index.groupBy("b", "c").count().agg(F.max("count")).first()[0] <= 3
    wide = spark.createDataFrame(_square("w", 0, 0, 100.0), EDGE_DDL)
    assert G.fitted_xcell(wide, 0.5) == G.default_xcell(0.5)
    assert G.fitted_xcell(edges.limit(0), 0.5) == G.default_xcell(0.5)


def test_points_near_several_shapes_come_once(spark):
    """asked without pairs, a point comes once whatever number of shapes is near; equal rows stay apart."""
    edges = spark.createDataFrame([r for i in range(6) for r in _square(f"q{i}", i / 8, 0)], EDGE_DDL)
    points = spark.createDataFrame([("in", 0.9, 0.5), ("in", 0.9, 0.5), ("near", -0.05, 0.5), ("far", 3.0, 0.5), ("none", None, 0.5)], "id string, x double, y double")
    pairs = G.points_within_distance(points, edges, 0.1, 0.5)
    once = G.points_within_distance(points, edges, 0.1, 0.5, pairs=False)
    assert once.columns == points.columns
    assert sorted(r.id for r in once.collect()) == ["in", "in", "near"]
    assert {r.id for r in pairs.collect()} == {"in", "near"} and pairs.count() > 6


def test_projection_is_not_repeated_in_null_tests(spark):
    """no filter below the join computes the projected coordinates once more."""
    edges = G.project_edges(spark.createDataFrame(_square("q", 0, 0), EDGE_DDL), 8857)
    x, y = G.project("lon", "lat", 8857)
    points = spark.createDataFrame([("a", 0.5, 0.5), ("b", None, 0.5), ("c", 5.0, 0.5)], "id string, lon double, lat double").withColumns({"_x": x, "_y": y})
    for df in (G.points_in_shapes(points, edges, 100_000.0, x="_x", y="_y"), G.points_within_distance(points, edges, 1000.0, 100_000.0, x="_x", y="_y", pairs=False)):
        assert [r.id for r in df.select("id").collect()] == ["a"]
        assert not [line for line in _plan(df).splitlines() if "Filter" in line and "ASIN" in line.upper()]


def test_points_behind_facility_statistics_are_read_once(spark):
    """years and modes come from one pass over the matched points."""
    within = spark.range(40).selectExpr("'f' || id % 3 AS shape_id", "2000e0 + id % 4 AS start_year", "CAST(NULL AS DOUBLE) AS end_year", "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 'retired' ELSE 'operating' END AS status")
    facilities = spark.createDataFrame([("f0", 1.0, 1990.0, None, "x"), ("f9", 2.0, 1991.0, None, "x")], "shape_id string, output_capacity_mw double, start_year double, end_year double, status string")
    out = impute.fill_from_points(facilities, within)
    assert "Range" not in _plan(out)
    assert {r.shape_id: (r.start_year, r.status) for r in out.collect()} == {"f0": (2002.0, "retired"), "f9": (1991.0, "x")}


@pytest.mark.parametrize("band", [0.5])
def test_split_plants_are_matched_once(spark, band):
    """the matched plants are written once; neither the rows that stay nor those that move match again."""
    edges = spark.createDataFrame(_square("a", 0, 0, 4.0) + _square("b", 3, 0, 4.0), EDGE_DDL)
    shapes = spark.createDataFrame([("a", "A"), ("b", "B")], "shape_id string, country_id string")
    plants = spark.range(8).selectExpr("'p' || id AS powerplant_id", "id + 0.25e0 AS lon", "1.5e0 AS lat", "10e0 AS output_capacity_mw")
    out = G.assign_country(plants, shapes, edges, band, on_overlap="split_capacity", inner_distance=0.1)
    assert "Range" not in _plan(out)
    got = sorted((r.powerplant_id, r.shape_id, r.output_capacity_mw) for r in out.collect())
    assert got == [("p0", "a", 10.0), ("p1", "a", 10.0), ("p2", "a", 10.0), ("p3_duplicate_0", "a", 5.0), ("p3_duplicate_1", "b", 5.0), ("p4", "b", 10.0), ("p5", "b", 10.0), ("p6", "b", 10.0)]
