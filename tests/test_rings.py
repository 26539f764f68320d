"""Noding, linking, repair, dissolving and shape joins on hand-written and random edge tables."""

import numpy as np
import pytest
from edge_tables import EDGE_DDL, square_edges
from pyspark.sql import functions as F

from capgrid.operators import geometry as G
from capgrid.operators import overlay, raster, rings


def ring(shape_id, pts, part=0, ring=0):
    return [(shape_id, part, ring, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(pts, pts[1:] + pts[:1]))]


def table(spark, rows):
    return spark.createDataFrame(rows, EDGE_DDL)


def areas(edges):
    return {r["shape_id"]: r["area"] for r in rings.shape_areas(edges).collect()}


def layout(edges):
    """{shape: sorted (part, ring, edges)} after checking that every ring closes in the order of its edges."""
    out = {}
    rows = sorted(edges.collect(), key=lambda r: (r["shape_id"], r["part"], r["ring"], r["seq"]))
    groups = {}
    for r in rows:
        groups.setdefault((r["shape_id"], r["part"], r["ring"]), []).append(r)
    for (s, p, k), es in groups.items():
        assert [e["seq"] for e in es] == list(range(len(es)))
        assert all((a["x2"], a["y2"]) == (b["x1"], b["y1"]) for a, b in zip(es, es[1:] + es[:1]))
        assert len({(e["x1"], e["y1"]) for e in es}) == len(es), "a ring passes a vertex once"
        out.setdefault(s, []).append((p, k, len(es)))
    return out


def parity(rows, shape, x, y):
    n = 0
    for s, _, _, _, x1, y1, x2, y2 in rows:
        if s == shape and (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            n += 1
    return n % 2 == 1


def test_repair_of_named_cases(spark):
    rows = ring("bow", [(0, 0), (4, 4), (4, 0), (0, 4)])
    rows += ring("spike", [(0, 10), (4, 10), (4, 14), (6, 14), (4, 14), (0, 14)])
    rows += ring("touch", [(20, 0), (30, 0), (30, 10), (20, 10)]) + ring("touch", [(20, 0), (24, 2), (22, 4)], 0, 1)
    rows += ring("chain", [(20, 20), (30, 20), (30, 30), (20, 30)]) + ring("chain", [(20, 20), (24, 22), (22, 24)], 0, 1) + ring("chain", [(24, 22), (27, 23), (26, 25)], 0, 2)
    rows += ring("island", [(40, 0), (60, 0), (60, 20), (40, 20)]) + ring("island", [(42, 2), (58, 2), (58, 18), (42, 18)], 0, 1) + ring("island", [(45, 5), (50, 5), (50, 10), (45, 10)], 1, 0)
    rows += ring("twice", [(0, 40), (4, 40), (4, 44), (0, 44)]) + ring("twice", [(4, 40), (8, 40), (8, 44), (4, 44)], 1, 0)
    rows += ring("flat", [(0, 30), (5, 30), (2, 30)])
    edges = table(spark, rows)
    valid = rings.make_valid(edges, 1.0).cache()
    assert layout(valid) == {
        "bow": [(0, 0, 3), (1, 0, 3)], "spike": [(0, 0, 4)], "touch": [(0, 0, 4), (0, 1, 3)], "chain": [(0, 0, 4), (0, 1, 3), (0, 2, 3)],
        "island": [(0, 0, 4), (0, 1, 4), (1, 0, 4)], "twice": [(0, 0, 6)],
    }
    assert areas(valid) == pytest.approx({"bow": 8, "spike": 16, "touch": 94, "chain": 100 - 6 - 3.5, "island": 400 - 256 + 25, "twice": 32})
    assert [r[0] for r in rings.rejected_shapes(edges, valid).collect()] == ["flat"]
    checks = G.polygon_checks(valid)
    assert all(r["valid"] for r in checks.collect()) and checks.count() == 6
    before = {r["shape_id"]: r["valid"] for r in G.polygon_checks(edges).collect()}
    assert before["bow"] is False and before["flat"] is False


def test_repair_keeps_even_odd_membership(spark):
    """Sixty shapes of up to three random rings each, whole-number corners (many touch, overlap and cross)."""
    rng = np.random.default_rng(11)
    rows = []
    for k in range(60):
        for part in range(rng.integers(1, 4)):
            rows += ring(f"s{k}", [tuple(map(int, p)) for p in rng.integers(0, 9, size=(rng.integers(3, 8), 2))], part, 0)
    valid = rings.make_valid(table(spark, rows), 2.0).cache()
    layout(valid)
    got = [tuple(r) for r in valid.select("shape_id", "part", "ring", "seq", "x1", "y1", "x2", "y2").collect()]
    assert all(r["valid"] for r in G.polygon_checks(valid).collect())
    conflicts = rings.ring_conflicts(valid, 2.0).collect()
    assert all((r["crossings"], r["shared_edges"], r["holes_outside"], r["nested_parts"]) == (0, 0, 0, 0) for r in conflicts)
    for k in range(60):
        before, after = ([r for r in t if r[0] == f"s{k}"] for t in (rows, got))
        for x, y in rng.uniform(-1, 9, size=(60, 2)):
            assert parity(before, f"s{k}", x, y) == parity(after, f"s{k}", x, y)


def test_exclusive_shapes_are_closed_parts_and_survive_the_sink(spark, tmp_path):
    from capgrid.sources import readers as R
    from capgrid.sources.sinks import write_geo_polygons

    rows = square_edges("A", 0, 0, 10, 10) + square_edges("B", 4, -1, 6, 11) + square_edges("C", 20, 0, 30, 10) + square_edges("C", 22, 2, 28, 8, ring=1) + square_edges("D", 24, 4, 40, 6)
    shapes = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "shape_id string")
    excl = overlay.build_exclusive_shapes(shapes, table(spark, rows), 1.0)
    # B cuts A in two and keeps its two ends; D parts C's ring on the right and keeps two pieces
    assert {s: len({p for p, _, _ in v}) for s, v in layout(excl).items()} == {"A": 2, "B": 2, "C": 1, "D": 2}
    assert areas(excl) == pytest.approx({"A": 80, "B": 4, "C": 64 - 4, "D": 32 - 4})
    path = str(tmp_path / "excl")
    write_geo_polygons(shapes, excl, path)
    _, back = R.read_geo_polygons(spark, path)
    cells = lambda e: sorted((r["shape_id"], r["part"], r["ring"], r["x1"], r["y1"], r["x2"], r["y2"]) for r in e.collect())
    assert cells(back) == cells(excl)


def test_rings_in_metres_and_common_borders_of_unequal_vertices(spark):
    """Neighbours whose common border has more vertices on one side, in projected metres."""
    west = ring("W", [(5_000_000.1, 100.3), (5_001_000.7, 100.3), (5_001_000.7, 2_100.9), (5_000_000.1, 2_100.9)])
    east = ring("E", [(5_001_000.7, 100.3), (5_002_000.2, 100.3), (5_002_000.2, 2_100.9), (5_001_000.7, 2_100.9), (5_001_000.7, 1_500.55), (5_001_000.7, 700.25)])
    one = rings.dissolve(table(spark, west + east).withColumn("country", F.lit("X")), "country", 500.0)
    assert {k: [v[:2] for v in vs] for k, vs in layout(one).items()} == {"X": [(0, 0)]}
    assert areas(one)["X"] == pytest.approx(2000.1 * 2000.6, rel=1e-9)
    apart = overlay.exclusive_edges(table(spark, west + east), 500.0)
    assert areas(apart) == pytest.approx({"W": 1000.6 * 2000.6, "E": 999.5 * 2000.6}, rel=1e-9)


def test_proxy_on_borders_equals_proxy_on_tags(spark):
    from capgrid.plans import queries as Q

    d = "/root/testdata/sf0.001"
    s, e = Q.shapes(spark, d, overlap=True)
    pixels = Q.pixels(spark, d)
    land, tagged = G.country_borders(s, e)
    border = G.dissolved_borders(s, e, Q.B)
    names = border.select("shape_id", F.col("shape_id").alias("country_id")).distinct()
    one = {tuple(r) for r in raster.pixel_countries(pixels, land, tagged, Q.B).select("prow", "pcol", "country_id").distinct().collect()}
    assert one == {tuple(r) for r in raster.pixel_countries(pixels, names, border, Q.B).select("prow", "pcol", "country_id").collect()} != set()


def test_shapes_that_meet(spark):
    left = table(spark, square_edges("a", 0, 0, 10, 10) + square_edges("b", 30, 0, 40, 10) + square_edges("c", 60, 0, 61, 1) + square_edges("h", 80, 0, 90, 10) + square_edges("h", 82, 2, 88, 8, ring=1))
    right = table(spark, square_edges("in", 2, 2, 3, 3) + square_edges("corner", 10, 10, 12, 12) + square_edges("edge", 40, 3, 45, 5) + square_edges("around", 50, -10, 70, 20) + square_edges("far", 200, 0, 201, 1) + square_edges("hole", 84, 4, 86, 6) + square_edges("cross", 4, -5, 5, 15))
    got = {tuple(r) for r in rings.intersecting_shapes(left, right, 1.0).collect()}
    assert got == {("a", "in"), ("a", "corner"), ("b", "edge"), ("c", "around"), ("a", "cross")}


def test_conflicts_between_rings(spark):
    rows = square_edges("ok", 0, 0, 10, 10) + square_edges("ok", 2, 2, 4, 4, ring=1) + square_edges("ok", 20, 0, 30, 10, part=1)
    rows += square_edges("out", 0, 0, 10, 10) + square_edges("out", 12, 2, 14, 4, ring=1)
    rows += square_edges("nest", 0, 0, 10, 10) + square_edges("nest", 2, 2, 4, 4, part=1)
    rows += square_edges("cross", 0, 0, 10, 10) + square_edges("cross", 5, 5, 15, 15, part=1)
    rows += square_edges("share", 0, 0, 10, 10) + square_edges("share", 10, 2, 14, 8, part=1)
    got = {r["shape_id"]: (r["crossings"], r["shared_edges"], r["holes_outside"], r["nested_parts"]) for r in rings.ring_conflicts(table(spark, rows), 1.0).collect()}
    assert got == {"ok": (0, 0, 0, 0), "out": (0, 0, 1, 0), "nest": (0, 0, 0, 1), "cross": (2, 0, 0, 0), "share": (0, 1, 0, 0)}


def test_empty_tables(spark):
    none = table(spark, [])
    assert rings.make_valid(none, 1.0).collect() == []
    assert rings.dissolve(none.withColumn("g", F.lit("x")), "g", 1.0).collect() == []
    assert rings.intersecting_shapes(none, none, 1.0).collect() == []
    assert rings.ring_conflicts(none, 1.0).collect() == []
