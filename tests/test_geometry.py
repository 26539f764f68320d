"""Point-in-polygon, distance, nearest, representative point and placement on hand-made shapes."""

import math

import numpy as np
from edge_tables import EDGE_DDL, square_edges
import pytest
from pyspark.sql import functions as F

from capgrid.operators import geometry as G
from capgrid.operators.place import edges_met, listed_edges, place_inside


def _edges(spark):
    rows = []
    rows += square_edges("A", 0, 0, 10, 10)  # square with a hole
    rows += square_edges("A", 4, 4, 6, 6, ring=1)
    rows += square_edges("B", 10, 0, 20, 10)  # shares the x=10 border with A
    rows += square_edges("C", 30, 0, 32, 2)  # two parts
    rows += square_edges("C", 40, 0, 42, 2, part=1)
    return spark.createDataFrame(rows, EDGE_DDL)


def _points(spark):
    pts = [
        ("in_a", 1.5, 1.5),
        ("hole", 5.0, 5.0),
        ("edge_a", 0.0, 5.0),
        ("vertex_a", 0.0, 0.0),
        ("shared", 10.0, 5.0),
        ("in_b", 15.0, 5.0),
        ("part2", 41.0, 1.0),
        ("outside", 50.0, 50.0),
        ("hole_edge", 4.0, 5.0),
    ]
    return spark.createDataFrame(pts, "id string, x double, y double")


def _matches(df):
    return sorted((r["id"], r["shape_id"]) for r in df.collect())


def test_intersects_counts_boundary(spark):
    got = _matches(G.points_in_shapes(_points(spark), _edges(spark), band=1.0, boundary="include"))
    assert got == sorted(
        [
            ("in_a", "A"), ("edge_a", "A"), ("vertex_a", "A"), ("shared", "A"), ("shared", "B"),
            ("in_b", "B"), ("part2", "C"), ("hole_edge", "A"),
        ]
    )


def test_within_excludes_boundary(spark):
    got = _matches(G.points_in_shapes(_points(spark), _edges(spark), band=1.0, boundary="exclude"))
    assert got == sorted([("in_a", "A"), ("in_b", "B"), ("part2", "C")])


def test_band_height_does_not_change_answer(spark):
    a = _matches(G.points_in_shapes(_points(spark), _edges(spark), band=0.3))
    b = _matches(G.points_in_shapes(_points(spark), _edges(spark), band=7.0))
    assert a == b


def test_random_points_against_numpy(spark):
    rng = np.random.default_rng(7)
    xy = rng.uniform(-2, 45, size=(2000, 2)).round(3) + 0.0001
    pts = spark.createDataFrame([(f"p{i}", float(x), float(y)) for i, (x, y) in enumerate(xy)], "id string, x double, y double")
    got = set(_matches(G.points_in_shapes(pts, _edges(spark), band=0.7)))

    def inside_square(x, y, x0, y0, x1, y1):
        return x0 <= x <= x1 and y0 <= y <= y1

    want = set()
    for i, (x, y) in enumerate(xy):
        if inside_square(x, y, 0, 0, 10, 10) and not (4 < x < 6 and 4 < y < 6):
            want.add((f"p{i}", "A"))
        if inside_square(x, y, 10, 0, 20, 10):
            want.add((f"p{i}", "B"))
        if inside_square(x, y, 30, 0, 32, 2) or inside_square(x, y, 40, 0, 42, 2):
            want.add((f"p{i}", "C"))
    assert got == want


def _ring(shape, ring, cx, cy, radius, n, rng):
    angle = np.sort(rng.uniform(0, 2 * np.pi, n))
    r = radius * rng.uniform(0.3, 1.0, n)
    x, y = cx + r * np.cos(angle), cy + r * np.sin(angle)
    if ring == 0:
        y = np.round(y * 2) / 2  # vertices and whole edges on band borders
    return [(shape, 0, ring, i, float(x[i]), float(y[i]), float(x[(i + 1) % n]), float(y[(i + 1) % n])) for i in range(n)]


def test_index_against_full_ray_test(spark):
    """Jagged rings with holes: the index gives the answer of all edges, at every band height and with padding."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(4):
        cx, cy = rng.uniform(-20, 20, 2)
        rows += _ring(f"s{k}", 0, cx, cy, 15, 60, rng) + _ring(f"s{k}", 1, cx, cy, 4, 15, rng)
    xy = rng.uniform(-40, 40, (1500, 2))
    xy[:300] = np.round(xy[:300] * 2) / 2
    want = set()
    for shape in {r[0] for r in rows}:
        x1, y1, x2, y2 = np.array([r[4:] for r in rows if r[0] == shape]).T[:, None, :]
        px, py = xy[:, :1], xy[:, 1:]
        with np.errstate(divide="ignore", invalid="ignore"):
            crossed = ((y1 > py) != (y2 > py)) & (px < x1 + (py - y1) * (x2 - x1) / (y2 - y1))
        on = (((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)) == 0) & (px >= np.minimum(x1, x2)) & (px <= np.maximum(x1, x2)) & (py >= np.minimum(y1, y2)) & (py <= np.maximum(y1, y2))
        want |= {(str(i), shape) for i in np.flatnonzero((crossed.sum(1) % 2 == 1) & ~on.any(1))}
    edges = spark.createDataFrame(rows, EDGE_DDL)
    points = spark.createDataFrame([(str(i), float(a), float(b)) for i, (a, b) in enumerate(xy)], "id string, x double, y double")
    for band in (0.1, 0.5, 3.0, 100.0):
        assert set(_matches(G.points_in_shapes(points, edges, band, boundary="exclude"))) == want
    assert set(_matches(G.points_within_distance(points, edges, 0.0, 0.5))) >= want


def test_edges_are_copied_to_the_cells_they_touch_only(spark):
    n = 4000
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    x, y = 100 * np.cos(angle), 100 * np.sin(angle)
    edges = spark.createDataFrame([("o", 0, 0, i, float(x[i]), float(y[i]), float(x[(i + 1) % n]), float(y[(i + 1) % n])) for i in range(n)], EDGE_DDL)
    for band, most in ((2.0, 1.3), (0.2, 2.2), (0.05, 5.0)):
        index = G.band_index(edges, band)
        copies = index.selectExpr("sum(size(edges)) AS n").first()["n"]
        assert n <= copies <= most * n
    assert index.where("size(edges) = 0 AND base = 1").count() > 0


def test_within_distance(spark):
    pts = spark.createDataFrame([("near", 21.0, 5.0), ("far", 25.0, 5.0), ("inside", 15.0, 5.0)], "id string, x double, y double")
    got = _matches(G.points_within_distance(pts, _edges(spark), 1.5, band=1.0))
    assert got == [("inside", "B"), ("near", "B")]


def test_nearest_shape_tie_smallest_id(spark):
    rows = square_edges("S2", 0, 0, 2, 2) + square_edges("S1", 4, 0, 6, 2)
    edges = spark.createDataFrame(rows, EDGE_DDL)
    shapes = spark.createDataFrame([("S1", "X", "land"), ("S2", "X", "land")], "shape_id string, country_id string, shape_class string")
    pts = spark.createDataFrame([("mid", 3.0, 1.0, "X", "land"), ("left", -1.0, 1.0, "X", "land")], "powerplant_id string, x double, y double, country_id string, shape_class string")
    got = {r["powerplant_id"]: (r["shape_id"], r["distance"]) for r in G.nearest_shape(pts, shapes, edges).collect()}
    assert got == {"mid": ("S1", 1.0), "left": ("S2", 1.0)}


def test_representative_point_inside(spark):
    ring = [(0.0, 0.0), (6.0, 0.0), (6.0, 2.0), (2.0, 2.0), (2.0, 6.0), (0.0, 6.0)]
    rows = [("L", 0, 0, i, *a, *b) for i, (a, b) in enumerate(zip(ring, ring[1:] + ring[:1]))]
    edges = spark.createDataFrame(rows, EDGE_DDL)
    rep = G.representative_points(edges).collect()[0]
    pt = spark.createDataFrame([("r", rep["rx"], rep["ry"])], "id string, x double, y double")
    assert _matches(G.points_in_shapes(pt, edges, 1.0, boundary="exclude")) == [("r", "L")]


def test_place_inside(spark):
    """Ray through the contact, the middle of a short stretch, points that touch already, and holes."""
    ring = [(0, 0), (0, 10), (10, 10), (10, 0)]
    hole = [("H", 0, 1, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip([(4, 4), (6, 4), (6, 6), (4, 6)], [(6, 4), (6, 6), (4, 6), (4, 4)]))]
    rows = (
        square_edges("S", 0, 0, 10, 10) + square_edges("T", 0, 0, 1, 10)
        + [("H", 0, 0, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(ring, ring[1:] + ring[:1]))] + hole
        + square_edges("M", 0, 0, 1, 1, part=0) + square_edges("M", 5, 0, 9, 4, part=1)
    )
    points = [
        ("outside", -5.0, 5.0, "S", (1.0, 5.0)),
        ("narrow", -3.0, 5.0, "T", (0.5, 5.0)),
        ("corner", -3.0, -4.0, "S", (0.6, 0.8)),
        ("inside", 5.0, 2.0, "S", (5.0, 3.0)),  # towards the representative point (5, 5)
        ("border", 0.0, 5.0, "S", (1.0, 5.0)),
        ("in hole", 5.0, 5.5, "H", (5.0, 7.0)),
        ("second part", 12.0, 2.0, "M", (8.0, 2.0)),
    ]
    edges = spark.createDataFrame(rows, EDGE_DDL)
    frame = spark.createDataFrame([p[:4] for p in points], "powerplant_id string, lon double, lat double, shape_id string")
    got = {r["powerplant_id"]: (r["new_x"], r["new_y"]) for r in place_inside(frame, edges, 1.0).collect()}
    assert set(got) == {p[0] for p in points}
    for name, _, _, _, want in points:
        assert np.allclose(got[name], want), (name, got[name])
    strict = G.points_in_shapes(spark.createDataFrame([(k, *v) for k, v in got.items()], "id string, x double, y double"), edges, 1.0, boundary="exclude")
    assert {m[0] for m in _matches(strict)} >= set(got)


def test_split_capacity_names(spark):
    df = spark.createDataFrame([("p", "B", 9.0), ("p", "A", 9.0), ("q", "A", 3.0)], "powerplant_id string, shape_id string, output_capacity_mw double")
    got = sorted((r[0], r[1], r[2], r[3]) for r in G.split_capacity(df).collect())
    assert got == [("p_duplicate_0", "A", 4.5, True), ("p_duplicate_1", "B", 4.5, True), ("q", "A", 3.0, False)]


def test_polygon_checks(spark):
    rows = square_edges("ok", 0, 0, 1, 1) + [("open", 0, 0, 0, 0.0, 0.0, 1.0, 0.0), ("open", 0, 0, 1, 1.0, 0.0, 1.0, 1.0)]
    got = {r["shape_id"]: r["valid"] for r in G.polygon_checks(spark.createDataFrame(rows, EDGE_DDL)).collect()}
    assert got == {"ok": True, "open": False}


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(12.5, 41.9), (-70.0, -33.4), (179.0, 80.0)], "lon double, lat double")
    for epsg in (3857, 8857):
        x, y = G.project("lon", "lat", epsg)
        back = df.select(x.alias("x"), y.alias("y"))
        lon, lat = G.unproject("x", "y", epsg)
        out = back.select(lon.alias("lon"), lat.alias("lat")).collect()
        for (a, b), r in zip([(12.5, 41.9), (-70.0, -33.4), (179.0, 80.0)], out):
            assert abs(r["lon"] - a) < 1e-6 and abs(r["lat"] - b) < 1e-5
    x, y = G.project(F.lit(180.0), F.lit(0.0), 8857)
    assert abs(df.limit(1).select(x).first()[0] - 17243959.06) < 0.5


def test_exclusive_shapes_membership(spark):
    from capgrid.operators import overlay

    rows = square_edges("A", 0, 0, 10, 10) + square_edges("B", 5, 5, 15, 15) + square_edges("C", 10, 0, 20, 5)
    edges = spark.createDataFrame(rows, EDGE_DDL)
    shapes = spark.createDataFrame([("A",), ("B",), ("C",)], "shape_id string")
    ex = overlay.build_exclusive_shapes(shapes, edges, 1.0)
    rng = np.random.default_rng(3)
    xy = rng.uniform(-1, 21, size=(1500, 2)) + 0.00013
    pts = spark.createDataFrame([(f"p{i}", float(x), float(y)) for i, (x, y) in enumerate(xy)], "id string, x double, y double")
    got = {(r.id, r.shape_id) for r in G.points_in_shapes(pts, ex, 1.0).collect()}
    boxes = {"A": (0, 0, 10, 10), "B": (5, 5, 15, 15), "C": (10, 0, 20, 5)}
    want = set()
    for i, (x, y) in enumerate(xy):
        ins = [k for k, (a, b, c, d) in boxes.items() if a <= x <= c and b <= y <= d]
        if len(ins) == 1:
            want.add((f"p{i}", ins[0]))
    assert got == want


def test_exclusive_shapes_fully_covered_raises(spark):
    import pytest

    from capgrid.operators import overlay

    rows = square_edges("A", 0, 0, 10, 10) + square_edges("D", 2, 2, 3, 3)
    edges = spark.createDataFrame(rows, EDGE_DDL)
    shapes = spark.createDataFrame([("A",), ("D",)], "shape_id string")
    with pytest.raises(ValueError, match="D"):
        overlay.build_exclusive_shapes(shapes, edges, 1.0)


def test_split_copies_move_into_exclusive_part(spark):
    from capgrid.operators import overlay

    rows = square_edges("A", 0, 0, 10, 10) + square_edges("B", 5, 0, 15, 10)
    edges = spark.createDataFrame(rows, EDGE_DDL)
    shapes = spark.createDataFrame([("A", "X"), ("B", "Y")], "shape_id string, country_id string")
    ex = overlay.build_exclusive_shapes(shapes, edges, 1.0)
    plants = spark.createDataFrame([("p", 7.0, 5.0, 10.0)], "powerplant_id string, lon double, lat double, output_capacity_mw double")
    out = geometry_rows = G.assign_country(plants, shapes, edges, 1.0, on_overlap="split_capacity", exclusive=ex, inner_distance=0.5)
    got = {r.powerplant_id: (r.shape_id, r.country_id, r.output_capacity_mw, round(r.lon, 6), round(r.lat, 6)) for r in geometry_rows.collect()}
    assert got == {"p_duplicate_0": ("A", "X", 5.0, 4.5, 5.0), "p_duplicate_1": ("B", "Y", 5.0, 10.5, 5.0)}


def test_nearest_does_not_depend_on_the_band(spark):
    from capgrid.plans import queries as Q

    p, _ = Q.og_plants(spark, "/root/testdata/sf0.001")
    s, e = Q.shapes(spark, "/root/testdata/sf0.001")
    pts = p.select("powerplant_id", "lon", "lat", "country_id").withColumn("shape_class", F.lit("land"))

    def run(band):
        out = G.nearest_shape(pts, s, e, x="lon", y="lat", band=band)
        return sorted((r.powerplant_id, r.shape_id, r.part, round(r.distance, 9)) for r in out.collect())

    assert run(Q.B) == run(0.25) != []


def test_grids_against_published_points(spark):
    """EPSG guidance note 7-2 gives 3035 at (5 E, 50 N); UTM values are those of public converters, rounded to 0.1 m."""
    one = spark.range(1)
    at = lambda lon, lat, epsg: one.select(*[c.alias(n) for c, n in zip(G.project(F.lit(lon), F.lit(lat), epsg), "xy")]).first()
    assert tuple(at(5.0, 50.0, 3035)) == pytest.approx((3962799.45, 2999718.85), abs=0.01)
    assert tuple(at(10.0, 52.0, 3035)) == pytest.approx((4321000.0, 3210000.0), abs=1e-6)
    assert tuple(at(3.0, 0.0, 32631)) == pytest.approx((500000.0, 0.0), abs=1e-6)
    assert tuple(at(3.0, 0.0, 32731)) == pytest.approx((500000.0, 10000000.0), abs=1e-6)
    # on the central meridian the northing is the meridian arc times 0.9996 (quarter meridian 10,001,965.7293 m)
    assert at(3.0, 90.0, 32631)["y"] == pytest.approx(10001965.7293 * 0.9996, abs=1e-3)
    assert tuple(at(2.2945, 48.8582, 32631)) == pytest.approx((448251.8, 5411932.7), abs=1.0)
    for epsg in (32631, 32731, 25831, 3035):
        rows = spark.createDataFrame([(float(lon), float(lat)) for lon in range(-3, 10, 3) for lat in range(-78, 84, 9)], "lon double, lat double")
        x, y = G.project("lon", "lat", epsg)
        lon, lat = G.unproject("x", "y", epsg)
        back = rows.select("lon", "lat", x.alias("x"), y.alias("y")).select((lon - F.col("lon")).alias("a"), (lat - F.col("lat")).alias("b")).collect()
        assert max(max(abs(r["a"]), abs(r["b"])) for r in back) < 1e-9, epsg
    with pytest.raises(ValueError):
        G.project("lon", "lat", 32661)


def _placed_by_hand(ring_edges, px, py, rep, inner):
    """The point, moved by testing every edge of its part."""
    e = np.array([r[4:8] for r in ring_edges])
    a, d = e[:, :2], e[:, 2:] - e[:, :2]
    t = np.clip(((np.array([px, py]) - a) * d).sum(1) / (d * d).sum(1), 0, 1)
    feet = a + t[:, None] * d
    gaps = np.hypot(px - feet[:, 0], py - feet[:, 1])
    right = ((e[:, 1] > py) != (e[:, 3] > py)) & (px < e[:, 0] + (py - e[:, 1]) * d[:, 0] / np.where(d[:, 1] == 0, 1, d[:, 1]))
    within = right.sum() % 2 == 1
    c = np.array([px, py]) if within else feet[gaps.argmin()]
    for aim, reach in ((np.array(rep) - c if within else c - [px, py], np.inf), (np.array(rep) - c, np.hypot(*(np.array(rep) - c)))):
        u = aim / np.hypot(*aim)
        along, across = (e.reshape(-1, 2, 2) - c) @ u, (e.reshape(-1, 2, 2) - c) @ np.array([-u[1], u[0]])
        cut = (across[:, 0] > 0) != (across[:, 1] > 0)
        at = np.sort(along[cut, 0] - across[cut, 0] * (along[cut, 1] - along[cut, 0]) / (across[cut, 1] - across[cut, 0]))
        for lo, hi in zip(np.maximum(at[::2], 0), np.minimum(at[1::2], reach)):
            if hi - lo > 1e-12 * max(1, *abs(c)):
                return c + u * (lo + (inner if inner < hi - lo else (hi - lo) / 2))
    return np.array(rep)


def test_ray_walk_equals_all_edges(spark):
    """Jagged rings with a hole, points around and inside, cells far smaller than the shapes; few edges are met."""
    rng = np.random.default_rng(3)
    rows = {}
    for name, n, inner_ring in (("J", 400, True), ("K", 60, False)):
        at = np.linspace(0, 2 * np.pi, n, endpoint=False)
        r = 6 + rng.uniform(-2.5, 2.5, n)
        outer = np.c_[r * np.cos(at), r * np.sin(at)]
        rings = [outer] + ([0.2 * outer[::-8]] if inner_ring else [])
        rows[name] = [(name, 0, k, i, *map(float, a), *map(float, b)) for k, g in enumerate(rings) for i, (a, b) in enumerate(zip(g, np.roll(g, -1, axis=0)))]
    edges = spark.createDataFrame(rows["J"] + rows["K"], EDGE_DDL)
    points = [(f"p{i}", *map(float, rng.uniform(-12, 12, 2)), "JK"[i % 2]) for i in range(120)]
    frame = spark.createDataFrame(points, "powerplant_id string, lon double, lat double, shape_id string")
    reps = {r["shape_id"]: (r["rx"], r["ry"]) for r in G.representative_points(edges).collect()}
    for inner in (0.05, 1.5):
        got = {r["powerplant_id"]: (r["new_x"], r["new_y"]) for r in place_inside(frame, edges, inner, band=0.5).collect()}
        assert set(got) == {p[0] for p in points}
        for k, px, py, shape in points:
            assert np.allclose(got[k], _placed_by_hand(rows[shape], px, py, reps[shape], inner), atol=1e-9), k


def test_ray_meets_only_the_edges_of_its_cells(spark):
    at = np.linspace(0, 2 * np.pi, 4000, endpoint=False)
    ring = np.c_[10 * np.cos(at), 10 * np.sin(at)]
    edges = spark.createDataFrame([("R", 0, 0, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(ring, np.roll(ring, -1, axis=0)))], EDGE_DDL)
    ray = spark.createDataFrame([("p", 0, "R", 0, -10.0, 0.01, 1.0, 0.0, 21.0)], "id string, attempt int, shape_id string, part int, cx double, cy double, ux double, uy double, to double")
    assert 0 < edges_met(ray, listed_edges(edges, 0.1), 0.1, "id").count() < 40
