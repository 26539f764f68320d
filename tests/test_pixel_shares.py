import math
import random

import pytest

from capgrid.operators import pixel_shares as PS
from edge_tables import EDGE_DDL, square_edges

GRID = PS.Grid(left=0.0, top=8.0, width=1.0, height=1.0)
PIXEL_DDL = "prow int, pcol int, x double, y double, value double"


def grid_pixels(spark, n=8):
    return spark.createDataFrame([(r, c, c + 0.5, n - r - 0.5, 1.0 + r * n + c) for r in range(n) for c in range(n)], PIXEL_DDL)


def ring_edges(shape, points, part=0, ring=0):
    return [(shape, part, ring, i, *a, *b) for i, (a, b) in enumerate(zip(points, points[1:] + points[:1]))]


def clipped_area(points, left, low):
    """Area of a polygon inside a unit square: cut by one side after the other, then the shoelace sum."""
    for axis, bound, keep_less in ((0, left, False), (0, left + 1, True), (1, low, False), (1, low + 1, True)):
        out = []
        for a, b in zip(points, points[1:] + points[:1]):
            inside = [(p[axis] <= bound) if keep_less else (p[axis] >= bound) for p in (a, b)]
            if inside[0]:
                out.append(a)
            if inside[0] != inside[1]:
                t = (bound - a[axis]) / (b[axis] - a[axis])
                out.append(tuple(a[k] + t * (b[k] - a[k]) for k in (0, 1)))
        points = out
        if not points:
            return 0.0
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1]))) / 2


def test_shares_equal_clipped_areas(spark):
    rng = random.Random(4)
    shapes = {}
    for k in range(12):  # convex and star-shaped polygons, both directions, some beyond the grid's sides, some with corners on grid lines
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randrange(5, 12)))
        cx, cy = rng.uniform(0, 8), rng.uniform(0, 8)
        points = [(cx + rng.uniform(0.5, 4) * math.cos(a), cy + rng.uniform(0.5, 4) * math.sin(a)) for a in angles]
        if k % 3 == 0:
            points = [(float(round(x)), float(round(y))) for x, y in points]
        shapes[f"s{k}"] = points if k % 2 else points[::-1]
    edges = spark.createDataFrame([e for name, pts in shapes.items() for e in ring_edges(name, pts)], EDGE_DDL)
    got = {(r.shape_id, r.prow, r.pcol): r.share for r in PS.pixel_shares(grid_pixels(spark), edges, GRID).collect()}
    checked = 0
    for name, pts in shapes.items():
        if not _simple(pts):
            continue
        for r in range(8):
            for c in range(8):
                assert math.isclose(got.get((name, r, c), 0.0), clipped_area(pts, c, 7 - r), abs_tol=1e-12)
                checked += 1
    assert checked >= 64 * 4


def _simple(points):
    """No two edges that are not neighbours meet, and no corner repeats."""
    n = len(points)
    if len(set(points)) < n:
        return False
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    for i in range(n):
        for j in range(i + 1, n):
            if (j - i) % n in (1, n - 1):
                continue
            a, b, c, d = points[i], points[(i + 1) % n], points[j], points[(j + 1) % n]
            if turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0:
                return False
    return all(turn(points[i - 1], points[i], points[(i + 1) % n]) != 0 for i in range(n))


def test_a_tiling_adds_up_to_the_raster(spark):
    corners = {"a": (0, 0), "b": (8, 0), "c": (8, 8), "d": (0, 8)}
    middle = (3.37, 4.61)
    order = list(corners.values())
    edges = [e for k, name in enumerate(corners) for e in ring_edges(name, [tuple(map(float, order[k])), tuple(map(float, order[(k + 1) % 4])), middle])]
    shapes = spark.createDataFrame([(n, "N1" if n in "ab" else "N2") for n in corners], "shape_id string, country_id string")
    sums = PS.zonal_sum_by_share(grid_pixels(spark), shapes, spark.createDataFrame(edges, EDGE_DDL), GRID).collect()
    assert len(sums) == 4 and math.isclose(sum(r["sum"] for r in sums), sum(range(1, 65)), rel_tol=1e-13)
    totals = spark.createDataFrame([("N1", 100.0), ("N2", 7.0)], "country_id string, output_capacity_mw double")
    spread = PS.disaggregate_by_share(totals, grid_pixels(spark), shapes, spark.createDataFrame(edges, EDGE_DDL), GRID).collect()
    for country, total in (("N1", 100.0), ("N2", 7.0)):
        assert math.isclose(sum(r["value"] for r in spread if r["country_id"] == country), total, rel_tol=1e-13)
    assert len({(r["prow"], r["pcol"]) for r in spread}) == 64 < len(spread)


@pytest.mark.parametrize("turned", [False, True])
def test_holes_parts_and_whole_runs(spark, turned):
    hole = [(3.25, 3.25), (5.5, 3.25), (5.5, 5.5), (3.25, 5.5)]
    edges = square_edges("s", 1, 1, 7, 7) + ring_edges("s", hole[::-1] if turned else hole, ring=1) + square_edges("s", 4, 4, 4.5, 4.5, part=1)
    shares = {(r.prow, r.pcol): r.share for r in PS.pixel_shares(grid_pixels(spark), spark.createDataFrame(edges, EDGE_DDL), GRID).collect()}
    assert shares[(1, 1)] == 1.0 and (0, 0) not in shares and math.isclose(shares[(4, 3)], 0.4375)  # row 4 is y 3 to 4
    assert math.isclose(shares[(3, 4)], 0.25) and math.isclose(sum(shares.values()), 36 - 2.25**2 + 0.25)


def test_empty_tables_and_rows_outside_the_grid(spark):
    edges = spark.createDataFrame(square_edges("far", -50, 100, -40, 110) + square_edges("wide", -5, 2, 40, 3), EDGE_DDL)
    got = {(r.shape_id, r.prow, r.pcol, r.share) for r in PS.pixel_shares(grid_pixels(spark), edges, GRID).collect()}
    assert got == {("wide", 5, c, 1.0) for c in range(8)}
    assert PS.pixel_shares(grid_pixels(spark), edges.limit(0), GRID).count() == 0
    assert PS.pixel_shares(grid_pixels(spark).limit(0), edges, GRID).count() == 0
