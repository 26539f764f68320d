"""Spatial operators on an edge table.

Polygons are held as an *edge table* `(shape_id, part, ring, x1, y1, x2, y2)`:
one row per ring segment.  Membership (ray crossing + on-edge test) and
distance (point-segment) need only these rows, no ring assembly.

Point-in-polygon runs as an equi-join on (latitude band, x-cell).  A cell's
row of the index holds the shape's edges that touch the cell; of the edges
further right, which a ray towards +x crosses at any x, only the parity is
kept: a constant for the whole cell and the few y values at which it changes.
So an edge is copied to the cells it touches and to no others, and a cell
wholly inside a shape has no edges at all.  A point joins the rows of its own
cell, and crossing parity and on-edge test are evaluated with SQL
higher-order functions in the JVM, with the answer of the full ray test.  The
index is built once, written to the checkpoint folder and measured; it is
broadcast within the limit, else the join is a shuffle join on (band, cell),
which AQE splits when one cell is hot.

Nearest-shape search descends a pyramid of cells and measures only the edges
of cells that a point's distance bound leaves.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capgrid.session import cut_lineage, small

#: Largest band index (bytes, estimated) that is broadcast.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
_EDGE_BYTES = 48  # four doubles in a struct plus array overhead
_NO_CELL = -(2**63)  # the cell of points without coordinates, which no index lists


# ---------------------------------------------------------------------------
# Index building
# ---------------------------------------------------------------------------
def band_index(edges: DataFrame, band: float, pad: float = 0.0, xcell: float | None = None) -> DataFrame:
    """(shape_id, b, c, base, turns, edges, box): what a point of cell (b, c) needs to know of a shape.

    `edges` touch the cell (with their reach widened by `pad`).  An edge
    beyond the cell's right side is crossed by the ray of a point at height y
    when exactly one of its ends lies above y, so the parity of all of them is
    that of their ends above y.  Ends above the band count for every point of
    the cell (`base`); of ends inside the band, a vertex whose edges both lie
    beyond the cell cancels out, and the others are `turns`.  Rows without
    edges, turns and parity are left out: their cells lie outside the shape.
    `box` bounds the points of the band that can lie inside the shape or within
    `pad` of it: the reach of its edges in the band, open to the left where
    they do not close (a ray from there may cross an odd number of them).
    """
    w = F.lit(float(xcell if xcell is not None else default_xcell(band)))
    h, p = F.lit(float(band)), F.lit(float(pad))
    low, high = F.floor((F.least("y1", "y2") - p) / h), F.floor((F.greatest("y1", "y2") + p) / h)
    listed = edges.select(
        "shape_id", F.explode(F.sequence(low, high)).alias("b"), F.struct("x1", "y1", "x2", "y2").alias("e"),
        F.floor((F.least("x1", "x2") - p) / w).alias("first"), F.floor((F.greatest("x1", "x2") + p) / w).alias("last"),
    )
    ends_of = lambda c: (F.min(F.least(f"e.{c}1", f"e.{c}2")), F.max(F.greatest(f"e.{c}1", f"e.{c}2")))
    (x_lo, x_hi), (y_lo, y_hi) = ends_of("x"), ends_of("y")
    beside = lambda lo, hi: F.lit(float(pad) * (1 + 1e-9)) + F.lit(1e-12) * (F.abs(lo) + F.abs(hi))  # noqa: E731 (more than rounding can move a crossing)
    box = F.struct((x_lo - beside(x_lo, x_hi)).alias("x0"), (x_hi + beside(x_lo, x_hi)).alias("x1"), (y_lo - beside(y_lo, y_hi)).alias("y0"), (y_hi + beside(y_lo, y_hi)).alias("y1"))
    reach = listed.groupBy("shape_id", "b").agg(F.min("first").alias("f"), F.max("last").alias("l"), box.alias("box"))
    no_edge, no_turn = F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>"), F.lit(None).cast("double")
    no_box = F.lit(None).cast("struct<x0:double,x1:double,y0:double,y1:double>")
    cells = lambda c, e=no_edge, t=no_turn, above=0, odd=0, box=no_box: (c.alias("c"), e.alias("e"), t.alias("turn"), F.lit(above).alias("above"), F.lit(odd).alias("odd"), box.alias("box"))
    touching = listed.select("shape_id", "b", *cells(F.explode(F.sequence("first", "last")), F.col("e")))
    ends = listed.select("shape_id", "b", "first", F.explode(F.array("e.y1", "e.y2")).alias("y"))
    at = F.floor(F.col("y") / h)  # the rule that puts points into bands, so an end in a higher band lies above every point of this one
    over = ends.where(at > F.col("b")).select("shape_id", "b", *cells(F.col("first") - 1, above=1))
    # at one height, ends of edges that begin in the cells m1 <= m2 <= ... are odd in number from m1 to m2 - 1, from m3 to m4 - 1 ...
    begun = ends.where(at == F.col("b")).groupBy("shape_id", "b", "y").agg(
        F.array_sort(F.collect_list("first")).alias("m")
    ).join(reach, on=["shape_id", "b"])
    unpaired = begun.where(F.size("m") % 2 == 1).select("shape_id", "b", *cells(F.col("f"), odd=1))
    begun = begun.withColumn("m", F.when(F.size("m") % 2 == 1, F.concat(F.array("f"), F.col("m"))).otherwise(F.col("m")))  # an open ring: odd from the first cell on
    pairs = F.filter(F.transform(F.sequence(F.lit(1), F.size("m") - 1, F.lit(2)), lambda i: F.struct(F.get("m", i - 1).alias("a"), F.get("m", i).alias("z"))), lambda r: r["z"] > r["a"])
    spans = begun.select("shape_id", "b", "y", F.explode(pairs).alias("r"))
    turning = spans.select("shape_id", "b", *cells(F.explode(F.sequence(F.col("r.a"), F.col("r.z") - 1)), t=F.col("y")))
    between = reach.select("shape_id", "b", *cells(F.explode(F.sequence("f", "l")), box=F.col("box")))
    gathered = touching.unionByName(over).unionByName(turning).unionByName(unpaired).unionByName(between).groupBy("shape_id", "b", "c").agg(
        F.collect_list("e").alias("edges"), F.collect_list("turn").alias("turns"), F.sum("above").alias("above"), F.max("odd").alias("odd"), F.max("box").alias("box")
    )
    whole = Window.partitionBy("shape_id", "b")
    beyond = whole.orderBy(F.col("c").desc())
    based = gathered.withColumns({
        "base": (F.sum("above").over(beyond) % 2).cast("int"), "box": F.max("box").over(whole),
        "odd": (F.sum("above").over(whole) % 2 == 1) | (F.max("odd").over(whole) == 1),
    })
    based = based.withColumn("box", F.when(F.col("odd"), F.col("box").withField("x0", F.lit(float("-inf")))).otherwise(F.col("box")))
    return based.where((F.size("edges") > 0) | (F.size("turns") > 0) | (F.col("base") == 1)).select("shape_id", "b", "c", "base", "turns", "edges", "box")


def edge_cells(edges: DataFrame, band: float, tol: float, xcell: float | None = None) -> DataFrame:
    """Each edge once for every (band, x-cell) it runs through: per band only the cells below its part in that band."""
    h, w, p = F.lit(float(band)), F.lit(float(default_xcell(band) if xcell is None else xcell)), F.lit(float(tol))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    listed = edges.withColumn("b", F.explode(F.sequence(F.floor((low - p) / h), F.floor((high + p) / h))))

    def x_at(y: Column) -> Column:
        share = (F.least(F.greatest(y, low), high) - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
        return F.col("x1") + share * (F.col("x2") - F.col("x1"))

    one, two = F.coalesce(x_at(F.col("b") * h - p), F.col("x1")), F.coalesce(x_at((F.col("b") + 1) * h + p), F.col("x2"))
    return listed.withColumn("c", F.explode(F.sequence(F.floor((F.least(one, two) - p) / w), F.floor((F.greatest(one, two) + p) / w))))


def build_index(edges: DataFrame, band: float, pad: float = 0.0, xcell: float | None = None) -> tuple[DataFrame, int]:
    """The index written to the checkpoint folder, and its measured size; one build serves any number of joins."""
    index = cut_lineage(band_index(edges, band, pad, xcell))
    return index, measure_index(index)


def fitted_index(edges: DataFrame, band: float, pad: float = 0.0) -> tuple[DataFrame, int, float]:
    """An index whose x-cells fit the shapes, its size and the width of its cells.

    The edges are written once: the index reads them several times.
    """
    own = cut_lineage(edges.select("shape_id", "x1", "y1", "x2", "y2"))
    xcell = fitted_xcell(own, band)
    return (*build_index(own, band, pad, xcell), xcell)


def fitted_xcell(edges: DataFrame, band: float) -> float:
    """x-cell width for shapes that are narrow against the default width.

    Half the mean width of a shape, but no less than the mean reach of an edge
    (both weighted by the bands they lie in): so the cells of a shape are in
    the mean a few a band, and a point meets the shapes around it only.
    """
    h = F.lit(float(band))
    bands = lambda lo, hi: F.floor(hi / h) - F.floor(lo / h) + 1
    x0, x1, y0, y1 = F.least("x1", "x2"), F.greatest("x1", "x2"), F.least("y1", "y2"), F.greatest("y1", "y2")
    a = edges.groupBy("shape_id").agg(
        (F.max(x1) - F.min(x0)).alias("w"), bands(F.min(y0), F.max(y1)).alias("n"),
        F.sum((x1 - x0) * bands(y0, y1)).alias("ew"), F.sum(bands(y0, y1)).alias("en"),
    ).agg(F.try_divide(F.sum(F.col("w") * F.col("n")), F.sum("n")).alias("shape"), F.try_divide(F.sum("ew"), F.sum("en")).alias("edge")).first()
    width = max(a["shape"] or 0.0, 2 * (a["edge"] or 0.0)) / 2
    return min(width, default_xcell(band)) if math.isfinite(width) and width > 0 else default_xcell(band)


def measure_index(index: DataFrame) -> int:
    """Measured size of an index (one aggregate over it)."""
    total = index.agg(F.sum(F.size("edges") * _EDGE_BYTES + F.size("turns") * 8).alias("n"), F.count(F.lit(1)).alias("r")).first()
    return int(total["n"] or 0) + int(total["r"] or 0) * 144


def default_xcell(band: float) -> float:
    """x-cell width used with a band height (a few band heights wide)."""
    return 8.0 * band


def maybe_broadcast(small: DataFrame, size_bytes: int, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast a side only when its measured size is below `limit`."""
    return F.broadcast(small) if size_bytes <= limit else small


def default_band(edges: DataFrame, target_edges_per_band: int = 8) -> float:
    """A band height so that a typical shape has a few edges per band."""
    stats = (
        edges.groupBy("shape_id")
        .agg(
            (F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("h"),
            F.count("*").alias("n"),
        )
        .agg(F.expr("percentile_approx(h / greatest(n / 2.0, 1.0) * 2.0, 0.5)").alias("band"))
        .first()["band"]
    )
    return float(stats) if stats and stats > 0 else 1.0


# ---------------------------------------------------------------------------
# Geometry expressions on an `edges` array column
# ---------------------------------------------------------------------------
# The point travels in the accumulator of `aggregate`, so no lambda refers to a
# column outside it: the expressions stay well-formed wherever the optimizer
# moves them (join conditions, pushed-down filters).
def _acc(px: Column, py: Column, **fields) -> Column:
    return F.struct(px.cast("double").alias("px"), py.cast("double").alias("py"), *[v.alias(k) for k, v in fields.items()])


#: Lists of up to this many edges are met edge by edge in compiled code; `aggregate` is interpreted, at many times the cost an edge.
_FEW = 4


def _by_length(edges: Column, few: Column, many: Column) -> Column:
    return F.when(F.size(edges) <= _FEW, few).otherwise(many)


def _crosses(e: Column, x: Column, y: Column) -> Column:
    return ((e["y1"] > y) != (e["y2"] > y)) & (x < e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))


def crossing_count(edges: Column, px: Column, py: Column) -> Column:
    """Number of edges crossed by the ray from (px, py) towards +x (half-open rule)."""

    def step(acc, e):
        x, y = acc["px"], acc["py"]
        return F.struct(x.alias("px"), y.alias("py"), (acc["n"] + F.when(_crosses(e, x, y), 1).otherwise(0)).alias("n"))

    few = sum((F.when(_crosses(F.get(edges, F.lit(i)), px, py), 1).otherwise(0) for i in range(_FEW)), F.lit(0))
    return _by_length(edges, few, F.aggregate(edges, _acc(px, py, n=F.lit(0)), step)["n"])


def turn_count(turns: Column, py: Column) -> Column:
    """Number of the given heights above the point."""
    above = F.aggregate(turns, F.struct(py.cast("double").alias("py"), F.lit(0).alias("n")), lambda a, t: F.struct(a["py"].alias("py"), (a["n"] + F.when(t > a["py"], 1).otherwise(0)).alias("n")))
    return above["n"]


def on_boundary(edges: Column, px: Column, py: Column) -> Column:
    """True when (px, py) lies on one of the edges."""

    def touches(e, x, y):
        return (
            (((e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])) == 0)
            & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    def step(acc, e):
        x, y = acc["px"], acc["py"]
        return F.struct(x.alias("px"), y.alias("py"), (acc["on"] | touches(e, x, y)).alias("on"))

    few = F.lit(False)
    for i in range(_FEW):
        few = few | F.when(F.size(edges) > i, touches(F.get(edges, F.lit(i)), px, py)).otherwise(F.lit(False))
    return _by_length(edges, few, F.aggregate(edges, _acc(px, py, on=F.lit(False)), step)["on"])


def segment_distance(e: Column, px: Column, py: Column) -> Column:
    """Euclidean distance from (px, py) to the segment `e`."""
    dx = e["x2"] - e["x1"]
    dy = e["y2"] - e["y1"]
    len2 = dx * dx + dy * dy
    t = F.when(len2 > 0, ((px - e["x1"]) * dx + (py - e["y1"]) * dy) / len2).otherwise(F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.hypot(px - (e["x1"] + t * dx), py - (e["y1"] + t * dy))


def min_edge_distance(edges: Column, px: Column, py: Column) -> Column:
    def step(acc, e):
        x, y = acc["px"], acc["py"]
        return F.struct(x.alias("px"), y.alias("py"), F.least(acc["d"], segment_distance(e, x, y)).alias("d"))

    few = F.least(F.lit(float("inf")), *[segment_distance(F.get(edges, F.lit(i)), px, py) for i in range(_FEW)])
    return _by_length(edges, few, F.aggregate(edges, _acc(px, py, d=F.lit(float("inf"))), step)["d"])


# ---------------------------------------------------------------------------
# Point in polygon
# ---------------------------------------------------------------------------
def points_in_shapes(
    points: DataFrame,
    edges: DataFrame | None,
    band: float,
    x: str = "x",
    y: str = "y",
    boundary: str = "include",
    index: DataFrame | None = None,
    index_size: int | None = None,
) -> DataFrame:
    """Inner spatial join: one row per (point, shape) with the point inside the shape.

    `boundary="include"` is `intersects` (points on an edge match);
    `boundary="exclude"` is `within` (they do not).  Output: all point
    columns plus `shape_id`.  A prebuilt `index` comes from `build_index(edges, band)`; `edges` are not read then.
    """
    if boundary not in ("include", "exclude"):
        raise ValueError(f"boundary is 'include' or 'exclude', not {boundary!r}")
    xcell = default_xcell(band)
    if index is None:
        index, index_size, xcell = fitted_index(edges, band)
    if index_size is None:
        index_size = measure_index(index)
    return _probe(points, index, index_size, band, xcell, x, y, boundary)


def _probe(points: DataFrame, index: DataFrame, size: int, band: float, xcell: float, x: str, y: str, boundary: str, distance: float | None = None, pairs: bool = True) -> DataFrame:
    px, py = F.col(x), F.col(y)
    # keys without nulls, and a box test that does not ask for a value: else Spark tests x and y for
    # null below the projection that computes them, which writes a map projection out dozens of times
    cell = lambda v, size: F.coalesce(F.floor(v / F.lit(size)), F.lit(_NO_CELL))
    keyed = points.withColumn("_b", cell(py, band)).withColumn("_c", cell(px, xcell))
    side = maybe_broadcast(index.withColumnsRenamed({"b": "_ib", "c": "_ic"}), size)
    same_cell = (F.col("_b") == F.col("_ib")) & (F.col("_c") == F.col("_ic"))
    # compared before any edge is: most shapes of a cell lie beside the point
    near = F.coalesce(px.between(F.col("box.x0"), F.col("box.x1")) & py.between(F.col("box.y0"), F.col("box.y1")), F.lit(True))
    turned = F.when(F.size("turns") > 0, turn_count(F.col("turns"), py)).otherwise(0)
    inside = ((F.col("base") + turned + crossing_count(F.col("edges"), px, py)) % 2) == 1
    if distance is not None:
        keep = inside | (min_edge_distance(F.col("edges"), px, py) <= F.lit(float(distance)))
    else:
        edge = on_boundary(F.col("edges"), px, py)
        keep = (inside | edge) if boundary == "include" else (inside & ~edge)
    met = same_cell & near & keep
    if not pairs:
        return keyed.join(side, on=met, how="left_semi").drop("_b", "_c")
    return keyed.join(side, on=met).drop("_b", "_c", "_ib", "_ic", "base", "turns", "edges", "box")


def points_within_distance(
    points: DataFrame, edges: DataFrame, distance: float, band: float, x: str = "x", y: str = "y", pairs: bool = True
) -> DataFrame:
    """(point, shape) pairs with the point inside the shape or within `distance` of it.

    Edges are indexed with their reach widened by `distance`, so every edge
    closer than `distance` is in the row of the point's cell.  With `pairs`
    false each such point comes once, without `shape_id`: a caller that asks
    only which points are near meets the first shape and no more.
    """
    index, size, xcell = fitted_index(edges, band, pad=distance)
    return _probe(points, index, size, band, xcell, x, y, "include", distance=distance, pairs=pairs)


# ---------------------------------------------------------------------------
# Overlaps and split capacity
# ---------------------------------------------------------------------------
def match_counts(assigned: DataFrame, id_col: str = "powerplant_id") -> DataFrame:
    """Adds `_matches`: number of shapes each point matched."""
    return assigned.withColumn("_matches", F.count(F.lit(1)).over(Window.partitionBy(id_col)))


def detect_overlaps(assigned: DataFrame, id_col: str = "powerplant_id") -> DataFrame:
    """Rows of points matched by more than one shape."""
    return match_counts(assigned, id_col).where(F.col("_matches") > 1).drop("_matches")


def split_capacity(
    assigned: DataFrame, id_col: str = "powerplant_id", cap_col: str = "output_capacity_mw"
) -> DataFrame:
    """Capacity / matches and `<id>_duplicate_<n>` (n from 0, by shape_id) on multi-matches.

    Adds boolean `split`.
    """
    w = Window.partitionBy(id_col)
    ordered = w.orderBy("shape_id")
    n = F.count(F.lit(1)).over(w)
    k = F.row_number().over(ordered) - 1
    return (
        assigned.withColumn("_n", n)
        .withColumn("_k", k)
        .withColumn("split", F.col("_n") > 1)
        .withColumn(cap_col, F.when(F.col("split"), F.col(cap_col) / F.col("_n")).otherwise(F.col(cap_col)))
        .withColumn(
            id_col,
            F.when(F.col("split"), F.concat(F.col(id_col), F.lit("_duplicate_"), F.col("_k").cast("string"))).otherwise(
                F.col(id_col)
            ),
        )
        .drop("_n", "_k")
    )


# ---------------------------------------------------------------------------
# Assign country
# ---------------------------------------------------------------------------
def assign_country(
    plants: DataFrame,
    shapes: DataFrame,
    edges: DataFrame,
    band: float,
    on_overlap: str = "raise",
    x: str = "lon",
    y: str = "lat",
    id_col: str = "powerplant_id",
    exclusive: DataFrame | None = None,
    inner_distance: float = 100.0,
) -> DataFrame:
    """Country from the shape each plant intersects; out-of-scope plants drop out.

    `on_overlap="raise"` fails the job (lazily, inside the plan) when a plant
    matches more than one shape; `"split_capacity"` divides its capacity over
    the matches, renames the copies (`split` column marks them) and moves each
    copy just inside its shape (E9): inside the `exclusive` edge table (E7)
    when one is given, else inside the raw shapes.
    Output: plant columns (its `country_id` replaced) + `shape_id` + `split`.
    """
    base = plants.drop("country_id") if "country_id" in plants.columns else plants
    matched = points_in_shapes(base, edges, band, x=x, y=y, boundary="include")
    matched = matched.join(shapes.select("shape_id", "country_id"), on="shape_id")
    if on_overlap == "raise":
        # the gate sits on `country_id`, a column every consumer keeps
        counted = match_counts(matched, id_col)
        gated = F.when(
            F.col("_matches") > 1,
            F.raise_error(F.concat(F.lit("Plant lies in shapes of more than one match: "), F.col(id_col))),
        ).otherwise(F.col("country_id"))
        return counted.withColumn("country_id", gated).withColumn("split", F.lit(False)).drop("_matches")
    if on_overlap == "split_capacity":
        # written once: the rows that stay read it, and placing reads the rows to move several times
        out = cut_lineage(split_capacity(matched, id_col))
        from capgrid.operators.place import place_inside

        moved = place_inside(out.where("split"), edges if exclusive is None else exclusive, inner_distance, x=x, y=y, id_col=id_col, band=band)
        split_rows = out.where("split").join(moved, on=id_col).withColumn(x, F.col("new_x")).withColumn(y, F.col("new_y"))
        return out.where(~F.col("split")).unionByName(split_rows.drop("new_x", "new_y"))
    raise ValueError(f"on_overlap is 'raise' or 'split_capacity', not {on_overlap!r}")


# ---------------------------------------------------------------------------
# Nearest shape and nearest part
# ---------------------------------------------------------------------------
def distance_to_shape(geom: Column, px: Column, py: Column) -> Column:
    """0 inside, else the distance to the nearest edge."""
    inside = (crossing_count(geom, px, py) % 2) == 1
    return F.when(inside, F.lit(0.0)).otherwise(min_edge_distance(geom, px, py))


_FANOUT = 4  # a cell of the pyramid has at most 4 x 4 cells of the next finer level


def _box_gap(px: Column, py: Column, size: float) -> Column:
    """Distance of a point from the cell (row, col) of the given size."""
    s = F.lit(float(size))
    dx = F.greatest(F.col("col") * s - px, px - (F.col("col") + 1) * s, F.lit(0.0))
    dy = F.greatest(F.col("row") * s - py, py - (F.col("row") + 1) * s, F.lit(0.0))
    return F.hypot(dx, dy)


def nearest_edges(points: DataFrame, edges: DataFrame, by: Sequence[str], x: str, y: str, id_col: str, band: float) -> DataFrame:
    """(id, best): for each point the nearest edge that shares its `by` keys, as struct (distance, shape_id, part, fx, fy).

    Best-first descent through a pyramid of cells.  A cell knows one vertex of
    an edge that runs through it, so the distance to that vertex bounds a
    point's answer from above, and the distance to the cell's square bounds
    from below what the cell can offer.  Level by level a point's cells are
    replaced by their children (one equi-join on the keys and the parent cell),
    the bound shrinks, and cells beyond it go; only the edges of the remaining
    finest cells are measured.  Ties go to the smallest (shape_id, part).
    """
    keys = list(by)
    own = edges.select(*dict.fromkeys([*keys, "shape_id", "part"]), "x1", "y1", "x2", "y2")
    leaves = cut_lineage(edge_cells(own, band, 0.0, xcell=band).withColumnsRenamed({"b": "row", "c": "col"}))
    reach = leaves.agg(*[f(c).alias(f"{n}_{c}") for c in ("row", "col") for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if reach["lo_row"] is None:
        return points.select(id_col).limit(0).withColumn("best", F.lit(None).cast("struct<distance:double,shape_id:string,part:int,fx:double,fy:double>"))
    top = 0
    while any(reach[f"hi_{c}"] // _FANOUT**top - reach[f"lo_{c}"] // _FANOUT**top > 1 for c in ("row", "col")):
        top += 1

    def cells(level: int) -> DataFrame:
        f = _FANOUT**level
        at = [F.floor(F.col(c) / f).alias(c) for c in ("row", "col")]
        return leaves.groupBy(*keys, *at).agg(F.min(F.struct("x1", "y1")).alias("seen"))

    px, py = F.col(x), F.col(y)
    f = _FANOUT**top
    roots = F.explode(F.array(*[F.struct(F.lit(r).cast("long").alias("row"), F.lit(c).cast("long").alias("col")) for r in range(reach["lo_row"] // f, reach["hi_row"] // f + 1) for c in range(reach["lo_col"] // f, reach["hi_col"] // f + 1)]))
    state = points.select(id_col, x, y, *keys, F.lit(float("inf")).alias("_D"), roots.alias("_r")).select(id_col, x, y, *keys, "_D", F.col("_r.row").alias("_prow"), F.col("_r.col").alias("_pcol"))
    for level in range(top, -1, -1):
        size = float(band) * _FANOUT**level
        up = F.floor(F.col("row") / _FANOUT), F.floor(F.col("col") / _FANOUT)
        parent = (F.col("row"), F.col("col")) if level == top else up
        met = state.join(cells(level).withColumns({"_prow": parent[0], "_pcol": parent[1]}), on=[*keys, "_prow", "_pcol"])
        seen = met.withColumn("_D", F.least(F.col("_D"), F.min(F.hypot(px - F.col("seen.x1"), py - F.col("seen.y1"))).over(Window.partitionBy(id_col))))
        # the slack keeps cells that rounding alone would put beyond the bound
        state = seen.where(_box_gap(px, py, size) <= F.col("_D") * (1 + 1e-12) + 1e-300).select(id_col, x, y, *keys, "_D", F.col("row").alias("_prow"), F.col("col").alias("_pcol"))
    met = state.join(leaves.withColumnsRenamed({"row": "_prow", "col": "_pcol"}), on=[*keys, "_prow", "_pcol"])
    foot = edge_foot(px, py)
    gap = segment_distance(F.struct("x1", "y1", "x2", "y2"), px, py)
    return met.groupBy(id_col).agg(F.min(F.struct(gap.alias("distance"), "shape_id", "part", foot[0].alias("fx"), foot[1].alias("fy"))).alias("best"))


def part_index(edges: DataFrame, band: float) -> tuple[DataFrame, int]:
    """An index (see `build_index`) whose `shape_id` is the struct (shape_id, part)."""
    return build_index(edges.select(F.struct("shape_id", "part").alias("shape_id"), "x1", "y1", "x2", "y2"), band)


def nearest_shape(
    points: DataFrame,
    shapes: DataFrame,
    edges: DataFrame,
    by: Sequence[str] = ("country_id", "shape_class"),
    x: str = "x",
    y: str = "y",
    id_col: str = "powerplant_id",
    band: float | None = None,
    index: tuple[DataFrame, int] | None = None,
    contact: bool = False,
) -> DataFrame:
    """For each point, the nearest shape sharing the `by` keys (ties -> smallest
    shape_id) and the nearest part of it (ties -> smallest part).

    Adds `shape_id`, `distance` and `part`, with `contact` also the part's nearest
    point `contact_x`, `contact_y` (null inside); points with no eligible shape drop out.  Points inside an eligible part (found with the cell index of E3, which
    `index` may hand in from `part_index`) are at distance 0; all others descend the
    cell pyramid of `nearest_edges`.  No stage joins on the `by` keys alone, so
    a country with a hundred thousand shapes costs its points no more than their surroundings.
    """
    if band is None:
        band = default_band(edges)
    attrs = shapes.select("shape_id", *by)
    pts = cut_lineage(points)
    own = pts.select(id_col, x, y, *[F.col(k).alias(f"_{k}") for k in by])
    ready = part_index(edges, band) if index is None else index
    held = points_in_shapes(own, edges, band, x=x, y=y, index=ready[0], index_size=ready[1])
    held = held.withColumn("_of", F.col("shape_id")).drop("shape_id").withColumn("shape_id", F.col("_of.shape_id")).join(attrs, on="shape_id")
    for k in by:
        held = held.where(F.col(f"_{k}") == F.col(k))
    inside = cut_lineage(held.groupBy(id_col).agg(F.min(F.struct(F.lit(0.0).alias("distance"), F.col("shape_id"), F.col("_of.part").alias("part"), *[F.lit(None).cast("double").alias(c) for c in ("fx", "fy")])).alias("_best")))
    outside = pts.select(id_col, x, y, *by).join(inside.select(id_col), on=id_col, how="left_anti")
    near = nearest_edges(outside, edges.join(attrs, on="shape_id"), by, x, y, id_col, band)
    best = inside.unionByName(near.select(id_col, F.struct("best.distance", "best.shape_id", "best.part", "best.fx", "best.fy").alias("_best")))
    return pts.join(best, on=id_col).select(
        *[F.col(c) for c in points.columns],
        F.col("_best.shape_id").alias("shape_id"),
        F.col("_best.distance").alias("distance"),
        F.col("_best.part").alias("part"),
        *([F.col("_best.fx").alias("contact_x"), F.col("_best.fy").alias("contact_y")] if contact else []),
    )


def edge_foot(px: Column, py: Column) -> tuple[Column, Column]:
    """The point of the row's edge (x1, y1, x2, y2) that is nearest to (px, py)."""
    x1, y1, dx, dy = F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    share = F.coalesce(((px - x1) * dx + (py - y1) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    return x1 + t * dx, y1 + t * dy


# ---------------------------------------------------------------------------
# Required target shape class
# ---------------------------------------------------------------------------
def require_target_shape(
    candidates: DataFrame, shapes: DataFrame, on_error: str = "drop", class_col: str = "target_shape_class"
) -> tuple[DataFrame, DataFrame]:
    """Split candidates into (valid, missing) by (country, class) availability.

    `raise` fails the job (lazily, on `country_id`) when a combination is
    missing; `drop` leaves the missing ones out of `valid`; `ignore` keeps
    them out of `valid` too but the caller leaves them in place unmoved.
    """
    if on_error not in ("raise", "drop", "ignore"):
        raise ValueError(f"on_error is 'raise', 'drop' or 'ignore', not {on_error!r}")
    available = shapes.select("country_id", F.col("shape_class").alias(class_col)).distinct().withColumn("_ok", F.lit(True))
    keys = ["country_id", class_col]
    flagged = candidates.join(small(available), on=keys, how="left")
    missing = flagged.where(F.col("_ok").isNull()).drop("_ok")
    if on_error == "raise":
        gated = F.when(
            F.col("_ok").isNull(),
            F.raise_error(
                F.concat(
                    F.lit("The country has no shape of the wanted class: "), F.concat_ws(" / ", "technology", "country_id", class_col),
                )
            ),
        ).otherwise(F.col("country_id"))
        return flagged.withColumn("country_id", gated).drop("_ok"), missing
    return flagged.where(F.col("_ok")).drop("_ok"), missing


def missing_shape_summary(missing: DataFrame, class_col: str = "target_shape_class") -> DataFrame:
    """Grouped message table for the missing (technology, country, class) combinations."""
    return missing.groupBy("technology", "country_id", class_col).agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------------------
# Representative point (scan line through the middle, widest inside span)
# ---------------------------------------------------------------------------
def representative_points(edges: DataFrame) -> DataFrame:
    """(shape_id, rx, ry): a point inside each polygon.

    The scan line sits half-way between the two vertex heights closest to
    the middle of the shape's y-range (so it touches no vertex); the point is
    the centre of the widest inside span on that line.
    """
    ext = edges.groupBy("shape_id").agg(((F.min(F.least("y1", "y2")) + F.max(F.greatest("y1", "y2"))) / 2).alias("cy"))
    v = edges.select("shape_id", F.col("y1").alias("vy")).join(ext, on="shape_id")
    scan = v.groupBy("shape_id", "cy").agg(
        F.max(F.when(F.col("vy") <= F.col("cy"), F.col("vy"))).alias("lo"),
        F.min(F.when(F.col("vy") > F.col("cy"), F.col("vy"))).alias("hi"),
    ).select(
        "shape_id",
        F.when(F.col("hi").isNull(), F.col("lo")).when(F.col("lo").isNull(), F.col("hi"))
        .otherwise((F.col("lo") + F.col("hi")) / 2).alias("sy"),
    )
    e = edges.join(scan, on="shape_id")
    crossing = e.where((F.col("y1") > F.col("sy")) != (F.col("y2") > F.col("sy"))).select(
        "shape_id",
        "sy",
        (F.col("x1") + (F.col("sy") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("cx"),
    )
    xs = crossing.groupBy("shape_id", "sy").agg(F.array_sort(F.collect_list("cx")).alias("xs"))
    spans = F.transform(
        F.sequence(F.lit(0), (F.size("xs") / 2).cast("int") - 1),
        lambda i: F.struct(
            (F.element_at("xs", 2 * i + 2) - F.element_at("xs", 2 * i + 1)).alias("w"),
            ((F.element_at("xs", 2 * i + 1) + F.element_at("xs", 2 * i + 2)) / 2).alias("mx"),
        ),
    )
    widest = F.aggregate(
        spans,
        F.struct(F.lit(-1.0).alias("w"), F.lit(None).cast("double").alias("mx")),
        lambda acc, s: F.when(s["w"] > acc["w"], s).otherwise(acc),
    )
    return xs.select("shape_id", widest["mx"].alias("rx"), F.col("sy").alias("ry"))


# ---------------------------------------------------------------------------
# Projections as column expressions
# ---------------------------------------------------------------------------
_A1, _A2, _A3, _A4 = 1.340264, -0.081106, 0.000893, 0.003796
_WGS84_A = 6378137.0
_WGS84_F = 1 / 298.257223563


def _authalic_constants(flattening: float = _WGS84_F):
    e2 = flattening * (2 - flattening)
    e = math.sqrt(e2)

    def q(phi):
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    qp = q(math.pi / 2)
    rq = _WGS84_A * math.sqrt(qp / 2)
    return e, e2, qp, rq


def _authalic_latitude(lat_rad: Column, flattening: float = _WGS84_F) -> Column:
    e, e2, qp, _ = _authalic_constants(flattening)
    s = F.sin(lat_rad)
    q = F.lit(1 - e2) * (s / (F.lit(1.0) - F.lit(e2) * s * s) - F.lit(1 / (2 * e)) * F.log((F.lit(1.0) - F.lit(e) * s) / (F.lit(1.0) + F.lit(e) * s)))
    return F.asin(F.least(F.greatest(q / F.lit(qp), F.lit(-1.0)), F.lit(1.0)))


def _latitude_of_authalic(sin_beta: Column, flattening: float = _WGS84_F) -> Column:
    """Geographic latitude (radians) whose authalic latitude has the given sine, by Newton steps in one expression."""
    e, e2, qp, _ = _authalic_constants(flattening)

    def refine(phi, _):
        sp = F.sin(phi)
        flat = F.lit(1.0) - F.lit(e2) * sp * sp
        q = sp / flat - F.log((F.lit(1.0) - F.lit(e) * sp) / (F.lit(1.0) + F.lit(e) * sp)) / F.lit(2 * e)
        gap = F.lit(qp / (1 - e2)) * sin_beta - q
        return phi + F.coalesce(gap * flat * flat / F.nullif(F.lit(2.0) * F.cos(phi), F.lit(0.0)), F.lit(0.0))

    return F.aggregate(F.sequence(F.lit(1), F.lit(5)), F.asin(F.least(F.greatest(sin_beta, F.lit(-1.0)), F.lit(1.0))), refine)


# UTM: transverse Mercator by the Krueger series in the third flattening, to its fourth power (fractions of a micrometre within a zone)
_GRS80_F = 1 / 298.257222101
_UTM_SCALE, _UTM_EAST, _UTM_NORTH = 0.9996, 500_000.0, 10_000_000.0


def utm_zone(epsg: int) -> tuple[float, float, float] | None:
    """(central meridian, false northing, flattening) of a UTM code: 326zz and 327zz on WGS 84, 258zz (zones 28-38) on GRS 80."""
    family, zone = divmod(epsg, 100)
    if family in (326, 327) and 1 <= zone <= 60:
        return zone * 6.0 - 183, _UTM_NORTH if family == 327 else 0.0, _WGS84_F
    if family == 258 and 28 <= zone <= 38:
        return zone * 6.0 - 183, 0.0, _GRS80_F
    return None


def krueger_series(flattening: float) -> tuple[float, list[float], list[float]]:
    """Rectifying radius, and the coefficients of the forward and the inverse series."""
    n = flattening / (2 - flattening)
    radius = _WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    inverse = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    return radius, forward, inverse


def _utm(lon: Column, lat: Column, meridian: float, false_north: float, flattening: float) -> tuple[Column, Column]:
    radius, series, _ = krueger_series(flattening)
    e = math.sqrt(flattening * (2 - flattening))
    s, around = F.sin(F.radians(lat)), F.radians(lon - F.lit(meridian))
    t = F.sinh(F.atanh(s) - F.lit(e) * F.atanh(F.lit(e) * s))
    xi, eta = F.atan2(t, F.cos(around)), F.asinh(F.sin(around) / F.sqrt(t * t + F.cos(around) * F.cos(around)))
    north, east = xi, eta
    for j, a in enumerate(series, 1):
        north = north + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return F.lit(_UTM_EAST) + F.lit(_UTM_SCALE * radius) * east, F.lit(false_north) + F.lit(_UTM_SCALE * radius) * north


def _utm_inverse(x: Column, y: Column, meridian: float, false_north: float, flattening: float) -> tuple[Column, Column]:
    radius, _, series = krueger_series(flattening)
    e = math.sqrt(flattening * (2 - flattening))
    xi, eta = (y - F.lit(false_north)) / F.lit(_UTM_SCALE * radius), (x - F.lit(_UTM_EAST)) / F.lit(_UTM_SCALE * radius)
    north, east = xi, eta
    for j, b in enumerate(series, 1):
        north = north - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    conformal = F.asinh(F.sin(north) / F.sqrt(F.sinh(east) * F.sinh(east) + F.cos(north) * F.cos(north)))
    # the geographic latitude is a fixed point; each step gains more than two digits
    step = lambda phi, _: F.atan(F.sinh(conformal + F.lit(e) * F.atanh(F.lit(e) * F.sin(phi))))
    phi = F.aggregate(F.sequence(F.lit(1), F.lit(8)), F.atan(F.sinh(conformal)), step)
    return F.lit(meridian) + F.degrees(F.atan2(F.sinh(east), F.cos(north))), F.degrees(phi)


#: Lambert azimuthal equal-area codes: (latitude and longitude of the centre, false easting and northing, flattening).
_LAEA = {3035: (52.0, 10.0, 4_321_000.0, 3_210_000.0, _GRS80_F)}


def laea_constants(epsg: int) -> tuple[float, float, float, float]:
    """(radius of the authalic sphere, sine and cosine of the centre's authalic latitude, stretch D)."""
    lat0, _, _, _, flattening = _LAEA[epsg]
    e, e2, qp, rq = _authalic_constants(flattening)
    s = math.sin(math.radians(lat0))
    q = (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    beta = math.asin(q / qp)
    return rq, math.sin(beta), math.cos(beta), _WGS84_A * math.cos(math.radians(lat0)) / (math.sqrt(1 - e2 * s * s) * rq * math.cos(beta))


def _laea(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    _, lon0, east, north, flattening = _LAEA[epsg]
    rq, s0, c0, stretch = laea_constants(epsg)
    beta, around = _authalic_latitude(F.radians(lat), flattening), F.radians(lon - F.lit(lon0))
    b = F.lit(rq) * F.sqrt(F.lit(2.0) / (F.lit(1.0) + F.lit(s0) * F.sin(beta) + F.lit(c0) * F.cos(beta) * F.cos(around)))
    return F.lit(east) + b * F.lit(stretch) * F.cos(beta) * F.sin(around), F.lit(north) + b / F.lit(stretch) * (F.lit(c0) * F.sin(beta) - F.lit(s0) * F.cos(beta) * F.cos(around))


def _laea_inverse(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    lat0, lon0, east, north, flattening = _LAEA[epsg]
    rq, s0, c0, stretch = laea_constants(epsg)
    dx, dy = (x - F.lit(east)) / F.lit(stretch), (y - F.lit(north)) * F.lit(stretch)
    rho = F.hypot(dx, dy)
    c = F.lit(2.0) * F.asin(F.least(rho / F.lit(2 * rq), F.lit(1.0)))
    sine = F.cos(c) * F.lit(s0) + F.coalesce(dy * F.sin(c) / F.nullif(rho, F.lit(0.0)), F.lit(0.0)) * F.lit(c0)
    lon = F.lit(lon0) + F.degrees(F.atan2(dx * F.sin(c), rho * F.lit(c0) * F.cos(c) - dy * F.lit(s0) * F.sin(c)))
    return F.when(rho == 0, F.lit(lon0)).otherwise(lon), F.degrees(_latitude_of_authalic(sine, flattening))


def project(lon: Column | str, lat: Column | str, epsg: int) -> tuple[Column, Column]:
    """Forward projection of geographic degrees to metres: EPSG:3857, 8857, UTM (326zz, 327zz, 258zz) or 3035."""
    lon_c = F.col(lon) if isinstance(lon, str) else lon
    lat_c = F.col(lat) if isinstance(lat, str) else lat
    if epsg == 4326:
        return lon_c, lat_c
    if epsg == 3857:
        x = F.lit(_WGS84_A) * F.radians(lon_c)
        y = F.lit(_WGS84_A) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat_c) / 2))
        return x, y
    if epsg == 8857:
        _, _, _, rq = _authalic_constants()
        beta = _authalic_latitude(F.radians(lat_c))
        theta = F.asin(F.lit(math.sqrt(3) / 2) * F.sin(beta))
        t2 = theta * theta
        t6 = t2 * t2 * t2
        denom = F.lit(_A1) + F.lit(3 * _A2) * t2 + t6 * (F.lit(7 * _A3) + F.lit(9 * _A4) * t2)
        x = F.lit(rq * 2 * math.sqrt(3) / 3) * F.radians(lon_c) * F.cos(theta) / denom
        y = F.lit(rq) * theta * (F.lit(_A1) + F.lit(_A2) * t2 + t6 * (F.lit(_A3) + F.lit(_A4) * t2))
        return x, y
    if epsg in _LAEA:
        return _laea(lon_c, lat_c, epsg)
    if zone := utm_zone(epsg):
        return _utm(lon_c, lat_c, *zone)
    raise ValueError(f"Unsupported CRS EPSG:{epsg}.")


def unproject(x: Column | str, y: Column | str, epsg: int, newton_steps: int = 6) -> tuple[Column, Column]:
    """Inverse of `project` (Equal Earth by Newton steps on theta)."""
    x_c = F.col(x) if isinstance(x, str) else x
    y_c = F.col(y) if isinstance(y, str) else y
    if epsg == 4326:
        return x_c, y_c
    if epsg == 3857:
        lon = F.degrees(x_c / F.lit(_WGS84_A))
        lat = F.degrees(F.lit(2.0) * F.atan(F.exp(y_c / F.lit(_WGS84_A))) - F.lit(math.pi / 2))
        return lon, lat
    if epsg == 8857:
        e, e2, qp, rq = _authalic_constants()
        yr = y_c / F.lit(rq)

        def newton(theta, _):
            t2 = theta * theta
            t6 = t2 * t2 * t2
            fy = theta * (F.lit(_A1) + F.lit(_A2) * t2 + t6 * (F.lit(_A3) + F.lit(_A4) * t2)) - yr
            fpy = F.lit(_A1) + F.lit(3 * _A2) * t2 + t6 * (F.lit(7 * _A3) + F.lit(9 * _A4) * t2)
            return theta - fy / fpy

        # iterate inside one expression (an unrolled loop would grow the tree exponentially)
        theta = F.aggregate(F.sequence(F.lit(1), F.lit(newton_steps)), yr, newton)
        t2 = theta * theta
        t6 = t2 * t2 * t2
        denom = F.lit(_A1) + F.lit(3 * _A2) * t2 + t6 * (F.lit(7 * _A3) + F.lit(9 * _A4) * t2)
        lon = F.degrees(F.lit(3 / (2 * math.sqrt(3))) * x_c * denom / (F.lit(rq) * F.cos(theta)))
        sin_beta = F.lit(2 / math.sqrt(3)) * F.sin(theta)
        return lon, F.degrees(_latitude_of_authalic(sin_beta))
    if epsg in _LAEA:
        return _laea_inverse(x_c, y_c, epsg)
    if zone := utm_zone(epsg):
        return _utm_inverse(x_c, y_c, *zone)
    raise ValueError(f"Unsupported CRS EPSG:{epsg}.")


def project_edges(edges: DataFrame, epsg: int) -> DataFrame:
    """Project every vertex of an edge table (vertex by vertex)."""
    x1, y1 = project("x1", "y1", epsg)
    x2, y2 = project("x2", "y2", epsg)
    return edges.withColumns({"x1": x1, "y1": y1, "x2": x2, "y2": y2})


# ---------------------------------------------------------------------------
# Land "borders" per country (no geometry union needed)
# ---------------------------------------------------------------------------
def country_borders(shapes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Land shapes keyed by country: (country shapes, edges with shape_id := country_id).

    Point membership in the union of a country's land shapes equals
    membership in any one of them; callers deduplicate (point, country).
    """
    land = shapes.where(F.col("shape_class") == "land") if "shape_class" in shapes.columns else shapes
    e = edges.join(land.select("shape_id", "country_id"), on="shape_id")
    return land, e


def dissolved_borders(shapes: DataFrame, edges: DataFrame, band: float) -> DataFrame:
    """One closed border per country: the union of its land shapes (`shape_id` is the country)."""
    from capgrid.operators import rings

    _, land = country_borders(shapes, edges)
    return cut_lineage(rings.dissolve(land, "country_id", band))


# ---------------------------------------------------------------------------
# Polygon checks on the edge table
# ---------------------------------------------------------------------------
def _self_crossings(edges: DataFrame, ring_keys: Sequence[str]) -> DataFrame:
    """(ring keys, crossings) of rings with edges that properly cross."""
    cell = F.lit(float(default_band(edges)))
    reach = lambda a, b: F.sequence(F.floor(F.least(a, b) / cell), F.floor(F.greatest(a, b) / cell))
    spread = edges.select(*ring_keys, "seq", "x1", "y1", "x2", "y2", F.explode(reach(F.col("y1"), F.col("y2"))).alias("_row"))
    spread = spread.withColumn("_col", F.explode(reach(F.col("x1"), F.col("x2"))))
    a = spread.alias("a")
    b = spread.select(*ring_keys, "_row", "_col", F.col("seq").alias("seq_b"), *[F.col(c).alias(f"b{c}") for c in ("x1", "y1", "x2", "y2")])
    side = lambda px, py, x1, y1, x2, y2: F.signum((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1))
    col = F.col
    met = a.join(b, on=[*ring_keys, "_row", "_col"]).where(col("seq") < col("seq_b"))
    one = side(col("bx1"), col("by1"), col("x1"), col("y1"), col("x2"), col("y2")) * side(col("bx2"), col("by2"), col("x1"), col("y1"), col("x2"), col("y2"))
    two = side(col("x1"), col("y1"), col("bx1"), col("by1"), col("bx2"), col("by2")) * side(col("x2"), col("y2"), col("bx1"), col("by1"), col("bx2"), col("by2"))
    return met.where((one < 0) & (two < 0)).groupBy(*ring_keys).agg(F.count(F.lit(1)).alias("crossings"))


def polygon_checks(edges: DataFrame) -> DataFrame:
    """One row per shape with rule results: closed rings, >= 3 edges, non-zero area, no self-crossing.

    A ring is closed when every vertex starts as many edges as it ends: a
    +1/-1 count per (ring, vertex), so no ring is gathered into one array.  It
    crosses itself when two of its edges pass through each other; edges meet
    only in the (band, x-cell) squares that both reach, so a ring's edges are
    compared with their neighbourhood.
    """
    ring_keys = ["shape_id", "part", "ring"]
    ring = edges.groupBy(*ring_keys).agg(
        F.count(F.lit(1)).alias("n_edges"),
        (F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("signed_area"),
    )
    ends = edges.select(*ring_keys, F.col("x1").alias("vx"), F.col("y1").alias("vy"), F.lit(1).alias("d")).unionByName(
        edges.select(*ring_keys, F.col("x2").alias("vx"), F.col("y2").alias("vy"), F.lit(-1).alias("d"))
    )
    balance = ends.groupBy(*ring_keys, "vx", "vy").agg(F.sum("d").alias("b")).groupBy(*ring_keys).agg(
        F.bool_and(F.col("b") == 0).alias("closed")
    )
    ring = ring.join(balance, on=ring_keys).join(_self_crossings(edges, ring_keys), on=ring_keys, how="left").select(
        "shape_id",
        F.col("crossings").isNull().alias("simple"),
        "closed",
        (F.col("n_edges") >= 3).alias("enough_vertices"),
        (F.abs("signed_area") > 0).alias("non_zero_area"),
    )
    return ring.groupBy("shape_id").agg(
        F.bool_and("closed").alias("closed"),
        F.bool_and("enough_vertices").alias("enough_vertices"),
        F.bool_and("non_zero_area").alias("non_zero_area"),
        F.bool_and("simple").alias("simple"),
    ).withColumn("valid", F.col("closed") & F.col("enough_vertices") & F.col("non_zero_area") & F.col("simple"))
