"""Polygons from loose edges: noding, covering sides, ring linking, shells and holes.

Everything here works on edge tables `(shape_id, part, ring, seq, x1, y1, x2, y2)`
and gives the same kind of table back, with rings that close.

1. **Noding** (`pieces`).  Edges of one scope meet in the (band, x-cell) squares they
   run through.  A vertex that lies on another edge, and the crossing of two
   edges, become nodes; both edges get the same coordinates, since a pair's node is
   computed once, on a decimal grid (`digits`).  Pieces that an even
   number of edges of a shape run along bound nothing of that shape (spikes,
   borders between its own parts) and go.
2. **Sides** (`sides`).  The shapes on one side of a piece are those whose
   pieces a ray from its midpoint crosses an odd number of times, the piece itself left out; on
   the other side the shapes that own the piece change over.  No probe
   distance is involved.
3. **Linking** (`link`).  A rule says which owners hold a side; a piece stays for an owner
   that holds exactly one, directed so that the owner lies on its left.  At
   each vertex a piece is followed by the first one clockwise from where it came
   from, which walks along the face on its left.  Pointer doubling gives every
   piece its ring's label and place after log2(longest ring) joins.  A ring that
   passes a vertex again (a hole touching its shell there) is linked anew at that
   vertex by the first piece anticlockwise, which parts it into simple rings.
4. **Shells and holes** (`number`).  Rings with a positive area are shells, the
   others holes of the smallest shell of their owner around them.

Rings are rows throughout: no ring, shape or border is gathered into one value.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capgrid.operators.geometry import band_index, default_xcell, edge_cells, maybe_broadcast, measure_index, points_in_shapes, turn_count
from capgrid.session import cut_lineage

EDGE = ["x1", "y1", "x2", "y2"]


def grid_digits(edges: DataFrame) -> int:
    """Decimal places to which nodes are rounded: twelve significant digits of the largest coordinate."""
    top = edges.agg(F.max(F.greatest(*[F.abs(F.col(c)) for c in EDGE])).alias("m")).first()["m"] or 1.0
    return 12 - math.ceil(math.log10(max(top, 1e-9)))


# ---------------------------------------------------------------------------
# 1. Noding
# ---------------------------------------------------------------------------
def _rounded(edges: DataFrame, digits: int) -> DataFrame:
    # + 0.0 turns -0.0 into 0.0, which counts as another vertex otherwise
    return edges.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in EDGE})


def meetings(edges: DataFrame, scope: list[str], band: float, tol: float) -> DataFrame:
    """Pairs of different edges of one scope that share a square and whose boxes meet: columns a_* and b_* (a before b).

    `edges` has a sortable `eid`.  A pair may come from several squares.
    """
    cells = edge_cells(edges, band, tol)
    carried = ["eid", *[c for c in edges.columns if c not in scope and c != "eid"]]
    side = lambda prefix: cells.select(*scope, "b", "c", *[F.col(c).alias(prefix + c) for c in carried])
    met = side("a_").join(side("b_"), on=[*scope, "b", "c"]).where(F.col("a_eid") < F.col("b_eid"))
    apart = lambda lo, hi, k: F.greatest(f"{lo}{k}1", f"{lo}{k}2") < F.least(f"{hi}{k}1", f"{hi}{k}2") - F.lit(tol)
    return met.where(~(apart("a_", "b_", "x") | apart("b_", "a_", "x") | apart("a_", "b_", "y") | apart("b_", "a_", "y")))


def _gap(prefix: str, px: str, py: str) -> Column:
    """Distance of a point from an edge."""
    x1, y1, x2, y2 = (F.col(prefix + c) for c in EDGE)
    dx, dy, x, y = x2 - x1, y2 - y1, F.col(px), F.col(py)
    t = F.least(F.greatest(((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy), F.lit(0.0)), F.lit(1.0))
    return F.hypot(x - (x1 + t * dx), y - (y1 + t * dy))


def nodes(pairs: DataFrame, scope: list[str], digits: int, tol: float) -> DataFrame:
    """(scope, eid, x, y): where edges must be cut; both edges of a pair get the same point."""
    ends = {(e, k): (_gap("b_" if e == "a_" else "a_", f"{e}x{k}", f"{e}y{k}") <= F.lit(tol)) for e in ("a_", "b_") for k in (1, 2)}
    touches = [F.when(near, F.struct(F.col(("b_" if e == "a_" else "a_") + "eid").alias("eid"), F.col(f"{e}x{k}").alias("x"), F.col(f"{e}y{k}").alias("y"))) for (e, k), near in ends.items()]
    dx, dy = F.col("a_x2") - F.col("a_x1"), F.col("a_y2") - F.col("a_y1")
    ex, ey = F.col("b_x2") - F.col("b_x1"), F.col("b_y2") - F.col("b_y1")
    wx, wy = F.col("b_x1") - F.col("a_x1"), F.col("b_y1") - F.col("a_y1")
    den = F.nullif(dx * ey - dy * ex, F.lit(0.0))
    t, u = (wx * ey - wy * ex) / den, (wx * dy - wy * dx) / den
    inner = (t > 0) & (t < 1) & (u > 0) & (u < 1)
    for near in ends.values():
        inner = inner & ~near
    x, y = (F.round(F.col(f"a_{k}1") + t * d, digits) + F.lit(0.0) for k, d in (("x", dx), ("y", dy)))
    crossing = [F.when(inner, F.struct(F.col(f"{e}eid").alias("eid"), x.alias("x"), y.alias("y"))) for e in ("a_", "b_")]
    out = pairs.select(*scope, F.explode(F.filter(F.array(*touches, *crossing), lambda n: n.isNotNull())).alias("n"))
    return out.select(*scope, "n.eid", "n.x", "n.y")


def pieces(edges: DataFrame, scope: list[str], band: float, digits: int) -> DataFrame:
    """(scope, shape_id, x1, y1, x2, y2): what is left of the edges between nodes, each once per shape, directed upwards (or to the right).

    Pieces that an even number of the shape's edges run along are left out.
    """
    tol = 2 * 10.0**-digits
    keys = ["shape_id", "part", "ring", "seq"]
    rounded = _rounded(edges, digits).where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    e = rounded.select(*scope, F.struct(*[F.col(k).alias(k) for k in keys]).alias("eid"), *EDGE)
    cut_at = nodes(meetings(e, scope, band, tol), scope, digits, tol)
    along = F.struct(
        ((F.col("x") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y") - F.col("y1")) * (F.col("y2") - F.col("y1"))).alias("t"), "x", "y",
    )
    per_edge = cut_at.join(e, on=[*scope, "eid"]).groupBy(*scope, "eid").agg(F.collect_set(along).alias("at"))
    first = F.struct(F.lit(float("-inf")).alias("t"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    last = F.struct(F.lit(float("inf")).alias("t"), F.col("x2").alias("x"), F.col("y2").alias("y"))
    chain = F.array_sort(F.concat(F.array(first, last), F.coalesce("at", F.array().cast("array<struct<t:double,x:double,y:double>>"))))
    run = e.join(per_edge, on=[*scope, "eid"], how="left").withColumn("chain", chain)
    step = F.explode(F.arrays_zip(F.slice("chain", 1, F.size("chain") - 1).alias("a"), F.slice("chain", 2, F.size("chain")).alias("b")))
    parts = run.select(*scope, F.col("eid.shape_id").alias("shape_id"), step.alias("s")).select(*scope, "shape_id", "s.a.x", "s.a.y", F.col("s.b.x").alias("u"), F.col("s.b.y").alias("v"))
    parts = parts.where((F.col("x") != F.col("u")) | (F.col("y") != F.col("v")))
    up = (F.col("v") > F.col("y")) | ((F.col("v") == F.col("y")) & (F.col("u") > F.col("x")))
    pick = lambda a, b: F.when(up, F.col(a)).otherwise(F.col(b))
    directed = parts.select(*scope, "shape_id", pick("x", "u").alias("x1"), pick("y", "v").alias("y1"), pick("u", "x").alias("x2"), pick("v", "y").alias("y2"))
    return directed.groupBy(*scope, "shape_id", *EDGE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") % 2 == 1).drop("n")


# ---------------------------------------------------------------------------
# 2. Sides
# ---------------------------------------------------------------------------
def sides(cut: DataFrame, scope: list[str], band: float) -> DataFrame:
    """(scope, x1, y1, x2, y2, left, right): the sorted ids of the shapes on either side of each distinct piece."""
    whole = cut.select(F.struct(*[F.col(c) for c in [*scope, "shape_id"]]).alias("shape_id"), *EDGE)
    index = cut_lineage(band_index(whole, band))
    owned = cut.groupBy(*scope, *EDGE).agg(F.array_sort(F.collect_set("shape_id")).alias("own"))
    px, py = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    probes = owned.withColumns({"px": px, "py": py, "_b": F.floor(py / F.lit(band)), "_c": F.floor(px / F.lit(default_xcell(band)))})
    rows = maybe_broadcast(index.select(F.col("b").alias("_b"), F.col("c").alias("_c"), *[F.col(f"shape_id.{k}").alias(f"_{k}") for k in scope], F.col("shape_id.shape_id").alias("around"), "base", "turns", "edges"), measure_index(index))
    same = (F.col("_b") == F.col("_ib")) & (F.col("_c") == F.col("_ic"))
    rows = rows.withColumnsRenamed({"_b": "_ib", "_c": "_ic"})
    for k in scope:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    met = probes.join(rows, same)
    # the piece itself does not count, whatever the rounding of its midpoint
    own = F.struct(*[F.col(c) for c in EDGE])
    state = F.struct(F.col("px").alias("px"), F.col("py").alias("py"), own.alias("own"), F.lit(0).alias("n"))

    def step(acc, e):
        x, y = acc["px"], acc["py"]
        hit = ((e["y1"] > y) != (e["y2"] > y)) & (x < e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])) & (e != acc["own"])
        return F.struct(x.alias("px"), y.alias("py"), acc["own"].alias("own"), (acc["n"] + F.when(hit, 1).otherwise(0)).alias("n"))

    crossed = F.aggregate("edges", state, step)["n"]
    turned = F.when(F.size("turns") > 0, turn_count(F.col("turns"), F.col("py"))).otherwise(0)
    odd = (F.col("base") + turned + crossed) % 2 == 1
    covering = met.where(odd).groupBy(*scope, *EDGE).agg(F.collect_set("around").alias("near"))
    keys = [*scope, *EDGE]
    both = owned.join(covering, on=keys, how="left")
    near = F.coalesce("near", F.filter("own", lambda _: F.lit(False)))
    other = F.array_union(F.array_except(near, "own"), F.array_except("own", near))
    level = F.col("y1") == F.col("y2")  # a ray at a level piece's height runs just above it, which is its left
    return both.select(*keys, F.array_sort(F.when(level, near).otherwise(other)).alias("left"), F.array_sort(F.when(level, other).otherwise(near)).alias("right"))


# ---------------------------------------------------------------------------
# 3. Linking
# ---------------------------------------------------------------------------
def directed(sided: DataFrame, owners: Callable[[Column], Column]) -> DataFrame:
    """(owner, x1, y1, x2, y2): pieces of which `owners` holds one side, with the owner on the left."""
    left, right = owners(F.col("left")), owners(F.col("right"))
    on_left = sided.select(F.explode(F.array_except(left, right)).alias("owner"), *EDGE)
    on_right = sided.select(F.explode(F.array_except(right, left)).alias("owner"), F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    return on_left.unionByName(on_right)


def _turn(sign: int) -> Column:
    """Angle from the way back along `in` to `out`, clockwise (sign -1) or anticlockwise (1), in (0, 2 pi]."""
    back = F.atan2(F.col("iy1") - F.col("vy"), F.col("ix1") - F.col("vx"))
    ahead = F.atan2(F.col("oy2") - F.col("vy"), F.col("ox2") - F.col("vx"))
    full = F.lit(2 * math.pi)
    turned = F.pmod((ahead - back) * F.lit(float(sign)), full)
    return F.when(turned <= 0, full).otherwise(turned)


def _follow(loose: DataFrame, keys: list[str], sign: int) -> DataFrame:
    """(owner, id, next): the piece that comes after each piece, among those that share `keys` and leave its end vertex."""
    ins = loose.select(*keys, "id", F.col("x2").alias("vx"), F.col("y2").alias("vy"), F.col("x1").alias("ix1"), F.col("y1").alias("iy1"))
    outs = loose.select(*keys, F.col("id").alias("oid"), F.col("x1").alias("vx"), F.col("y1").alias("vy"), F.col("x2").alias("ox2"), F.col("y2").alias("oy2"))
    met = ins.join(outs, on=[*keys, "vx", "vy"])
    return met.groupBy("owner", "id").agg(F.min_by("oid", F.struct(_turn(sign).alias("t"), F.col("oid"))).alias("next"))


def _label(linked: DataFrame) -> DataFrame:
    """(owner, id, label, ahead): each piece's ring (its smallest id) and how many steps further on that id stands, by pointer doubling."""
    state = linked.select("owner", "id", F.col("next").alias("ptr"), F.col("id").alias("label"), F.lit(0).cast("long").alias("ahead"), F.lit(False).alias("moved"))
    span = 1
    while True:
        there = state.select("owner", F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("label").alias("label2"), F.col("ahead").alias("ahead2"))
        less = F.col("label2") < F.col("label")
        state = cut_lineage(
            state.join(there, on=["owner", "ptr"]).select(
                "owner", "id", F.col("ptr2").alias("ptr"), F.least("label", "label2").alias("label"),
                F.when(less, F.lit(span) + F.col("ahead2")).otherwise(F.col("ahead")).alias("ahead"), less.alias("moved"),
            )
        )
        if not state.agg(F.bool_or("moved").alias("m")).first()["m"]:
            return state.select("owner", "id", "label", "ahead")
        span *= 2


def link(loose: DataFrame) -> DataFrame:
    """(owner, label, seq, x1, y1, x2, y2): the pieces in the order of their simple rings."""
    loose = cut_lineage(loose.withColumn("id", F.xxhash64("owner", *EDGE)))
    labelled = loose.join(_label(_follow(loose, ["owner"], -1)), on=["owner", "id"])
    again = labelled.groupBy("owner", "label", F.col("x1").alias("vx"), F.col("y1").alias("vy")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    again = cut_lineage(again.select("owner", "label").distinct())
    if again.limit(1).count():
        touching = cut_lineage(labelled.join(again, on=["owner", "label"]))
        apart = _label(_follow(touching, ["owner", "label"], 1))
        parted = touching.drop("label", "ahead").join(apart, on=["owner", "id"])
        labelled = labelled.join(again, on=["owner", "label"], how="left_anti").unionByName(parted, allowMissingColumns=True)
    sizes = labelled.groupBy("owner", "label").agg(F.count(F.lit(1)).alias("n"))
    whole = labelled.join(sizes, on=["owner", "label"])
    return whole.select("owner", "label", F.pmod(F.col("n") - F.col("ahead"), F.col("n")).cast("int").alias("seq"), *EDGE)


# ---------------------------------------------------------------------------
# 4. Shells and holes
# ---------------------------------------------------------------------------
def ring_areas(rings: DataFrame, keys: list[str]) -> DataFrame:
    """Signed area of every ring (shells positive), taken about one of its own vertices."""
    base = rings.groupBy(*keys).agg(F.min("x1").alias("bx"), F.min("y1").alias("by"))
    about = rings.join(base, on=keys)
    cross = (F.col("x1") - F.col("bx")) * (F.col("y2") - F.col("by")) - (F.col("x2") - F.col("bx")) * (F.col("y1") - F.col("by"))
    return about.groupBy(*keys).agg((F.sum(cross) / 2).alias("area"))


def number(rings: DataFrame, band: float) -> DataFrame:
    """Linked rings as an edge table: parts by their shell, ring 0 the shell, holes from 1."""
    rings = cut_lineage(rings)
    areas = cut_lineage(ring_areas(rings, ["owner", "label"]))
    shells = areas.where(F.col("area") > 0)
    by_place = Window.partitionBy("owner").orderBy("label")
    parts = shells.withColumn("part", (F.row_number().over(by_place) - 1).cast("int"))
    # a hole's edges lie on no shell, so the middle of one of them is inside or outside of each shell
    holes = areas.where(F.col("area") < 0).select("owner", "label")
    probe = rings.where(F.col("seq") == 0).join(holes, on=["owner", "label"]).select(
        F.col("owner").alias("hole_owner"), F.col("label").alias("hole"), ((F.col("x1") + F.col("x2")) / 2).alias("px"), ((F.col("y1") + F.col("y2")) / 2).alias("py")
    )
    named = F.struct("owner", "label").alias("shape_id")
    around = points_in_shapes(probe, rings.join(shells.select("owner", "label"), on=["owner", "label"]).select(named, *EDGE), band, x="px", y="py")
    around = around.where(F.col("shape_id.owner") == F.col("hole_owner")).select(F.col("hole_owner").alias("owner"), "hole", F.col("shape_id.label").alias("label"))
    shell_of = around.join(parts, on=["owner", "label"]).groupBy("owner", "hole").agg(F.min_by("part", F.struct("area", "part")).alias("part"))
    order = Window.partitionBy("owner", "part").orderBy("hole")
    inner = shell_of.select("owner", F.col("hole").alias("label"), "part", F.row_number().over(order).cast("int").alias("ring"))
    numbered = parts.select("owner", "label", "part", F.lit(0).alias("ring")).unionByName(inner)
    return rings.join(numbered, on=["owner", "label"]).select(F.col("owner").alias("shape_id"), "part", "ring", "seq", *EDGE)


def rebuild(edges: DataFrame, scope: list[str], owners: Callable[[Column], Column], band: float, digits: int | None = None) -> DataFrame:
    """Edge table of the regions that `owners` (ids of the shapes on one side -> ids that hold the side) describes."""
    places = grid_digits(edges) if digits is None else digits
    cut = cut_lineage(pieces(edges, scope, band, places))
    return number(link(directed(sides(cut, scope, band), owners)), band)


# ---------------------------------------------------------------------------
# What is built from it
# ---------------------------------------------------------------------------
def make_valid(edges: DataFrame, band: float, digits: int | None = None) -> DataFrame:
    """Valid polygons of every shape by the even-odd rule.

    Rings that cross themselves or one another are cut at the crossings (a
    bow-tie gives two triangles), spikes and doubled borders vanish, rings
    that are inside an even number of others become holes, and rings are closed and directed (shells
    anticlockwise).  Shapes without any area have no rows: `rejected_shapes`
    lists them.
    """
    own = edges.withColumn("whole", F.col("shape_id"))
    return rebuild(own, ["whole"], lambda ids: ids, band, digits)


def rejected_shapes(edges: DataFrame, valid: DataFrame) -> DataFrame:
    """Ids of shapes that have no polygon left."""
    return edges.select("shape_id").distinct().join(valid.select("shape_id").distinct(), on="shape_id", how="left_anti")


def dissolve(edges: DataFrame, group: str, band: float, digits: int | None = None) -> DataFrame:
    """One shape per value of the column `group`: the union of its shapes, borders between them gone (`shape_id` is the group's value)."""
    grouped = edges.withColumn("_group", F.col(group))
    places = grid_digits(edges) if digits is None else digits
    cut = cut_lineage(pieces(grouped, ["_group"], band, places))
    sided = sides(cut, ["_group"], band)
    held = lambda c: F.when(F.size(c) > 0, F.array("_group")).otherwise(F.slice(F.array("_group"), 1, 0))
    return number(link(directed(sided, held)), band)


def shape_areas(edges: DataFrame) -> DataFrame:
    """(shape_id, area) of an edge table whose shells and holes run in opposite directions."""
    return ring_areas(edges, ["shape_id", "part", "ring"]).groupBy("shape_id").agg(F.sum("area").alias("area"))


# ---------------------------------------------------------------------------
# Shape-to-shape join and checks between rings
# ---------------------------------------------------------------------------
def intersecting_shapes(left: DataFrame, right: DataFrame, band: float) -> DataFrame:
    """(shape_id, other_id): shapes of `left` that share a point with a shape of `right`.

    Two shapes meet when edges of theirs do, or when one lies wholly inside the
    other: then a vertex of each of its rings does.
    """
    ids = lambda e, s: e.select(F.struct(F.lit(s).alias("side"), "shape_id", "part", "ring", "seq").alias("eid"), "shape_id", *EDGE)
    tol = 2 * 10.0 ** -grid_digits(left)
    pairs = meetings(ids(left, 0).unionByName(ids(right, 1)).withColumn("all", F.lit(0)), ["all"], band, tol).where((F.col("a_eid.side") == 0) & (F.col("b_eid.side") == 1))
    touch = F.lit(False)
    for e, other in (("a_", "b_"), ("b_", "a_")):
        for k in (1, 2):
            touch = touch | (_gap(other, f"{e}x{k}", f"{e}y{k}") <= F.lit(tol))
    crossing = pairs.where(touch | properly_cross()).select(F.col("a_shape_id").alias("shape_id"), F.col("b_shape_id").alias("other_id"))
    start = lambda e: e.where(F.col("seq") == 0).select(F.col("shape_id").alias("inner"), F.col("x1").alias("px"), F.col("y1").alias("py"))
    inside_right = points_in_shapes(start(left), right, band, x="px", y="py").select(F.col("inner").alias("shape_id"), F.col("shape_id").alias("other_id"))
    inside_left = points_in_shapes(start(right), left, band, x="px", y="py").select("shape_id", F.col("inner").alias("other_id"))
    return crossing.unionByName(inside_right).unionByName(inside_left).distinct()


def properly_cross() -> Column:
    """Whether the edges a_* and b_* pass through each other."""
    c = F.col
    side = lambda px, py, e: F.signum((c(f"{e}x2") - c(f"{e}x1")) * (c(py) - c(f"{e}y1")) - (c(f"{e}y2") - c(f"{e}y1")) * (c(px) - c(f"{e}x1")))
    return (side("b_x1", "b_y1", "a_") * side("b_x2", "b_y2", "a_") < 0) & (side("a_x1", "a_y1", "b_") * side("a_x2", "a_y2", "b_") < 0)


def ring_conflicts(edges: DataFrame, band: float) -> DataFrame:
    """One row per shape: how its rings and parts get along (E17 across rings).

    `crossings`: edges, of one ring or of two, that pass through each other;
    `shared_edges`: pairs of edges that share a stretch; `holes_outside`: holes
    (ring > 0) not inside their part's shell; `nested_parts`: shells inside
    another part.
    """
    e = edges.select("shape_id", F.struct("part", "ring", "seq").alias("eid"), *EDGE)
    pairs = meetings(e, ["shape_id"], band, 0.0)
    dx, dy = F.col("a_x2") - F.col("a_x1"), F.col("a_y2") - F.col("a_y1")
    off = lambda k: dx * (F.col(f"b_y{k}") - F.col("a_y1")) - dy * (F.col(f"b_x{k}") - F.col("a_x1"))
    along = lambda k: dx * (F.col(f"b_x{k}") - F.col("a_x1")) + dy * (F.col(f"b_y{k}") - F.col("a_y1"))
    shared = F.least(F.greatest(along(1), along(2)), dx * dx + dy * dy) > F.greatest(F.least(along(1), along(2)), F.lit(0.0))
    overlap = (off(1) == 0) & (off(2) == 0) & shared
    found = pairs.select("shape_id", "a_eid", "b_eid", properly_cross().alias("crossing"), overlap.alias("overlap")).where(F.col("crossing") | F.col("overlap")).distinct()
    counted = found.groupBy("shape_id").agg(F.count_if("crossing").alias("crossings"), F.count_if("overlap").alias("shared_edges"))
    middles = edges.where(F.col("seq") == 0).select(
        F.col("shape_id").alias("of"), F.col("part").alias("of_part"), F.col("ring").alias("of_ring"), ((F.col("x1") + F.col("x2")) / 2).alias("px"), ((F.col("y1") + F.col("y2")) / 2).alias("py")
    )
    # shells alone tell whether a hole is inside; whole parts tell whether a shell is inside another part
    shells = edges.where(F.col("ring") == 0).select(F.struct("shape_id", "part").alias("shape_id"), *EDGE)
    whole = edges.select(F.struct("shape_id", "part").alias("shape_id"), *EDGE)
    own = (F.col("shape_id.shape_id") == F.col("of")) & (F.col("shape_id.part") == F.col("of_part"))
    holes = middles.where(F.col("of_ring") > 0)
    held = points_in_shapes(holes, shells, band, x="px", y="py").where(own).select("of", "of_part", "of_ring")
    loose = holes.join(held, on=["of", "of_part", "of_ring"], how="left_anti").groupBy("of").agg(F.count(F.lit(1)).alias("holes_outside"))
    inside = points_in_shapes(middles.where(F.col("of_ring") == 0), whole, band, x="px", y="py", boundary="exclude")
    nested = inside.where((F.col("shape_id.shape_id") == F.col("of")) & (F.col("shape_id.part") != F.col("of_part"))).groupBy("of").agg(F.countDistinct("of_part").alias("nested_parts"))
    out = edges.select("shape_id").distinct().join(counted, on="shape_id", how="left")
    out = out.join(loose.withColumnRenamed("of", "shape_id"), on="shape_id", how="left").join(nested.withColumnRenamed("of", "shape_id"), on="shape_id", how="left")
    return out.na.fill(0, ["crossings", "shared_edges", "holes_outside", "nested_parts"])
