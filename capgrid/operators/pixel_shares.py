"""Area-true raster sums (H2, H3): a pixel on a border counts by the share of its square inside the shape.

Every ring edge is cut at the grid's lines.  A piece in a pixel says how much
of the pixel's height it spans (`cover`, signed by the side the shape lies on)
and how much of the square lies to its right (`area`).  Along a pixel row the
covers of all pixels further left add up to what is inside here, so one running
sum over a shape's border pixels of a row gives exact shares: a share for each
border pixel, and one share for the whole run up to the next.  Pixels meet the
runs in an equi-join on the row and a block of columns; no centre is tested and
no shape travels as one value.

A part's ring 0 is its shell, the others are holes inside it; either may run in
either direction.  Rings must not cross themselves (`rings.make_valid`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capgrid.session import cut_lineage, small

#: Columns of a block: a run is copied to the blocks it touches.
BLOCK = 64
#: Shares this close to nothing or to the whole pixel are rounding.
_ROUNDING = 1e-12


@dataclass(frozen=True)
class Grid:
    """Where pixel (prow, pcol) lies: its left side at left + pcol * width, its upper side at top - prow * height."""

    left: float
    top: float
    width: float
    height: float


def _clamped(t: Column) -> Column:
    return F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))


def _pieces(edges: DataFrame, grid: Grid) -> DataFrame:
    """(shape_id, prow, pcol, cover, area): sums over the edges' pieces; all that lies left of the grid is column -1."""
    twice = (F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).alias("twice")
    turn = edges.select("shape_id", "part", "ring", twice).groupBy("shape_id", "part", "ring").agg(F.signum(F.sum("twice")).alias("turn"))
    u, v = (lambda x: (F.col(x) - F.lit(grid.left)) / F.lit(grid.width)), (lambda y: (F.lit(grid.top) - F.col(y)) / F.lit(grid.height))
    scaled = edges.where("y1 <> y2").join(turn, on=["shape_id", "part", "ring"]).select(
        "shape_id", (F.col("turn") * F.when(F.col("ring") == 0, 1.0).otherwise(-1.0)).alias("side"),
        u("x1").alias("u1"), (u("x2") - u("x1")).alias("du"), v("y1").alias("v1"), (v("y2") - v("y1")).alias("dv"),
    ).where("dv <> 0")
    end = F.col("v1") + F.col("dv")
    rows = scaled.withColumn("prow", F.explode(F.sequence(F.floor(F.least("v1", end)), F.floor(F.greatest("v1", end)))))
    at = [_clamped((F.col("prow") + i - F.col("v1")) / F.col("dv")) for i in (0, 1)]
    rows = rows.withColumns({"a": F.least(*at), "b": F.greatest(*at)}).where("b > a")
    across = [F.col("u1") + F.col("du") * F.col(t) for t in ("a", "b")]
    column = lambda x: F.greatest(F.floor(x), F.lit(-1).cast("long"))
    cells = rows.withColumn("pcol", F.explode(F.sequence(column(F.least(*across)), column(F.greatest(*across)))))
    slope = F.nullif(F.col("du"), F.lit(0.0))
    near = F.when(F.col("pcol") < 0, -F.signum("du") * float("inf")).otherwise((F.col("pcol") - F.col("u1")) / slope)
    far = (F.col("pcol") + 1 - F.col("u1")) / slope
    flat = F.col("du") == 0
    low = F.when(flat, F.col("a")).otherwise(F.greatest("a", F.least(near, far)))
    high = F.when(flat, F.col("b")).otherwise(F.least("b", F.greatest(near, far)))
    cut = cells.withColumns({"low": low, "high": high}).where("high > low")
    cover = F.col("side") * F.col("dv") * (F.col("high") - F.col("low"))
    right = F.col("pcol") + 1 - F.col("u1") - F.col("du") * (F.col("low") + F.col("high")) / 2
    return cut.groupBy("shape_id", "prow", "pcol").agg(F.sum(cover).alias("cover"), F.sum(cover * right).alias("area"))


def coverage_runs(edges: DataFrame, grid: Grid) -> DataFrame:
    """(shape_id, prow, first, last, share): pixels first to last of a row lie in the shape by that share of their square."""
    along = Window.partitionBy("shape_id", "prow").orderBy("pcol")  # border pixels of one shape in one row
    left = F.coalesce(F.sum("cover").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    told = _pieces(edges, grid).select("shape_id", "prow", "pcol", "cover", "area", left.alias("left"), F.lead("pcol").over(along).alias("next"))
    own = F.struct(F.col("pcol").alias("first"), F.col("pcol").alias("last"), (F.col("left") + F.col("area")).alias("share"))
    rest = F.struct((F.col("pcol") + 1).alias("first"), (F.col("next") - 1).alias("last"), (F.col("left") + F.col("cover")).alias("share"))
    runs = told.select("shape_id", "prow", F.explode(F.array(own, rest)).alias("r")).select("shape_id", "prow", "r.*")
    whole = F.when(F.col("share") > 1 - _ROUNDING, F.lit(1.0)).otherwise(F.col("share"))
    return runs.where((F.col("first") >= 0) & (F.col("last") >= F.col("first")) & (F.col("share") > _ROUNDING)).withColumn("share", whole)


def pixel_shares(pixels: DataFrame, edges: DataFrame, grid: Grid) -> DataFrame:
    """The pixels' columns with (shape_id, share), one row for every shape that covers some of a pixel."""
    runs = coverage_runs(edges, grid).withColumn("_block", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor(F.col("last") / BLOCK))))
    runs = runs.withColumnRenamed("prow", "_row")
    met = (F.col("prow") == F.col("_row")) & (F.floor(F.col("pcol") / BLOCK) == F.col("_block")) & F.col("pcol").between(F.col("first"), F.col("last"))
    return pixels.join(runs, met).drop("_row", "_block", "first", "last")


# H2 -----------------------------------------------------------------------
def disaggregate_by_share(totals: DataFrame, pixels: DataFrame, land_shapes: DataFrame, land_edges: DataFrame, grid: Grid) -> DataFrame:
    """(prow, pcol, x, y, country_id, value): each country's total over its pixels, by proxy value times the land's share.

    A pixel on a border has a row for each country.  A country's rows add up to its total.
    """
    land = pixel_shares(pixels.select("prow", "pcol", "x", "y", "value"), land_edges, grid).join(small(land_shapes.select("shape_id", "country_id")), on="shape_id")
    weights = cut_lineage(land.groupBy("prow", "pcol", "x", "y", "country_id").agg(F.sum(F.col("value") * F.col("share")).alias("weight")))  # read for the sums and for the shares
    sums = weights.groupBy("country_id").agg(F.sum("weight").alias("_sum"))
    shared = weights.join(small(cut_lineage(sums.join(totals, on="country_id"))), on="country_id")
    return shared.select("prow", "pcol", "x", "y", "country_id", (F.try_divide(F.col("weight"), F.col("_sum")) * F.col("output_capacity_mw")).alias("value"))


# H3 -----------------------------------------------------------------------
def zonal_sum_by_share(pixels: DataFrame, shapes: DataFrame, edges: DataFrame, grid: Grid) -> DataFrame:
    """(shape_id, country_id, sum) of pixel values, each times the share of the pixel inside the shape."""
    sums = pixel_shares(pixels.select("prow", "pcol", "value"), edges, grid).groupBy("shape_id").agg(F.sum(F.col("value") * F.col("share")).alias("sum"))
    return sums.join(shapes.select("shape_id", "country_id"), on="shape_id")
