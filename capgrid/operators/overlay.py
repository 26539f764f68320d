"""Exclusive shapes (each shape minus every shape overlapping it), as polygons with parts, shells and holes.

The boundary of "i and no other shape" is made of pieces of the input edges:
those with i alone on exactly one side.  Noding, sides, linking into rings and
the assignment of holes to shells are those of `rings`; the result is an edge
table of closed rings, so membership, distance, placement by part and the
polygon sink work on it.  Shapes left with no piece have no exclusive area:
the caller raises with their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capgrid.operators import rings
from capgrid.session import cut_lineage


def exclusive_edges(edges: DataFrame, band: float, digits: int | None = None) -> DataFrame:
    """Edge table of the exclusive shapes; nodes lie on a grid of `digits` decimals (by default twelve significant digits)."""
    alone = lambda ids: F.when(F.size(ids) == 1, ids).otherwise(F.slice(ids, 1, 0))
    return rings.rebuild(edges.withColumn("_all", F.lit(0)), ["_all"], alone, band, digits)


def shapes_without_exclusive_area(shapes: DataFrame, excl: DataFrame) -> DataFrame:
    """Shape ids with nothing left after removing overlaps (the error case)."""
    return shapes.select("shape_id").join(excl.select("shape_id").distinct(), on="shape_id", how="left_anti")


def build_exclusive_shapes(shapes: DataFrame, edges: DataFrame, band: float, digits: int | None = None) -> DataFrame:
    """Exclusive edge table; fails when a shape has no exclusive area left."""
    excl = cut_lineage(exclusive_edges(edges, band, digits))
    # every such shape is listed in the error: their ids, and nothing else, come to the driver
    empty = sorted(r.shape_id for r in shapes_without_exclusive_area(shapes, excl).collect())
    if empty:
        raise ValueError(f"Overlap removal leaves no area of their own to {len(empty)} shapes: {', '.join(empty)}")
    return excl
