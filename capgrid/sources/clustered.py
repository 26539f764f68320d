"""Clustered rasters (A9): pixel tables sorted along a Morton curve, read by box.

`zkey` interleaves the bits of a pixel's row and column, so pixels near each
other get near keys.  Range partitioning and sorting by it give every file and
row group a narrow key range, and a box of rows and columns becomes a few key
ranges that Parquet compares with the row groups' least and greatest key: a
zonal job over one country reads the row groups around it, not the raster.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A box is covered by at most about this many key ranges; they may reach beyond it, and exact row and column tests follow.
MAX_RANGES = 32
#: Rows and columns are below two to this power.
BITS = 31


def _spread(number: Column) -> Column:
    """The low 32 bits of a number, moved to the even places."""
    out = number.cast("long")
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(F.lit(mask))
    return out


def morton_key(row: Column, column: Column) -> Column:
    return F.shiftleft(_spread(row), 1).bitwiseOR(_spread(column))


def write_clustered_pixels(pixels: DataFrame, path: str, files: int | None = None, row_group_bytes: int | None = None) -> None:
    """Write a pixel table with `zkey`, range-partitioned and sorted by it.

    `files` is left to the session's shuffle partitions (and AQE) unless given.
    """
    keyed = pixels.withColumn("zkey", morton_key(F.col("prow"), F.col("pcol")))
    dealt = keyed.repartitionByRange(files, "zkey") if files else keyed.repartitionByRange("zkey")
    writer = dealt.sortWithinPartitions("zkey").write.mode("overwrite")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def key_ranges(first_row: int, last_row: int, first_col: int, last_col: int, limit: int = MAX_RANGES) -> list[tuple[int, int]]:
    """Ascending, separate key ranges that cover every pixel of the box.

    Squares of the curve's quadtree are split largest first while they are partly
    outside the box and the number of squares stays within the limit.
    """
    if first_row > last_row or first_col > last_col:
        return []
    meets = lambda r, c, size: r <= last_row and r + size > first_row and c <= last_col and c + size > first_col
    within = lambda r, c, size: r >= first_row and r + size - 1 <= last_row and c >= first_col and c + size - 1 <= last_col
    done, open_ = [], [(0, 0, 1 << BITS, 0)]  # row, column, side, first key
    while open_ and len(done) + len(open_) + 3 <= limit:
        r, c, size, key = open_.pop(0)
        if within(r, c, size):
            done.append((key, key + size * size - 1))
            continue
        half = size // 2
        quarters = [(r + half * (q >> 1), c + half * (q & 1), half, key + q * half * half) for q in range(4)]
        open_ += [q for q in quarters if meets(*q[:3])]
    merged: list[tuple[int, int]] = []
    for low, high in sorted(done + [(key, key + size * size - 1) for _, _, size, key in open_]):
        if merged and merged[-1][1] + 1 == low:
            low, _ = merged.pop()
        merged.append((low, high))
    return merged


def read_clustered_pixels(spark: SparkSession, path: str, boxes: list[tuple[int, int, int, int]] | None = None) -> DataFrame:
    """`(prow, pcol, x, y, value)` of all pixels, or of those in any of the boxes (first row, last row, first column, last column)."""
    pixels = spark.read.parquet(path)
    if boxes is not None:
        near = [F.col("zkey").between(low, high) for box in boxes for low, high in key_ranges(*box)]
        exact = [F.col("prow").between(r0, r1) & F.col("pcol").between(c0, c1) for r0, r1, c0, c1 in boxes]
        pixels = pixels.where(reduce(or_, near, F.lit(False)) & reduce(or_, exact, F.lit(False)))
    return pixels.select("prow", "pcol", "x", "y", F.col("value").cast("double"))


def box_of_edges(edges: DataFrame, left: float, top: float, width: float, height: float) -> list[tuple[int, int, int, int]]:
    """The pixels around all edges as one box (one aggregate); none without edges or beside the grid."""
    x, y = (lambda c: (F.col(c) - left) / width), (lambda c: (F.lit(top) - F.col(c)) / height)
    r = edges.agg(
        F.floor(F.min(F.least(y("y1"), y("y2")))).alias("r0"), F.floor(F.max(F.greatest(y("y1"), y("y2")))).alias("r1"),
        F.floor(F.min(F.least(x("x1"), x("x2")))).alias("c0"), F.floor(F.max(F.greatest(x("x1"), x("x2")))).alias("c1"),
    ).first()
    if r["r0"] is None or r["r1"] < 0 or r["c1"] < 0:
        return []
    return [(max(0, r["r0"]), r["r1"], max(0, r["c0"]), r["c1"])]
