"""Sink (A10): one Parquet partition per (shapes, adjustment, category)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_output(df: DataFrame, path: str, shapes: str, adjustment: str, category: str) -> None:
    """Write a published table under `shapes=/adjustment=/category=` partitions.

    Dynamic partition overwrite replaces only the partition being written, so
    jobs for other categories can publish into the same table concurrently.
    """
    (
        df.withColumn("shapes", F.lit(shapes))
        .withColumn("adjustment", F.lit(adjustment))
        .withColumn("category_part", F.lit(category))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("shapes", "adjustment", "category_part")
        .parquet(path)
    )


def _encode_polygons(it):
    import struct

    import pandas as pd

    for pdf in it:
        out = []
        for sid, parts in zip(pdf["shape_id"], pdf["parts"]):
            polys = []
            for part in parts:
                rings = part["rings"]
                buf = struct.pack("<BII", 1, 3, len(rings))
                for ring in rings:
                    pts = [(v["x"], v["y"]) for v in ring["pts"]]
                    pts.append(pts[0])
                    buf += struct.pack("<I", len(pts)) + b"".join(struct.pack("<dd", x, y) for x, y in pts)
                polys.append(buf)
            geom = polys[0] if len(polys) == 1 else struct.pack("<BII", 1, 6, len(polys)) + b"".join(polys)
            out.append((sid, bytearray(geom)))
        yield pd.DataFrame(out, columns=["shape_id", "geometry"])


def write_geo_polygons(attrs: DataFrame, edges: DataFrame, path: str) -> None:
    """Write shapes as Parquet with WKB (Multi)Polygon geometry, one shape per row.

    Rings are rebuilt from the edge order (`seq`); a shape's geometry is a
    single value, so it is assembled per shape row, never per table.
    """
    rings = edges.groupBy("shape_id", "part", "ring").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "x1", "y1"))), lambda v: F.struct(v["x1"].alias("x"), v["y1"].alias("y"))).alias("pts")
    )
    parts = rings.groupBy("shape_id", "part").agg(F.array_sort(F.collect_list(F.struct("ring", "pts"))).alias("rings"))
    shapes = parts.groupBy("shape_id").agg(F.array_sort(F.collect_list(F.struct("part", "rings"))).alias("parts"))
    geoms = shapes.mapInPandas(_encode_polygons, schema="shape_id string, geometry binary")
    attrs.join(geoms, on="shape_id").write.mode("overwrite").parquet(path)
