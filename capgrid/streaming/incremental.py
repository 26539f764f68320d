"""Incremental capacity aggregation over a folder of published plant files.

The upstream has no streaming; this is the batch aggregation (G4) run as a
Structured Streaming query, for deployments where category tables are
published one file at a time: each new file is joined to the (static,
size-checked) band index of the shapes and folded into a running sum per
shape and technology group held in the state store.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from capgrid.config import CAPACITY_GROUP_COLUMNS
from capgrid.functions.columns import year_predicate
from capgrid.operators.geometry import points_in_shapes
from capgrid.operators.quality import PLANT_SCHEMA
from capgrid.session import ensure_checkpoint_dir


def stream_plants(spark: SparkSession, folder: str, max_files_per_trigger: int = 16) -> DataFrame:
    """Plant files arriving in `folder` (Parquet, the plant schema)."""
    return spark.readStream.schema(PLANT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)


def running_capacity(
    plants: DataFrame,
    shapes: DataFrame,
    edges: DataFrame,
    year: int,
    band: float,
    group_columns: Sequence[str] = tuple(CAPACITY_GROUP_COLUMNS),
) -> DataFrame:
    """Streaming form of `aggregate_capacity`: operating MW per shape and group."""
    groups = [c for c in group_columns if c in plants.columns]
    operating = plants.where(F.coalesce(year_predicate(year, "operating"), F.lit(False)))
    pts = operating.select("lon", "lat", "output_capacity_mw", *groups).dropna(subset=groups)
    hits = points_in_shapes(pts, edges, band, x="lon", y="lat")
    agg = hits.groupBy("shape_id", *groups).agg(F.sum("output_capacity_mw").alias("output_capacity_mw"))
    return agg.join(shapes.select("shape_id", "country_id"), on="shape_id")


def start(agg: DataFrame, name: str, sink: str = "memory", path: str | None = None) -> StreamingQuery:
    """Start the query with its state under the shared checkpoint folder.

    The state folder is keyed by `name`, so a restarted job with the same
    name resumes from its last committed offsets (exactly-once sums).
    """
    ckpt = os.path.join(ensure_checkpoint_dir(agg.sparkSession), f"stream-{name}")
    writer = agg.writeStream.outputMode("complete").option("checkpointLocation", ckpt).queryName(name)
    if sink == "memory":
        return writer.format("memory").start()
    # complete-mode tables are replaced per micro-batch by an idempotent overwrite
    return writer.foreachBatch(lambda df, _id: df.write.mode("overwrite").parquet(path)).start()
