"""The streaming aggregation equals the batch aggregation on the same files."""

import tempfile
import uuid

from pyspark.sql import functions as F

from capgrid.operators.capacity import aggregate_capacity
from capgrid.operators.quality import PLANT_SCHEMA, conform
from capgrid.plans import queries as Q
from capgrid.streaming.incremental import running_capacity, start, stream_plants

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    plants = conform(Q.aged_plants(spark, SF), PLANT_SCHEMA, optional=["reservoir_km3"])
    plants = plants.withColumn("reservoir_km3", F.lit(None).cast("double"))
    folder = tempfile.mkdtemp(prefix="capgrid-stream-")
    plants = plants.cache()
    plants.where(F.col("technology") == "ccgt").write.mode("append").parquet(folder)
    plants.where(F.col("technology") != "ccgt").write.mode("append").parquet(folder)
    shapes, edges = Q.shapes(spark, SF)
    stream = stream_plants(spark, folder)
    name = f"cap_test_{uuid.uuid4().hex[:8]}"  # state of a stream name persists in the shared folder
    q = start(running_capacity(stream, shapes, edges, Q.Y, Q.B), name)
    try:
        q.processAllAvailable()
        got = spark.sql(f"SELECT * FROM {name}")
        cols = ["shape_id", "technology", "fuel_class", "chp", "ccs"]
        want = aggregate_capacity(plants, shapes, edges, Q.Y, Q.B)
        a = sorted((tuple(r[c] for c in cols), round(r["output_capacity_mw"], 6)) for r in got.collect())
        b = sorted((tuple(r[c] for c in cols), round(r["output_capacity_mw"], 6)) for r in want.collect())
        assert a == b and len(a) > 0
    finally:
        q.stop()


def test_stream_file_sink_overwrites_with_running_totals(spark):
    plants = conform(Q.aged_plants(spark, SF), PLANT_SCHEMA, optional=["reservoir_km3"])
    plants = plants.withColumn("reservoir_km3", F.lit(None).cast("double")).cache()
    folder = tempfile.mkdtemp(prefix="capgrid-stream-in-")
    out = tempfile.mkdtemp(prefix="capgrid-stream-out-") + "/table"
    plants.write.mode("append").parquet(folder)
    shapes, edges = Q.shapes(spark, SF)
    name = f"cap_file_{uuid.uuid4().hex[:8]}"
    q = start(running_capacity(stream_plants(spark, folder), shapes, edges, Q.Y, Q.B), name, sink="parquet", path=out)
    try:
        q.processAllAvailable()
        got = spark.read.parquet(out).agg(F.sum("output_capacity_mw")).first()[0]
        want = aggregate_capacity(plants, shapes, edges, Q.Y, Q.B).agg(F.sum("output_capacity_mw")).first()[0]
        assert abs(got - want) < 1e-6 * max(1.0, abs(want))
    finally:
        q.stop()
