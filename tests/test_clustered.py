import glob
import random

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from capgrid.sources import clustered as K


def key(row, col):
    return sum(((row >> b & 1) << (2 * b + 1)) | ((col >> b & 1) << (2 * b)) for b in range(K.BITS))


def test_keys_interleave_the_bits(spark):
    rng = random.Random(0)
    places = [(0, 0), (1, 0), (0, 1), (2**31 - 1, 2**31 - 1)] + [(rng.getrandbits(31), rng.getrandbits(31)) for _ in range(200)]
    rows = spark.createDataFrame(places, "prow bigint, pcol bigint").select("prow", "pcol", K.morton_key(F.col("prow"), F.col("pcol")).alias("k")).collect()
    assert all(r.k == key(r.prow, r.pcol) >= 0 for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 60), st.integers(0, 12), st.integers(0, 60), st.integers(0, 12), st.integers(8, 40))
def test_ranges_cover_the_box(r, h, c, w, limit):
    ranges = K.key_ranges(r, r + h, c, c + w, limit)
    assert len(ranges) <= limit and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
    assert all(any(low <= key(i, j) <= high for low, high in ranges) for i in range(r, r + h + 1) for j in range(c, c + w + 1))


def test_exact_ranges_when_the_limit_allows():
    ranges = K.key_ranges(3, 9, 5, 6, 10_000)
    covered = {k for low, high in ranges for k in range(low, high + 1)}
    assert covered == {key(i, j) for i in range(3, 10) for j in (5, 6)} and K.key_ranges(3, 2, 0, 5) == []


def test_a_box_reads_few_row_groups(spark, tmp_path):
    n = 256
    pixels = spark.range(n * n).select((F.col("id") % n).cast("int").alias("prow"), F.floor(F.col("id") / n).cast("int").alias("pcol"), F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y"), F.col("id").alias("value"))
    path = str(tmp_path / "clustered")
    K.write_clustered_pixels(pixels, path, files=16)
    box = (40, 70, 100, 120)
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    near = K.read_clustered_pixels(spark, path, [box])
    inside = lambda df: df.where("prow BETWEEN 40 AND 70 AND pcol BETWEEN 100 AND 120")
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, inside(K.read_clustered_pixels(spark, path)).collect())) and near.count() == 31 * 21
    plan = near._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(zkey," in plan.split("PushedFilters:", 1)[1]
    ranges = K.key_ranges(*box)
    stats = [f.metadata.row_group(i) for f in map(pq.ParquetFile, glob.glob(f"{path}/*.parquet")) for i in range(f.metadata.num_row_groups)]
    at = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).schema_arrow.names.index("zkey")
    met = [g for g in stats if any(g.column(at).statistics.min <= high and g.column(at).statistics.max >= low for low, high in ranges)]
    assert len(stats) >= 14 and len(met) <= 4
    assert K.read_clustered_pixels(spark, path, []).count() == 0


def test_boxes_of_edges(spark):
    ddl = "shape_id string, x1 double, y1 double, x2 double, y2 double"
    edges = spark.createDataFrame([("s", 1.5, 7.0, 3.2, 6.5), ("s", 3.2, 6.5, -4.0, 7.5)], ddl)
    assert K.box_of_edges(edges, 0.0, 8.0, 1.0, 1.0) == [(0, 1, 0, 3)]
    assert K.box_of_edges(edges.limit(0), 0.0, 8.0, 1.0, 1.0) == [] == K.box_of_edges(edges, 50.0, 8.0, 1.0, 1.0)
