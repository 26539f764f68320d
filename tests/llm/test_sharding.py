import itertools
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from capgrid.llm import sharding as S
from capgrid.llm.queries import QUERIES


def test_query_sizes_and_slots(spark, sf):
    rows = QUERIES["op4_uniform_shards"](spark, sf).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    import zlib

    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "rows" and r["grown_shard"] is None


def test_same_rows_again(spark, sf):
    first, second = (sorted(map(tuple, QUERIES["op4_uniform_shards"](spark, sf).select("doc_id", "shard", "slot").collect())) for _ in range(2))
    assert first == second


@pytest.mark.parametrize("n,k,d", [(50, 20, 10), (1000, 10, 400), (7, 7, 3), (10, 0, 4), (2, 1, 1), (0, 0, 0)])
def test_hypergeometric_moments(spark, n, k, d):
    draws = 3000
    u = S.uniform(F.col("id"), F.lit(f"{n}-{k}-{d}"))
    x = spark.range(draws).select(S.hypergeometric(F.lit(n).cast("long"), F.lit(k).cast("long"), F.lit(d).cast("long"), u).alias("x"))
    row = x.agg(F.avg("x").alias("m"), F.var_samp("x").alias("v"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    mean = d * k / max(n, 1)
    var = mean * (n - k) / max(n, 1) * (n - d) / max(n - 1, 1)
    assert max(0, d - (n - k)) <= row["low"] and row["high"] <= min(d, k)
    assert abs(row["m"] - mean) <= 5 * (var / draws) ** 0.5 + 1e-12
    assert abs(row["v"] - var) <= 0.25 * var + 1e-12


def _chi_square(seen, expected):
    """Statistic and degrees of freedom, cells that expect under 8 together."""
    rest = [(seen.get(c, 0), e) for c, e in expected.items() if e < 8]
    cells = [(seen.get(c, 0), e) for c, e in expected.items() if e >= 8] + ([(sum(s for s, _ in rest), sum(e for _, e in rest))] if sum(e for _, e in rest) >= 1 else [])
    return sum((s - e) ** 2 / e for s, e in cells), len(cells) - 1


@pytest.mark.parametrize("n,k,d", [(4000, 2000, 1700), (9000, 6500, 3000), (9000, 2500, 6200), (20000, 15000, 12000)])
def test_rejection_follows_the_exact_law(spark, n, k, d):
    """All four reductions (smaller kind, smaller sample), standard deviations just above where inversion ends."""
    draws = 8000
    u = S.uniform(F.col("id"), F.lit(f"{n}-{k}-{d}"))
    long = lambda v: F.lit(v).cast("long")
    seen = {r["x"]: r["count"] for r in spark.range(draws, numPartitions=8).select(S.hypergeometric(long(n), long(k), long(d), u).alias("x")).groupBy("x").count().collect()}
    log_choose = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    expected = {x: draws * math.exp(log_choose(k, x) + log_choose(n - k, d - x) - log_choose(n, d)) for x in range(max(0, d - n + k), min(k, d) + 1)}
    assert set(seen) <= set(expected)
    chi, free = _chi_square(seen, expected)
    assert chi < free + 5 * (2 * free) ** 0.5


def test_draws_of_billions_cost_no_more(spark):
    n, k, d, draws = 3_000_000_000, 47_000_000, 1_500_000_000, 3000
    long = lambda v: F.lit(v).cast("long")
    row = spark.range(draws, numPartitions=8).select(S.hypergeometric(long(n), long(k), long(d), S.uniform(F.col("id"))).alias("x")).agg(F.avg("x").alias("m"), F.stddev("x").alias("s"), F.count("x").alias("c")).first()
    mean = d * k / n
    sd = (mean * (n - k) / n * (n - d) / (n - 1)) ** 0.5
    assert row["c"] == draws and abs(row["m"] - mean) <= 5 * sd / draws**0.5 and abs(row["s"] / sd - 1) < 0.07


def test_matrix_law_equals_the_enumeration(spark):
    """Every matrix of 3 partitions and 3 targets comes as often as permutations give it."""
    rows, columns, trees = [3, 2, 2], [3, 3, 1], 20000
    fact = math.factorial
    expected = {}
    for m in itertools.product(range(4), repeat=9):
        if [sum(m[i * 3 : i * 3 + 3]) for i in range(3)] == rows and [sum(m[j::3]) for j in range(3)] == columns:
            weight = math.prod(map(fact, rows)) * math.prod(map(fact, columns)) / fact(sum(rows)) / math.prod(map(fact, m))
            expected[m] = trees * weight
    assert abs(sum(expected.values()) - trees) < 1e-6
    parts = F.array(*[F.struct(F.lit(i).cast("long").alias("part"), F.lit(r).cast("long").alias("n")) for i, r in enumerate(rows)])
    nodes = spark.range(trees, numPartitions=8).select(F.col("id").alias("of"), S._padded(parts, 2).alias("parts"), F.array(*[F.lit(c).cast("long") for c in columns]).alias("columns"))
    drawn = S._draw_rows(nodes, 2, 7, 0).groupBy("of").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "sends"))), lambda r: r["sends"])).alias("m"))
    seen = {tuple(r["m"]): r["count"] for r in drawn.groupBy("m").count().collect()}
    assert set(seen) <= set(expected)
    chi, free = _chi_square(seen, expected)
    assert chi < free + 5 * (2 * free) ** 0.5


def test_matrix_has_the_wanted_sums(spark):
    sizes = [13, 0, 7, 100, 1, 29]
    targets = S.exact_sizes(sum(sizes), 11)
    counts = spark.createDataFrame(list(enumerate(sizes)), "part int, n bigint")
    got = {r["part"]: r["sends"] for r in S.communication_matrix(counts, targets, 3).collect()}
    assert [sum(got[i]) for i in range(len(sizes))] == sizes
    assert [sum(got[i][j] for i in got) for j in range(11)] == targets
    assert min(x for r in got.values() for x in r) >= 0


def test_every_place_is_equally_likely(spark):
    frame = spark.range(40, numPartitions=5).withColumnRenamed("id", "k")
    firsts = Counter()
    for seed in range(12):
        out = S.shuffle_into_shards(frame, ["k"], n_shards=4, min_chunks=2, seed=seed)
        for r in out.collect():
            firsts[r["shard"], r["k"] // 20] += 1
    # 12 runs x 10 rows a shard: each half of the keys should hold about 60 of a shard's 120
    assert all(35 <= firsts[s, h] <= 85 for s in range(4) for h in (0, 1))


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "9 AS shard", "'y' AS shuffle_rank")
    out = S.shuffle_into_shards(docs, ["doc_id", "text"], n_shards=3).collect()
    assert sorted(Counter(r["shard"] for r in out).values()) == [2, 3, 3]
    assert {r["shuffle_rank"] for r in out} == {"y"}
    assert S.shuffle_into_shards(docs.limit(0), ["doc_id"], n_shards=3).count() == 0
    assert S.shuffle_into_shards(docs.limit(2), ["doc_id"], n_shards=8).count() == 2
