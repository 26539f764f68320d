"""Whitening: eigen steps against NumPy, the query against its definition, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from capgrid.llm import whitening
from capgrid.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>"


def expected(vectors):
    """x, n, S, deviations, covariance by the contract's words, in unbounded integers and doubles."""
    x = np.floor(np.array(vectors, float) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    exact = (x.astype(object) * n) - s
    centred = (exact / n).astype(float)
    return centred, [int((row * row).sum()) for row in exact], centred.T @ centred / n


@pytest.mark.parametrize("n,k", [(1, 1), (2, 2), (3, 2), (40, 12), (64, 32)])
@pytest.mark.parametrize("kind", ["random", "identity", "repeated", "nearly", "whole"])
def test_leading_pairs_against_numpy(n, k, kind):
    rng = np.random.default_rng(n)
    if kind in ("random", "whole"):
        a = rng.standard_normal((2 * n, n))
        m = a.T @ a if kind == "random" else np.round(3 * a).T @ np.round(3 * a)
    elif kind == "identity":
        m = 3 * np.eye(n)
    else:
        q = np.linalg.qr(rng.standard_normal((n, n)))[0]
        values = np.repeat(np.arange(n, 0, -1), 4)[:n] + (1e-13 * np.arange(n) if kind == "nearly" else 0)
        m = q @ np.diag(values.astype(float)) @ q.T
        m = (m + m.T) / 2
    values, vectors = whitening.leading(m, k)
    size = np.abs(m).max()
    assert np.abs(values - np.linalg.eigvalsh(m)[::-1][:k]).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() <= 1e-12
    assert np.abs(m @ vectors - vectors * values).max() <= 1e-13 * size


def test_sturm_counts():
    rng = np.random.default_rng(1)
    d, e = rng.standard_normal(30), rng.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.concatenate([(values[1:] + values[:-1]) / 2, [-100, 100]])
    assert (whitening.below(d, e * e, at, 1e-30) == [(values < a).sum() for a in at]).all()


def test_query_on_the_whole_table(spark, sf):
    rows = QUERIES["op11_embedding_whitening"](spark, sf).toPandas()
    source = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").toPandas()
    centred, deviations, v = expected(source["embedding"].tolist())
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    got = rows.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = centred @ vectors / np.sqrt(values)
    want *= np.sign((got * want).sum(0))
    assert np.abs(got - want).max() < 1e-8
    assert rows.groupby("vec_id")["deviation"].first().tolist() == deviations
    assert np.allclose(rows.groupby("component")["explained"].first(), values / np.trace(v), rtol=1e-10)
    assert set(rows["n"]) == {len(source)} and rows["identity_error"].nunique() == 1 and rows["identity_error"][0] < 1e-10
    assert np.abs(got.T @ got / len(got) - np.eye(32)).max() < 1e-10


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [[float(c) for c in row] for row in rng.standard_normal((30, 4)).astype(np.float32)]
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(None, good[0]), (3, good[3]), (3, good[3]), (50, [0.5, 0.25]), (51, [])]
    left_out = [(60, None), (61, [1.0, None, 0.0, 0.0]), (62, [float("nan")] * 4), (63, [float("inf"), 0.0, 0.0, 0.0]), (64, [1e30, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows + left_out, SCHEMA).selectExpr("*", "1 AS id", "2 AS vector", "3 AS n")
    out = whitening.whiten(frame, components=3).toPandas()
    padded = [v + [0.0] * (4 - len(v)) for _, v in rows]
    centred, deviations, v = expected(padded)
    assert len(out) == len(rows) and set(out["n"]) == {len(rows)}
    assert sorted(out["deviation"]) == sorted(deviations)
    assert out["id"].isna().sum() == 1 and (out["id"] == 3).sum() == 3
    got = np.array(out["whitened"].tolist())
    assert np.abs(got.T @ got / len(got) - np.eye(3)).max() < 1e-10
    assert np.allclose(out["explained"][0], np.linalg.eigvalsh(v)[::-1][:3] / np.trace(v), rtol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]])
def test_nothing_to_scale(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_flat_directions_are_left_out(spark):
    rows = [(i, [float(i % 7), 2.0 * (i % 7), 1.0]) for i in range(21)]  # one direction varies
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert {len(w) for w in out["whitened"]} == {1} and abs(out["explained"][0][0] - 1) < 1e-9


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(0, [0.0]), (1, [2.0**40]), (2, [-(2.0**40)])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = {r["id"]: r["deviation"] for r in whitening.whiten(frame).collect()}
    assert out[0] == 0 and out[1] is None and out[2] is None


def test_partitions_do_not_matter(spark, sf):
    frame = spark.read.parquet(f"{sf}/embeddings.parquet")
    one, many = (whitening.whiten(f).select("id", F.abs(F.col("whitened")[0]).alias("w")).orderBy("id").toPandas() for f in (frame.coalesce(1), frame.repartition(13)))
    assert np.allclose(one["w"], many["w"], atol=1e-8)
