"""Hard negatives against all pairs: ties, repeated rows, odd vectors, clusters, small cells and seeds."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from capgrid.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, scale=256, positives=5, negatives=10, window=(30, 90)):
    usable = [(i, l, [math.floor(float(np.float32(c)) * scale) for c in v]) for i, v, l in rows if i is not None and l is not None and v is not None and all(c is not None and math.isfinite(c) and abs(c) <= 2**20 for c in v)]
    width = max((len(v) for _, _, v in usable), default=0)
    usable = [(i, l, v + [0] * (width - len(v))) for i, l, v in usable]
    anchors = {}
    for i, l, v in usable:
        if i % 100 == 0:
            anchors.setdefault(i, []).append((l, v))
    out = []
    for i, own in anchors.items():
        assert len(own) == 1
        label, vector = own[0]
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), j, l) for j, l, v in usable if j != i)
        for s, j, l in [x for x in scored if x[2] == label][:positives]:
            wanted = [(-t, k) for t, k, m in scored if m != label and window[0] * -s <= 100 * -t <= window[1] * -s][:negatives]
            out += [(i, j, r + 1, k, -s, t) for r, (t, k) in enumerate(wanted)]
    return sorted(out)


def mined(spark, rows, **more):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS cell", "3 AS score", "4 AS x")
    out = hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, F.col("label"), **more)
    return sorted(tuple(r) for r in out.collect())


def clustered(n, seed, labels=3, width=6, spread=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, width))
    vectors = centres[rng.integers(0, 5, n)] + spread * rng.standard_normal((n, width))
    return [(int(i) * 10, [float(c) for c in np.float32(v)], int(rng.integers(0, labels))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("spread,seed_rows,cell_rows", [(0.1, 4096, 256), (0.1, 8, 4), (1.0, 16, 4)])
def test_against_all_pairs(spark, monkeypatch, spread, seed_rows, cell_rows):
    monkeypatch.setattr(hard_negatives, "SEED", seed_rows)
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", cell_rows)
    rows = clustered(300, 5, spread=spread)
    assert mined(spark, rows) == brute(rows)


def test_small_blocks_and_packs(spark, monkeypatch):
    for name, value in (("SEED", 8), ("CELL_ROWS", 8), ("BLOCK", 7), ("PACK", 2)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = clustered(240, 6)
    assert mined(spark, rows) == brute(rows)


def test_ties_repeated_and_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(0, 2)) / 2 for _ in range(4)], rng.randint(0, 1)) for i in range(0, 900, 3)]
    rows += [(7, [1.0, 0.0, 0.5, 0.5], 0)] * 3 + [(8, [0.5], 1), (9, [], 0), (1100, [-1.0, -1.0, -1.0, -1.0], 5), (1200, [0.0] * 4, 6)]
    rows += [(2000, None, 0), (2001, [1.0, None, 0.0, 0.0], 1), (2100, [float("nan")] * 4, 1), (2200, [float("-inf")] * 4, 0), (2300, [1.0] * 4, None), (None, [1.0] * 4, 0), (2400, [1e30] * 4, 0)]
    assert mined(spark, rows) == brute(rows)


def test_one_vector_holds_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    rows = clustered(200, 8) + [(5000 + i, [1.0, 0.5, 0.25, 0.0, 0.0, 0.0], i % 3) for i in range(1, 100)]
    assert mined(spark, rows) == brute(rows)


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0, 2.0], 1)]) == []
    assert mined(spark, [(100, [1.0, 2.0], 1), (101, [1.0, 2.0], 1)]) == []
    assert mined(spark, [(100, [0.0, 0.0], 1), (101, [0.0, 1.0], 1), (102, [1.0, 0.0], 2)]) == [(100, 101, 1, 102, 0, 0)]
    assert mined(spark, [(1, None, 1)]) == []


def test_the_heap_falls_and_its_bounds_hold():
    rng = np.random.default_rng(1)
    x = np.floor(rng.standard_normal((400, 8)) * 100)
    books = hard_negatives.codebook(x[:, :4], 6), hard_negatives.codebook(x[:, 4:], 6)
    codes = [hard_negatives._squares(p, b).argmin(1) for p, b in zip((x[:, :4], x[:, 4:]), books)]
    far = [np.linalg.norm(p - b[c], axis=1) + 1e-6 for p, b, c in zip((x[:, :4], x[:, 4:]), books, codes)]
    cells = {}
    for r in range(400):
        cells.setdefault(int(codes[0][r] * 6 + codes[1][r]), []).append(r)
    multi = hard_negatives.MultiIndex(8, books, [(c, len(m), far[0][m].max(), far[1][m].max()) for c, m in cells.items()])
    for a in x[:20]:
        high, low = multi.bounds(a)
        seen = list(multi.visit(high))
        assert [b for b, _, _ in seen] == sorted((b for b, _, _ in seen), reverse=True)
        assert {i * 6 + j for _, i, j in seen} == set(cells)
        for bound, i, j in seen:
            scores = x[cells[i * 6 + j]] @ a
            assert scores.max() <= bound and scores.min() >= low[0][i] + low[1][j]


def test_products_are_exact():
    a = np.array([[2.0**28, 1.0, -(2.0**28)], [3.0, 5.0, 7.0]])
    assert hard_negatives._products(a, a)[0, 0] == 2**57 + 1
    wide = np.full((1, 200), 2.0**27)
    assert hard_negatives._products(wide, wide)[0, 0] == 200 * 2**54
