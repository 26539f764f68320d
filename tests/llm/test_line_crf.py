import itertools
import zlib

import numpy as np

from capgrid.llm import line_crf as C
from capgrid.llm.queries import QUERIES


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op9_line_crf_quality"](spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in rows.items())
    held = [(rows[i]["score"], y) for i, y in labels.items() if i in rows and rows[i]["held_out"]]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert len(bad) > 50
    assert np.mean([a > b for a in good for b in bad]) > 0.99
    assert np.mean([s < 0.3 for s in bad]) > 0.95 and np.mean([s >= 0.3 for s in good]) > 0.99


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    owner = np.array([0, 0, 0, 0, 2, 3, 3])
    good, transitions = rng.normal(size=7), rng.normal(size=(2, 2))
    forward, backward, total = C.forward_backward(good, owner, transitions)
    p = np.exp(forward[:, 1] + backward[:, 1] - total)
    for o in set(owner):
        lines = np.flatnonzero(owner == o)
        weights = {y: np.exp(sum(good[i] for i, v in zip(lines, y) if v) + sum(transitions[a, b] for a, b in zip(y, y[1:]))) for y in itertools.product((0, 1), repeat=len(lines))}
        for k, i in enumerate(lines):
            assert np.isclose(p[i], sum(w for y, w in weights.items() if y[k]) / sum(weights.values()))


def test_features_do_not_depend_on_the_batch():
    texts = [b"", b"One two two!\n\n  \nthree | four ###", b"\n", "É É ÀB cd".encode(), b"x\nx\nx"]
    owner, size, features = C.line_features(texts)
    assert owner.tolist() == [1, 1, 3, 4, 4, 4] and size.tolist() == [12, 16, 12, 1, 1, 1]
    for i, t in enumerate(texts):
        o, s, f = C.line_features([t])
        assert np.allclose(f, features[owner == i]) and (s == size[owner == i]).all()
    own = dict(zip(C.OWN, features[0]))
    assert np.isclose(own["bang"], 1 / 12) and np.isclose(own["repeated_words"], 0) and np.isclose(own["distinct_words"], 1)
    assert features[4][C.OWN.index("repeated_line")] == 1 and features[3][C.OWN.index("repeated_line")] == 0


def labelled(spark):
    docs = [(i, ("plain words in a line here\n" if i % 2 else "#### $$ %%% ###\n") * (3 + i % 5)) for i in range(80)]
    labels = [(i, i % 2, 0) for i in range(80)] + [(1, None, 0), (None, 1, 0)]
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_odd_rows(spark, odd_docs):
    docs, labels = labelled(spark)
    model = C.train(docs, labels)
    assert model.constant is None and abs(model.prior - 0.5) < 0.1
    scores = sorted(((r["id"], r["score"]) for r in C.score(odd_docs, model).collect()), key=repr)
    assert len(scores) == odd_docs.count()
    by_id = dict(scores)
    assert by_id[1] == by_id[2] == by_id[3] == model.prior
    assert C.score(odd_docs.limit(0), model).count() == 0
    kept = C.keep_good(docs.selectExpr("*", "1 AS id", "2 AS score"), model)
    assert kept.columns == ["doc_id", "text", "id", "score"] and {r["doc_id"] % 2 for r in kept.collect()} == {1}
    lines = C.line_labels(docs, model).collect()
    assert len(lines) == sum(3 + i % 5 for i in range(80))


def test_nothing_to_learn(spark):
    docs, labels = labelled(spark)
    assert C.train(docs, labels.limit(0)).constant == 0.5
    assert C.train(docs, labels.filter("quality = 1")).constant == 1.0
    assert C.train(docs.limit(0), labels).constant is not None


def test_held_out_labels_are_not_read(spark):
    docs, labels = labelled(spark)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic")
    one, two = C.train(docs, labels), C.train(docs, flipped)
    assert np.array_equal(one.weights, two.weights) and one.shift == two.shift


def test_sampled_texts_are_never_cut(spark, monkeypatch):
    docs, labels = labelled(spark)
    long = spark.createDataFrame([(101, "\n".join(f"line {i} of a long text" for i in range(500))), (103, None)], docs.schema)
    docs, labels = docs.unionAll(long), labels.unionAll(spark.createDataFrame([(101, 1, 0), (103, 1, 0)], labels.schema))
    seen = []
    real = C.fit
    monkeypatch.setattr(C, "fit", lambda features, owner, *rest: seen.append(np.bincount(owner)) or real(features, owner, *rest))
    C.train(docs, labels)
    assert seen[0].max() == 500 and seen[0].min() >= 3  # every line of the long text
    C.train(docs, labels, max_lines=600)  # half of it, 300, for a label: the long text stays out whole
    assert seen[1].max() == 7 and len(seen[1]) == len(seen[0]) - 1
