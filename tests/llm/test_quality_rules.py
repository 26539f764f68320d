import math
import re
from collections import Counter

import pytest

from pyspark.sql import functions as F

from capgrid.llm import line_crf
from capgrid.llm import quality_rules as Q
from capgrid.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_rules(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


def grams(text):
    w = WORD.findall(text or "")
    return w + list(zip(w, w[1:]))


def brute_scores(docs, trusted, bucket, buckets):
    """Mean log ratio of each text, with `bucket` giving a gram's bucket."""
    raw, target = Counter(), Counter()
    for doc, text in docs:
        for g in grams(text):
            raw[bucket[g]] += 1
            target[bucket[g]] += doc in trusted
    t, r = sum(target.values()), sum(raw.values())
    ratio = lambda b: math.log((target[b] + 1) / (t + buckets)) - math.log((raw[b] + 1) / (r + buckets)) if t else 0.0
    return [sum(ratio(bucket[g]) for g in grams(text)) / max(1, len(grams(text))) for _, text in docs]


RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def buckets_of(spark, docs, buckets):
    """Buckets by Spark's own hash, for the brute-force sums."""
    every = {g for _, t in docs for g in grams(t)}
    words = sorted(w for w in every if isinstance(w, str))
    pairs = sorted(p for p in every if not isinstance(p, str))
    out = {r[0]: r[1] for r in spark.createDataFrame([(w,) for w in words] or [("",)], "w string").selectExpr("w", f"pmod(xxhash64(w), {buckets})").collect()}
    for r in spark.createDataFrame(pairs or [("", "")], "a string, b string").selectExpr("a", "b", f"pmod(xxhash64(xxhash64(a), xxhash64(b)), {buckets})").collect():
        out[r[0], r[1]] = r[2]
    return out


def test_query_matches_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()}
    rows = {r["doc_id"]: r for r in QUERIES["op3_quality_rules"](spark, sf).collect()}
    scores = brute_scores(docs, trusted, buckets_of(spark, docs, Q.BUCKETS), Q.BUCKETS)
    for (doc, text), score in zip(docs, scores):
        assert tuple(rows[doc][c] for c in RULES) == brute_rules(text)
        assert rows[doc]["score"] == pytest.approx(score, rel=1e-9, abs=1e-12)
        assert rows[doc]["kept"] == (not rows[doc]["base_failed"] and rows[doc]["score"] >= Q.THRESHOLD)


def test_odd_rows(spark, odd_docs, words):
    texts = [words(1, 200), words(2, 200) + "\n" + words(3, 60), "a b c a b c", "a b", "x\n \nx\n\ty\nx", "é#ü <|> " * 30, "  lead and trail  ", words(4, 60) + "  end"]
    docs = odd_docs.select("doc_id", "text").unionAll(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"))
    trusted = spark.createDataFrame([(100,), (101,), (101,), (None,), (5,)], "doc_id bigint")
    key = lambda r: repr(r)
    got = sorted(((r["id"], *(r[c] for c in RULES), round(r["score"], 9)) for r in Q.evaluate(docs, trusted, buckets=64).collect()), key=key)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    scores = brute_scores(rows, {100, 101, 5}, buckets_of(spark, rows, 64), 64)
    assert got == sorted(((d, *brute_rules(t), round(s, 9)) for (d, t), s in zip(rows, scores)), key=key)


def test_empty_tables(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id bigint")
    assert {r["score"] for r in Q.evaluate(odd_docs, none).collect()} == {0.0}
    assert Q.evaluate(odd_docs.limit(0), none).count() == 0


def test_threshold_separates_held_out_labels(spark):
    """Neither the threshold nor the target has seen the labels it is held against."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(16)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    others = labels.filter(~line_crf.in_fold(F.col("doc_id")))
    assert abs(Q.separating_threshold(docs, others) - Q.THRESHOLD) < 0.02
    quality = {r["doc_id"]: r["quality"] for r in labels.filter(line_crf.in_fold(F.col("doc_id"))).collect()}
    rows = [r for r in Q.evaluate(docs, others.filter("quality = 1")).select("id", "kept", "base_failed").collect() if r["id"] in quality and not r["base_failed"]]
    good, bad = ([r["kept"] for r in rows if quality[r["id"]] == q] for q in (1, 0))
    assert len(good) > 500 and sum(good) / len(good) > 0.99
    assert len(bad) > 50 and sum(bad) / len(bad) < 0.05


def test_threshold_needs_both_labels(spark, odd_docs):
    with pytest.raises(ValueError):
        Q.separating_threshold(odd_docs, spark.createDataFrame([(5, 1)], "doc_id bigint, quality int"))
