import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from capgrid.llm import decontam as D
from capgrid.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    wins = {}
    for item, text in items:
        w = split(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            wins.setdefault(tuple(w[i : i + size]), set()).update({str(item)} if item is not None else ())
    out = []
    for doc, text in docs:
        w = split(text)
        hit, found = set(), set()
        for size in {len(k) for k in wins}:
            for i in range(len(w) - size + 1):
                ids = wins.get(tuple(w[i : i + size]))
                if ids is not None:
                    hit |= set(range(i, i + size))
                    found |= ids
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def digest(scanned):
    return sorted((tuple(r) for r in scanned.select("id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), F.col("n_hit") > 0).collect()), key=repr)


def rows(frame, *columns):
    return [tuple(r[c] for c in columns) for r in frame.collect()]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted((tuple(r) for r in QUERIES["op6_benchmark_hits"](spark, sf).collect()), key=repr)
    docs = rows(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")
    assert got == brute(docs, rows(spark.read.parquet(f"{sf}/benchmark.parquet"), "item_id", "text"))
    assert any(g[5] for g in got)


ITEMS = [(1, "one two three"), (2, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (3, None), (4, " ... "), (None, "null item words"), (2, "again and again"), (30, "ipsum dolor lorem"), (5, "wörds et ponctuation")]


def test_odd_rows_and_short_items(spark, odd_docs):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    extra = spark.createDataFrame([(20, "zero ONE, two... three one two three four"), (21, "alpha beta gamma delta epsilon zeta eta theta iota kappa x lambda"), (22, "a null item words b")], "doc_id bigint, text string")
    docs = odd_docs.select("doc_id", "text").unionAll(extra)
    want = brute(rows(docs, "doc_id", "text"), ITEMS)
    assert digest(D.scan(docs, bench)) == want
    assert digest(D.scan(docs, bench, max_bytes=60)) == want  # several blocks


def test_hash_collisions_do_not_count(monkeypatch):
    index = D.Index([("1", b"a b c")], 10)
    monkeypatch.setattr(D, "window_hashes", lambda h, size: index.sizes[3][1].repeat(len(h) - size + 1))
    n_words, items, runs, _ = index.scan([b"x a b c y", b"q r s"])
    assert list(n_words) == [5, 3] and items == [["1"], []] and runs == [[(1, 3)], []]


def test_remove_documents_and_spans(spark, odd_docs):
    bench = spark.createDataFrame([(1, "again and again"), (2, "Ünïcode wörds")], "item_id bigint, text string")
    kept = D.decontaminate(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4]
    blocks = D.decontaminate(odd_docs, bench, max_bytes=20)
    assert blocks.columns == odd_docs.columns and sorted(r["doc_id"] for r in blocks.collect()) == [1, 2, 3, 4]
    for limit in (1 << 20, 20):
        cut = {r["doc_id"]: r["text"] for r in D.decontaminate(odd_docs, bench, remove="spans", max_bytes=limit).collect()}
        assert cut[5] == "same words here " and cut[6] == " « et » ponctuation" and cut[1] is None and cut[2] == ""


def test_empty_tables(spark, odd_docs):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_hit"] for r in D.scan(odd_docs, bench).collect()} == {0}
    assert D.decontaminate(odd_docs, bench).count() == odd_docs.count()
    assert D.scan(odd_docs.limit(0), bench).count() == 0


def test_index_is_bounded_and_shared_windows_name_all_items():
    rng = np.random.default_rng(0)
    items = [(str(i), b" ".join(b"w%d" % v for v in rng.integers(0, 50_000, 300))) for i in range(1400)]
    items += [("x", items[7][1]), ("y", b"W1, " + items[7][1]), (None, items[7][1])]
    index = D.Index(items, 10)
    assert index.resident() < 4 * sum(len(t) for _, t in items)
    _, found, runs, _ = index.scan([b"zzz " + items[7][1] + b" zzz", b" ".join(items[9][1].split()[:9])])
    assert found == [["7", "x", "y"], []] and runs == [[(1, 300)], []]
