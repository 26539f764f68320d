import random
import unicodedata
import zlib

import numpy as np
import pytest

from capgrid.llm import packing as P
from capgrid.llm.queries import QUERIES, vocabulary_path


def check(rows, ids_of, window=1024):
    """Every id in exactly one piece; offsets gapless; sequences within the window."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, parts in by_doc.items():
        ids = ids_of[doc]
        copies = sum(r["start"] == 0 for r in parts)
        parts = sorted(parts, key=lambda r: r["start"])
        at = 0
        for r in parts[::copies]:
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    assert set(by_sequence) == set(range(len(by_sequence)))
    return len(by_sequence)


def tokens(texts):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_file(vocabulary_path())
    return [tok.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def test_query_packs_every_id_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    ids = dict(zip([d["doc_id"] for d in docs], tokens([d["text"] for d in docs])))
    rows = QUERIES["op5_sequence_packing"](spark, sf).collect()
    n = check(rows, ids)
    assert {r["doc_id"] for r in rows} == set(ids)
    assert sum(map(len, ids.values())) / (n * 1024) > 0.98


def test_encoder_equals_tokenizer():
    encode = P.encoder(vocabulary_path())
    texts = ["", "a", " " * 3000 + "x", "it's<|endoftext|>we'll  \n\n y", "é" * 500, "word two\n" * 300, "١٢٣ 日本語 \U0001f600"]
    assert [encode(t) + [0] for t in texts] == tokens(texts)


def test_encoder_equals_tokenizer_over_all_unicode_classes():
    """Every assigned code point once beside letters, digits, marks and blanks, and random mixes of all general categories."""
    encode = P.encoder(vocabulary_path())
    classes = {}
    for c in range(0x110000):
        if (kind := unicodedata.category(chr(c))) not in ("Cs", "Cn", "Co"):
            classes.setdefault(kind, []).append(chr(c))
    everything = [c for chars in classes.values() for c in chars]
    frames = ["a{}b", " {}", "1{}2", "{} ", "'{}s", "\n{}\n\n", "-{}{}-"]
    texts = ["".join(frames[(i + k) % len(frames)].format(c, c) for k, c in enumerate(everything[i : i + 500])) for i in range(0, len(everything), 500)]
    rng = random.Random(0)
    kinds = sorted(classes)
    texts += ["".join(rng.choice(classes[rng.choice(kinds)]) * rng.choice((1, 1, 2, 5)) for _ in range(200)) for _ in range(300)]
    assert [encode(t) + [0] for t in texts] == tokens(texts)


def test_long_texts_are_cut_without_changing_ids(monkeypatch):
    encode = P.encoder(vocabulary_path())
    texts = ["lorem ipsum dolor, sit 12 amet\n" * 100, "x" * 3000, "a  b " * 500]
    whole = [encode(t) for t in texts]
    monkeypatch.setattr(P, "ENCODE_CHARS", 50)
    assert [encode(t) for t in texts] == whole


def test_white_space_runs_of_any_length():
    encode = P.encoder(vocabulary_path())
    for n in (1_000_000, 3_000_000):
        for blank in (" ", "\n"):
            run = blank * n
            assert encode(run + "x") + [0] == tokens([run + "x"])[0]
            assert encode("a" + run) + [0] == tokens(["a" + run])[0]


def test_white_space_runs_inside_texts():
    encode = P.encoder(vocabulary_path())
    n = P.RUN_CHARS
    runs = [" " * n, "\n" * (n + 1), " \u3000\t\x85" * n, "\x1c" * n, " " * (n - 1) + "\n"]
    texts = [f"one{a}two, it{b}'s{a}<|endoftext|>{b}12{b}<|endoftext|>" for a in runs for b in runs]
    assert [encode(t) + [0] for t in texts] == tokens(texts)


def test_odd_rows(spark, odd_docs):
    rows = P.pack(odd_docs, vocabulary_path(), with_ids=True).withColumnRenamed("id", "doc_id").collect()
    docs = odd_docs.collect()
    ids = dict(zip([d["doc_id"] for d in docs], tokens([d["text"] for d in docs])))
    check(rows, ids)
    assert sum(len(r["ids"]) for r in rows) == sum(len(ids[d["doc_id"]]) for d in docs)
    assert P.pack(odd_docs.limit(0), vocabulary_path()).count() == 0
    check(P.pack(odd_docs, vocabulary_path(), group_rows=2).withColumnRenamed("id", "doc_id").collect(), ids)  # full windows under many salts


def test_salts_grow_with_the_pieces():
    histogram = np.array([0, 5, 0, P.GROUP_ROWS + 1, 10**11])
    assert P.salts_by_length(histogram[:4]).tolist() == [1, 1, 1, 2]
    salts = P.salts_by_length(histogram)
    assert salts[-1] >= 0.99 * P.GROUPS and salts.sum() <= P.GROUPS + 2 * len(histogram)


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(0)
    for window in (8, 64):
        for _ in range(20):
            histogram = rng.integers(0, 50, window + 1) * (rng.random(window + 1) < 0.5)
            histogram[0] = 0
            used = np.zeros(window + 1, np.int64)
            for lengths, n in P.plan(histogram, window):
                assert sum(lengths) <= window and n > 0
                np.add.at(used, list(lengths), n)
            assert (used == histogram).all()


def test_least_squares_meets_a_solvable_histogram():
    combos = P.combinations(64, np.arange(1, 64))
    assert (combos.sum(1) == 64).all() and len({tuple(sorted(c)) for c in combos.tolist()}) == len(combos)
    x = np.zeros(len(combos))
    x[::7] = 5.0
    target = np.bincount(combos[combos > 0], weights=x[np.nonzero(combos > 0)[0]], minlength=65)
    y = P.least_squares(combos, target)
    got = np.bincount(combos[combos > 0], weights=y[np.nonzero(combos > 0)[0]], minlength=65)
    assert (y >= 0).all() and np.abs(got - target).max() < 0.02 * target.max()
