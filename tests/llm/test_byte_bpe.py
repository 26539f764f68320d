"""Byte-level BPE: every result against the tiktoken library, round trips, appends, edits, odd rows."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from capgrid.llm import byte_bpe
from capgrid.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = byte_bpe.read_ranks(open(PATH, "rb").read())
VOCABULARY = byte_bpe.Vocabulary(RANKS, PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
SIGNS = ["a", "b", "e", " ", "  ", "\n", "\t", "é", "日", "本", "🙂", "'", "'ll", "the", "ing", "0", "19", ".", "!", "ß", "́", " ", "\x85", "\x1c", " ", "²", "ª"]


def ids(text):
    return np.frombuffer(byte_bpe._encoded(VOCABULARY, text), np.int32).tolist()


@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(SIGNS), max_size=40).map("".join)))
@settings(max_examples=600, deadline=None)
def test_ids_are_the_librarys(text):
    got = ids(text)
    assert got == LIBRARY.encode_ordinary(text)
    assert b"".join(VOCABULARY.tokens[i] for i in got) == text.encode()


@given(st.lists(st.sampled_from(sorted(RANKS)), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_pieces_of_tokens_follow_the_definition(tokens):
    data = b"".join(tokens)
    table = byte_bpe.PrefixTable(VOCABULARY)
    table.append(data)
    assert table.ids() == VOCABULARY.merged(data)
    for n in range(1, len(data)):  # the last token of each prefix is that of its own encoding
        assert table.last[n - 1] == VOCABULARY.merged(data[:n])[-1]


def test_pairs_by_their_merges_follow_the_definition():
    rng = random.Random(4)
    for k in range(20_000):
        a, b = rng.randrange(600 if k % 3 else len(RANKS)), rng.randrange(len(RANKS) if k % 2 else 3000)
        assert VOCABULARY.valid_pair(a, b) == (VOCABULARY.merged(VOCABULARY.tokens[a] + VOCABULARY.tokens[b]) == [a, b])


def test_other_vocabularies():
    """Small vocabularies with ties, several ways to one token, and tokens that merges do not reach."""
    rng = random.Random(9)
    for _ in range(150):
        ranks = {bytes([c]): c for c in range(256)}
        while len(ranks) < 256 + rng.randint(0, 14):
            known = [t for t in ranks if t in (b"a", b"b", b"c") or len(t) > 1]
            ranks.setdefault(rng.choice(known) + rng.choice(known), len(ranks))
        own = byte_bpe.Vocabulary(ranks, PATTERN)
        for _ in range(20):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 24)))
            assert own.encode_piece(data) == ([ranks[data]] if data in ranks else own.merged(data)), (ranks, data)


@pytest.mark.parametrize("text", [" " * 1_000_000 + "x", "\n" * 200_000, "ab" * 200_000, "日本" * 50_000, "=" * 100_000, "word " * 300_000])
def test_very_long_runs(text):
    got = ids(text)
    assert b"".join(VOCABULARY.tokens[i] for i in got) == text.encode()
    if len(text) <= 100_000 or " w" in text:
        assert got == LIBRARY.encode_ordinary(text)


@given(st.lists(st.sampled_from(SIGNS), max_size=30).map("".join), st.lists(st.sampled_from(SIGNS), max_size=5).map("".join), st.data())
@settings(max_examples=500, deadline=None)
def test_edits_and_appends_are_exact(text, new, data):
    start = data.draw(st.integers(0, len(text)))
    stop = data.draw(st.integers(start, len(text)))
    edited = byte_bpe.EncodedText(VOCABULARY, text)
    edited.replace(start, stop, new)
    fresh = byte_bpe.EncodedText(VOCABULARY, text[:start] + new + text[stop:])
    assert (edited.text, edited.lengths, edited.piece_ids) == (fresh.text, fresh.lengths, fresh.piece_ids)
    edited.append(new)
    assert edited.piece_ids == byte_bpe.EncodedText(VOCABULARY, fresh.text + new).piece_ids
    table, other = byte_bpe.PrefixTable(VOCABULARY), byte_bpe.PrefixTable(VOCABULARY)
    table.append(text.encode())
    a, b = len(text[:start].encode()), len(text[:stop].encode())
    table.replace(a, b, new.encode())
    other.append((text[:start] + new + text[stop:]).encode())
    assert table.last == other.last and table.data == other.data


def test_an_edit_costs_its_surroundings_only():
    text = byte_bpe.EncodedText(VOCABULARY, "some words here " * 5_000)
    text.replace(40_000, 40_001, "Q")
    assert text.encoded <= 8
    table = byte_bpe.PrefixTable(VOCABULARY)
    table.append(b"somewordshere" * 5_000)
    before = table.computed
    table.replace(30_000, 30_001, b"Q")
    assert table.computed - before <= 8 * VOCABULARY.longest
    table.append(b"more")
    assert table.ids() == VOCABULARY.encode_piece(table.data)


def test_query_against_the_library(spark, sf):
    rows = {r["doc_id"]: r for r in QUERIES["op12_prefix_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        text, r = d["text"] or "", rows[d["doc_id"]]
        want = LIBRARY.encode_ordinary(text)
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_documents(spark, odd_docs):
    out = byte_bpe.decode(byte_bpe.encode(odd_docs, PATH, PATTERN), PATH).collect()
    want = sorted((str(r["doc_id"]), tuple(LIBRARY.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in odd_docs.collect())
    assert sorted((str(r["id"]), tuple(r["ids"]), bytes(r["decoded"])) for r in out) == want
    empty = odd_docs.limit(0)
    assert byte_bpe.decode(byte_bpe.encode(empty, PATH, PATTERN), PATH).count() == 0


def test_bytes_that_are_not_utf8(spark):
    frame = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF62') AS string) AS text")
    row = byte_bpe.decode(byte_bpe.encode(frame, PATH, PATTERN), PATH).first()
    assert row["ids"] == LIBRARY.encode_ordinary("a�b") and bytes(row["decoded"]) == "a�b".encode()


def test_unknown_ids_do_not_decode(spark):
    frame = spark.createDataFrame([(1, [0, 50_255]), (2, [60_000]), (3, [-1]), (4, [None, 5]), (5, None), (6, [])], "id long, ids array<int>").selectExpr("*", "0 AS decoded")
    out = {r["id"]: r["decoded"] for r in byte_bpe.decode(frame, PATH).collect()}
    assert bytes(out[1]) == VOCABULARY.tokens[0] + VOCABULARY.tokens[50_255] and bytes(out[6]) == b""
    assert out[2] is out[3] is out[4] is out[5] is None


def test_stored_texts_are_encoded_again_near_their_edits(spark):
    old = [(1, "a long text of words " * 2_000), (2, "unchanged"), (3, ""), (4, None), (5, "goes")]
    new = [(1, "a long text of words " * 1_000 + "edited " + "a long text of words " * 1_000 + "and more"), (3, "now there's text"), (4, "x"), (5, None), (9, "unknown")]
    stored = byte_bpe.encode(spark.createDataFrame(old, "doc_id long, text string"), PATH, PATTERN, pieces=True)
    out = {r["id"]: r for r in byte_bpe.re_encode(stored, spark.createDataFrame(new, "doc_id long, text string"), PATH, PATTERN).collect()}
    texts = dict(old) | {i: t for i, t in new if i != 9}
    assert set(out) == set(texts)
    for i, text in texts.items():
        assert out[i]["text"] == (text or "") and out[i]["ids"] == LIBRARY.encode_ordinary(text or "")
        assert sum(out[i]["piece_chars"]) == len(text or "") and sum(out[i]["piece_tokens"]) == len(out[i]["ids"])
    assert out[2]["n_encoded"] == 0 and 0 < out[1]["n_encoded"] < 10_010 and out[3]["n_encoded"] == 4
