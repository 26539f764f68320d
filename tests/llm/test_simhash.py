import random
import re

import numpy as np
import xxhash

from capgrid.llm import simhash as S
from capgrid.llm.queries import QUERIES


def brute_print(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=4):
    """Smallest id reachable for each (id, text) row, by union-find over all pairs."""
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    out = []
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((rows[i][0], f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


def test_fingerprint_matches_definition():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["a", "B", "É", " ", "\n", "  ", "\t", "\x1c", "\x0b", "x y"]) for _ in range(rng.randrange(60)))
        for shingle in (1, 4):
            assert S.fingerprint(text.encode(), shingle) == brute_print(text, shingle)


def test_every_close_pair_shares_a_key():
    """Pigeonring: any two values within the distance agree on some listed set of segments."""
    rng = random.Random(2)
    for distance, exact in ((4, 2), (4, 3), (4, 4), (3, 3), (6, 2)):
        sets = [same for _, same in S.exact_sets(distance, exact)]
        for _ in range(3000):
            flips = 0
            for b in rng.sample(range(64), distance):
                flips |= 1 << b
            assert any(all(not flips >> (S.WIDTH * s) & 255 for s in same) for same in sets)


def test_pruned_distance_equals_full_distance():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, dtype=np.uint64)
    values = np.array([int(base) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for _ in range(2000)], np.uint64)
    assert (S._within(base, values, 4) == (np.bitwise_count(values ^ base) <= 4)).all()


def test_forest_keeps_components():
    rng = np.random.default_rng(4)
    members = np.unique(np.array([sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 9), replace=False)) for _ in range(300)], np.uint64))
    edges = S.forest(members, 2)
    assert len(edges) < len(members)
    parent = {int(m): int(m) for m in members}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        assert (a ^ b).bit_count() <= 2
        parent[root(a)] = root(b)
    for a in map(int, members):
        for b in map(int, members):
            if (a ^ b).bit_count() <= 2:
                assert root(a) == root(b)


def test_components_match_brute_force(spark, sf):
    got = sorted((tuple(r) for r in QUERIES["op7_simhash_components"](spark, sf).collect()), key=repr)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got == brute_components(rows)
    assert len({g[2] for g in got}) < len(got)


def test_odd_rows(spark, odd_docs):
    got = sorted(((r["id"], f"{r['fingerprint'] & (1 << 64) - 1:016x}", r["component_id"]) for r in S.components(odd_docs).collect()), key=repr)
    assert got == brute_components([(r["doc_id"], r["text"]) for r in odd_docs.collect()])


def test_deduplicate_keeps_one_row_of_each_group(spark, odd_docs):
    kept = S.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 4, 5, 6]
    nulls = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (None, None)], "doc_id bigint, text string")
    assert S.deduplicate(nulls).count() == 2


def test_empty_table(spark, odd_docs):
    none = odd_docs.limit(0)
    assert S.components(none).count() == 0
    assert S.deduplicate(none).count() == 0


def test_large_keys_are_compared_block_by_block(spark):
    rng = random.Random(5)
    base = rng.getrandbits(63)
    values = sorted({base ^ sum(1 << b for b in rng.sample(range(16), rng.randrange(7))) for _ in range(400)})
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")

    def roots(max_members):
        found = S.stars(S.links(frame, 2, 3, max_members)).collect()
        return {r["node"]: r["root"] for r in found}

    assert roots(7) == roots(10_000)
    assert len(set(roots(7).values())) >= 1
