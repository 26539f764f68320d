"""SimHash near-duplicates with a pigeonring filter.

Fingerprints: XXH64 (seed 42) of every shingle of lower-cased, white-space
separated words; a bit is one when over half the shingle hashes have it.

Candidates: the 64 bits lie on a ring of `SEGMENTS` segments.  If two
fingerprints differ in at most d bits, some start on the ring has, for every
chain length l, at most floor(l * d / SEGMENTS) differing bits in its first l
segments (pigeonring principle).  So the number of segments that differ at
all obeys the same budgets, which leaves a fixed list of segment sets of
which one must agree exactly; each set is a join key.  Within a key the whole
chain of budgets is checked before the full Hamming distance.

Links inside a key are emitted as a spanning forest, never as all pairs.  Keys
with more members than `max_members` are split into blocks, and every pair of
blocks is compared in a task of its own, so no link is lost.

Defined results.  Null and empty texts and texts without words have
fingerprint zero and link like any other.  A null id never becomes a component
id unless the whole component has only null ids (then null).  Repeated rows
each keep their row.  Empty input gives empty output.  Columns other than the
id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from capgrid.llm import common, textscan

SEGMENTS = 8
WIDTH = 64 // SEGMENTS
SEED = 42
SHINGLE_BLOCK = 1 << 16
#: Members of a join key that are compared in one task; keys with more go block by block.
MAX_MEMBERS = 4096


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one UTF-8 text, hashed a block of shingles at a time."""
    raw = text.lower()
    buffer = np.frombuffer(raw, np.uint8)
    starts, ends = textscan.spans(buffer, textscan.NONSPACE)
    n = len(starts)
    if not n:
        return 0
    if len(raw) != int((ends - starts).sum()) + n - 1 or textscan.byte_class((0x09, 0x0D))[buffer].any():
        word = textscan.NONSPACE[buffer]
        after = np.zeros(len(buffer), bool)
        after[ends[:-1]] = True
        normal = buffer[word | after].copy()
        lengths = ends - starts
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        normal[ends[:-1]] = 0x20
        raw = normal.tobytes()
    if n <= shingle:
        first, last = starts[:1], ends[-1:]
    else:
        first, last = starts[: n - shingle + 1], ends[shingle - 1 :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, len(first), SHINGLE_BLOCK):
        block = [digest(raw[a:b], SEED) for a, b in zip(first[i : i + SHINGLE_BLOCK].tolist(), last[i : i + SHINGLE_BLOCK].tolist())]
        bits = np.unpackbits(np.array(block, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(first))))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint BIGINT, text_key BIGINT), one row per input row; text_key is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(batch.num_rows, np.uint64)
            for at, texts in common.byte_lists(batch.column(1), 1 << 22):
                out[at : at + len(texts)] = [fingerprint(t, shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out.view(np.int64))], ["id", "text_key", "fingerprint"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("text_key"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, text_key bigint, fingerprint bigint")


def exact_sets(distance: int, exact: int) -> list[tuple[int, tuple[int, ...]]]:
    """(start, segments that must agree) for every way a chain from a start can reach `exact` agreeing segments within its budgets."""
    if exact > SEGMENTS - distance:
        raise ValueError(f"at {distance} bits only {SEGMENTS - distance} segments are sure to agree")
    found: dict[tuple[int, ...], int] = {}

    def grow(start: int, length: int, same: tuple[int, ...]) -> None:
        if len(same) == exact:
            found.setdefault(tuple(sorted(same)), start)
            return
        if length == SEGMENTS:
            return
        grow(start, length + 1, (*same, (start + length) % SEGMENTS))
        if length + 1 - len(same) <= (length + 1) * distance // SEGMENTS:
            grow(start, length + 1, same)

    for start in range(SEGMENTS):
        grow(start, 0, ())
    return [(start, same) for same, start in sorted(found.items())]


def _segment_key(fp: Column, number: int, same: tuple[int, ...]) -> Column:
    key = F.lit(number).cast("long")
    for s in same:
        key = F.shiftleft(key, WIDTH).bitwiseOR(F.shiftrightunsigned(fp, WIDTH * s).bitwiseAND(F.lit((1 << WIDTH) - 1).cast("long")))
    return key


def _within(one: np.ndarray, many: np.ndarray, distance: int) -> np.ndarray:
    """Pigeonring check, then the full distance, of `one` against `many` (broadcast shapes)."""
    x = np.bitwise_xor(one, many)
    parts = [np.bitwise_count((x >> np.uint64(WIDTH * s)) & np.uint64((1 << WIDTH) - 1)) for s in range(SEGMENTS)]
    possible = np.zeros(x.shape, bool)
    for start in range(SEGMENTS):
        total, chain = np.zeros(x.shape, np.uint8), np.ones(x.shape, bool)
        for length in range(1, 4):  # three budgets prune most; the full distance decides
            total = total + parts[(start + length - 1) % SEGMENTS]
            chain &= total <= length * distance // SEGMENTS
        possible |= chain
    hit = np.flatnonzero(possible) if x.ndim == 1 else possible
    out = np.zeros(x.shape, bool)
    out[hit] = np.bitwise_count(x[hit]) <= distance
    return out


def forest(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct members: each member's neighbours are sought only among those not yet reached."""
    left, edges = members, []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            here = front.pop()
            near = _within(here, left, distance)
            if near.any():
                reached = left[near]
                left = left[~near]
                edges += [(int(here), int(r)) for r in reached]
                front += list(reached)
    return edges


def _link_batches(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by group; a group may span batches, so the last one is carried over."""
        carry: tuple[np.ndarray, ...] | None = None

        def solve(groups: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
            cuts = np.flatnonzero(np.any(groups[1:] != groups[:-1], axis=1)) + 1
            first = np.concatenate(([0], cuts))
            size = np.diff(np.concatenate((first, [len(fps)])))
            pair = first[size == 2]
            pair = pair[_within(fps[pair], fps[pair + 1], distance)] if len(pair) else pair
            a, b = [fps[pair]], [fps[pair + 1]]
            for i, n in zip(first[size > 2], size[size > 2]):
                if edges := forest(fps[i : i + n], distance):
                    found = np.array(edges, np.uint64)
                    a.append(found[:, 0])
                    b.append(found[:, 1])
            a, b = np.concatenate(a), np.concatenate(b)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]) if len(a) else None

        for batch in batches:
            if not batch.num_rows:
                continue
            groups = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            fps = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if carry is not None:
                groups, fps = np.concatenate((carry[0], groups)), np.concatenate((carry[1], fps))
            new = np.flatnonzero(np.any(groups[1:] != groups[:-1], axis=1))
            done = int(new[-1]) + 1 if len(new) else 0
            if done and (found := solve(groups[:done], fps[:done])) is not None:
                yield found
            carry = groups[done:], fps[done:]
        if carry is not None and (found := solve(*carry)) is not None:
            yield found

    return run


def links(distinct: DataFrame, distance: int = 4, exact: int = 3, max_members: int = MAX_MEMBERS) -> DataFrame:
    """(a, b) fingerprints joined by links of at most `distance` bits: a spanning forest of each join key's links.

    `exact` is the number of agreeing segments in a key: 3 (24 bits) suits up
    to about 1e8 distinct fingerprints, 4 (32 bits, 70 keys) more.
    """
    fp = F.col("fingerprint")
    keys = [_segment_key(fp, i, same) for i, (_, same) in enumerate(exact_sets(distance, exact))]
    keyed = distinct.select(F.explode(F.array(*keys)).alias("key"), fp)
    shared = keyed.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("members > 1")
    blocks = F.ceil(F.col("members") / F.lit(max_members)).cast("long")
    own = F.pmod(F.xxhash64("fingerprint"), blocks)
    dealt = shared.select("key", fp, blocks.alias("n"), own.alias("own")).select(
        "key", fp, F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("lo"), F.greatest(o, F.col("own")).alias("hi")))).alias("block")
    )
    groups = dealt.select("key", F.col("block.lo").alias("lo"), F.col("block.hi").alias("hi"), fp)
    ordered = groups.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return ordered.mapInArrow(_link_batches(distance), "a bigint, b bigint").distinct()


def stars(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds: (node, root), root the smallest node.

    Each round's edges are checkpointed; the rounds end when the edge set stays
    the same (count and hash sum).
    """

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    now = common.cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = state(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        now = common.cut(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(docs: DataFrame, shingle: int = 4, distance: int = 4, exact: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, fingerprint, root, component_id), one row per input row; root is the component's smallest fingerprint."""
    light = common.cut(fingerprints(docs, shingle, id_col, text_col))
    by_print = common.cut(light.groupBy("fingerprint").agg(F.min("id").alias("first_id")))
    found = common.cut(stars(links(by_print.select("fingerprint"), distance, exact)))
    linked = found.unionAll(found.select(F.col("root").alias("node"), "root").distinct())
    members = common.cut(by_print.join(linked, by_print["fingerprint"] == linked["node"]).select("fingerprint", "first_id", "root"))
    smallest = members.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    # A component may hold a third of all fingerprints, so members of large ones find their id under several keys.
    # Components of over total / 10^6 members number less than 10^6, whatever the input: their sizes fit a broadcast.
    share = F.lit(max(1000, members.count() // 1_000_000))
    smallest = common.cut(smallest.withColumn("salts", F.floor(F.col("n") / share) + 1))
    large = common.broadcast_if_small(smallest.filter("salts > 1").select(F.col("root").alias("large"), F.col("salts").alias("of")), 32)
    salted = members.join(large, F.col("root") == F.col("large"), "left").withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.coalesce("of", F.lit(1))))
    keys = smallest.select("root", "component_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    told = salted.join(keys, ["root", "salt"]).select(F.col("fingerprint").alias("node"), "root", "component_id")
    named = by_print.join(told, by_print["fingerprint"] == told["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id")
    )
    # cut, so that the join with all rows deals both sides anew and Spark can split the rows of one fingerprint
    return light.join(common.cut(named), "fingerprint").select("id", "text_key", "fingerprint", "root", "component_id")


def deduplicate(docs: DataFrame, shingle: int = 4, distance: int = 4, exact: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep one row of each component: its smallest id (nulls last), then the smallest text hash; one of repeated rows."""
    key, row = common.fresh("text_key", docs.columns), common.fresh("row_key", docs.columns)
    groups = components(docs, shingle, distance, exact, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    winners = groups.groupBy("root").agg(F.min(order).alias("w")).select(F.xxhash64("w.id", "w.text_key").alias("w_row"), F.col("w.text_key").alias("w_key"))
    # A row is known by two hashes, of id and text and of the text.  Both the join and the removal of
    # repeated rows use just these columns, so texts move once.
    keyed = docs.withColumn(key, F.xxhash64(text_col)).withColumn(row, F.xxhash64(id_col, key))
    kept = keyed.join(winners, (keyed[row] == F.col("w_row")) & (keyed[key] == F.col("w_key"))).drop("w_row", "w_key")
    return kept.dropDuplicates([row, key]).drop(row, key)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
