"""Benchmark decontamination by n-gram windows.

The windows of all benchmark items (n consecutive normalised words; an item
of fewer words is one window) form a hash set that is broadcast.  Document
windows are hashed the same way, looked up, and every hit is verified word by
word, so a hash collision never counts.  Hit words can be removed as spans,
or whole documents dropped.

The benchmark's size is measured first.  Beyond `max_bytes` it is cut into
blocks of items and the documents are scanned once per block, by tasks that
hold one block; the hits of a row are then merged, so nothing is left out.

Defined results.  Null and empty texts have no words and no hits.  Items
without words have no windows.  Windows of an item whose id is null hit words
but are not listed.  Repeated item ids are listed once; repeated documents
each keep their row.  With an empty benchmark nothing is hit.  Extra columns
are carried by `decontaminate`; `scan` returns only its own columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capgrid.llm import common, textscan

WINDOW = 10
CHUNK = 1 << 21
#: Item text of one broadcast index, which takes up to four times as much.
MAX_BYTES = 16 << 20
_MULT = np.uint64(0xD6E8FEB86659FD93)
SCAN_DDL = "text_key bigint, n_words bigint, items array<string>, hits array<struct<first:bigint,last:bigint>>"


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of `size` consecutive word hashes."""
    m = len(h) - size + 1
    total = h[:m].copy()
    for j in range(1, size):
        total *= _MULT
        total += h[j : j + m]
    return total


class Index:
    """Hashes of the items' windows, sorted by window length, each with the place of its words in one buffer.

    The buffer holds every item's words with a space between them and a line
    feed behind each item.  A window takes 12 bytes beside it, so the index
    stays below four times the items' text.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], n: int):
        self.items = [item for item, _ in items]
        self.buffer = b"".join(b" ".join(_words(text)) + b"\n" for _, text in items)
        buffer = np.frombuffer(self.buffer, np.uint8)
        self.begins = np.concatenate(([0], np.flatnonzero(buffer == 0x0A) + 1)).astype(np.int64)
        starts, ends = textscan.spans(buffer, textscan.ALNUM)
        h = textscan.word_hashes(buffer, starts, ends)
        first = np.searchsorted(starts, self.begins)
        sizes = np.minimum(np.diff(first), n)
        self.sizes = {}
        for size in np.unique(sizes[sizes > 0]).tolist():
            of_size = np.repeat(sizes == size, np.diff(first))  # words of items whose windows are this long
            total = window_hashes(h, size)
            whole = np.repeat(first[1:], np.diff(first))[: len(total)] >= np.arange(size, size + len(total))
            at = np.flatnonzero(of_size[: len(total)] & whole)
            at = at[np.argsort(total[at], kind="stable")]
            known, place = total[at], starts[at].astype(np.uint32)
            seen = np.zeros(1 << 20, bool)
            seen[(known >> np.uint64(44)).astype(np.int64)] = True
            self.sizes[size] = (seen, known, place)

    def resident(self) -> int:
        """Bytes of the buffer and the arrays, without the fixed table of leading hash bits of each window length."""
        return len(self.buffer) + self.begins.nbytes + sum(known.nbytes + place.nbytes for _, known, place in self.sizes.values())

    def _owners(self, window: bytes, place: np.ndarray) -> np.ndarray:
        """The items, as numbers, that hold the window at one of the places whose hash it shares."""
        size = len(window)
        same = [p for p in place.tolist() if self.buffer.startswith(window, p) and self.buffer[p + size] in b" \n"]
        return np.unique(np.searchsorted(self.begins, same, side="right") - 1)

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[str]], list[list[tuple[int, int]]], list[list[tuple[int, int]]]]:
        """Per text: words, item ids, hit word runs [first, last], and the byte runs that hold them."""
        joined = b"\n".join(texts).lower()
        buffer = np.frombuffer(joined, np.uint8)
        starts, ends = textscan.spans(buffer, textscan.ALNUM)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
        owner = np.searchsorted(offsets, starts, side="right") - 1
        first_word = np.searchsorted(starts, offsets)
        h = textscan.word_hashes(buffer, starts, ends)
        found: dict[int, set[str]] = {}
        owners: dict[bytes, np.ndarray] = {}  # of the windows met in these texts
        mark = np.zeros(len(starts) + 1, np.int32)
        for size, (seen, known, place) in self.sizes.items():
            if len(h) < size:
                continue
            total = window_hashes(h, size)
            maybe = np.flatnonzero(seen[(total >> np.uint64(44)).astype(np.int64)] & (owner[: len(total)] == owner[size - 1 :]))
            low, high = (np.searchsorted(known, total[maybe], side=side) for side in ("left", "right"))
            for i, a, b in zip(maybe[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
                window = b" ".join(joined[p:q] for p, q in zip(starts[i : i + size].tolist(), ends[i : i + size].tolist()))
                if window not in owners:
                    owners[window] = self._owners(window, place[a:b])
                if len(owners[window]):
                    found.setdefault(int(owner[i]), set()).update(self.items[j] for j in owners[window].tolist() if self.items[j] is not None)
                    mark[i] += 1
                    mark[i + size] -= 1
        hit = np.cumsum(mark[:-1]) > 0
        begins = hit & (np.concatenate(([True], ~hit[:-1])) | np.concatenate(([True], owner[1:] != owner[:-1]))) if len(hit) else hit
        stops = hit & (np.concatenate((~hit[1:], [True])) | np.concatenate((owner[1:] != owner[:-1], [True]))) if len(hit) else hit
        runs: list[list[tuple[int, int]]] = [[] for _ in texts]
        places: list[list[tuple[int, int]]] = [[] for _ in texts]
        for a, b in zip(np.flatnonzero(begins).tolist(), np.flatnonzero(stops).tolist()):
            d = int(owner[a])
            runs[d].append((a - int(first_word[d]), b - int(first_word[d])))
            places[d].append((int(starts[a] - offsets[d]), int(ends[b] - offsets[d])))
        return np.diff(first_word), [sorted(found.get(d, ())) for d in range(len(texts))], runs, places


def _words(text: bytes) -> list[bytes]:
    raw = text.lower()
    starts, ends = textscan.spans(np.frombuffer(raw, np.uint8), textscan.ALNUM)
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def _blocks(benchmark: DataFrame, n: int, item_col: str, text_col: str, max_bytes: int) -> list:
    """Broadcast window indexes of the benchmark, each made from about `max_bytes` of item text, one at a time on the driver.

    Equal texts of equal ids count once.  Items are dealt by hash, so a block is
    near its share as long as single items are short beside `max_bytes`.
    """
    slim = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    total = slim.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    count = max(1, -(-total // max_bytes))
    context = benchmark.sparkSession.sparkContext
    out = []
    for b in range(count):
        part = slim if count == 1 else slim.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == b)
        out.append(context.broadcast(Index([(r["item"], r["text"].encode()) for r in part.toLocalIterator()], n)))
    return out


def _scan_block(docs: DataFrame, index, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in common.byte_lists(batch.column(1), CHUNK):
                n_words, items, runs, _ = index.value.scan(texts)
                part = batch.slice(at, len(texts))
                hits = pa.array([[{"first": a, "last": b} for a, b in r] for r in runs], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n_words), pa.array(items, pa.list_(pa.string())), hits], ["id", "text_key", "n_words", "items", "hits"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("text_key"))
    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, {SCAN_DDL}")


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """(id, text_key, n_words, items, hits, n_hit), one row per document; hits are word runs [first, last]."""
    return _scan_blocks(docs, _blocks(benchmark, n, item_col, item_text_col, max_bytes), id_col, text_col)


def _scan_blocks(docs: DataFrame, blocks: list, id_col: str, text_col: str) -> DataFrame:
    """Each block is scanned by tasks of its own, so no worker holds more than one."""
    length = lambda h: F.aggregate(h, F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    first = _scan_block(docs, blocks[0], id_col, text_col)
    if len(blocks) == 1:
        return first.withColumn("n_hit", length(F.col("hits")))
    rest = [_scan_block(docs, b, id_col, text_col).filter(F.size("hits") > 0) for b in blocks[1:]]
    more = rest[0]
    for r in rest[1:]:
        more = more.unionAll(r)
    # equal rows have equal hits, so a row is known by its id and text hash
    more = more.groupBy("id", "text_key").agg(F.flatten(F.collect_set("items")).alias("more_items"), F.flatten(F.collect_set("hits")).alias("more_hits"))
    joined = first.alias("f").join(more.alias("m"), F.col("f.id").eqNullSafe(F.col("m.id")) & (F.col("f.text_key") == F.col("m.text_key")), "left")
    empty_items, empty_hits = F.array().cast("array<string>"), F.array().cast("array<struct<first:bigint,last:bigint>>")
    runs = F.array_sort(F.concat("hits", F.coalesce("more_hits", empty_hits)))

    def add(done, run):
        """Runs sorted by their start: extend the last run or begin a new one."""
        tail = F.element_at(done, -1)
        grown = F.struct(tail["first"].alias("first"), F.greatest(tail["last"], run["last"]).alias("last"))
        return F.when((F.size(done) > 0) & (run["first"] <= F.get(done, F.size(done) - 1)["last"] + 1), F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(run)))

    merged = F.aggregate(runs, empty_hits, add)
    out = joined.select("f.id", "f.text_key", "n_words", F.array_sort(F.array_distinct(F.concat("items", F.coalesce("more_items", empty_items)))).alias("items"), merged.alias("hits"))
    return out.withColumn("n_hit", length(F.col("hits")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """`docs` without contaminated documents, or with the hit spans cut out of their texts (`remove="spans"`)."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    at = docs.columns.index(text_col)
    blocks = _blocks(benchmark, n, item_col, item_text_col, max_bytes)
    if len(blocks) == 1:
        return docs.mapInArrow(_cutter(blocks[0], at, remove), docs.schema)
    scanned = _scan_blocks(docs, blocks, id_col, text_col).filter("n_hit > 0").dropDuplicates(["id", "text_key"])  # equal rows have equal hits
    if remove == "spans":
        return _cut_merged(docs, scanned, id_col, text_col)
    key = common.fresh("text_key", docs.columns)
    keyed, hit = docs.withColumn(key, F.xxhash64(text_col)), scanned.select(F.col("id").alias("hit_id"), F.col("text_key").alias("hit_key"))
    return keyed.join(hit, keyed[id_col].eqNullSafe(F.col("hit_id")) & (keyed[key] == F.col("hit_key")), "left_anti").drop(key)


def _cut_merged(docs: DataFrame, scanned: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Cut the merged word runs of `scan` out of the texts of their documents."""
    key, runs = common.fresh("text_key", docs.columns), common.fresh("hits", docs.columns)
    hit = scanned.select(F.col("id").alias("hit_id"), F.col("text_key").alias("hit_key"), F.col("hits").alias("hit_runs"))
    keyed = docs.withColumn(key, F.xxhash64(text_col))
    joined = keyed.join(hit, keyed[id_col].eqNullSafe(F.col("hit_id")) & (keyed[key] == F.col("hit_key")), "left").drop("hit_id", "hit_key", key).withColumnRenamed("hit_runs", runs)
    at, last = docs.columns.index(text_col), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(last).to_pylist()):
                if found:
                    raw = text.encode()
                    starts, ends = textscan.spans(np.frombuffer(raw.lower(), np.uint8), textscan.ALNUM)
                    text = _without(raw, [(int(starts[r["first"]]), int(ends[r["last"]])) for r in found])
                texts.append(text)
            arrays = [pa.array(texts, batch.column(i).type) if i == at else batch.column(i) for i in range(last)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:last])

    return joined.mapInArrow(run, docs.schema)


def _cutter(index, at: int, remove: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in common.byte_lists(batch.column(at), CHUNK):
                part = batch.slice(first, len(texts))
                _, _, runs, places = index.value.scan(texts)
                if remove == "documents":
                    yield part.filter(pa.array([not r for r in runs]))
                    continue
                column = part.column(at)
                if any(runs):
                    kept = [v if not p else _without(t, p) for v, t, p in zip(column.to_pylist(), texts, places)]
                    column = pa.array(kept, column.type)
                arrays = [column if i == at else part.column(i) for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays(arrays, schema=part.schema)

    return run


def _without(text: bytes, places: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for a, b in places:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]]).decode()
