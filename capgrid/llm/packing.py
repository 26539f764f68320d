"""Sequence packing by non-negative least squares over a length histogram.

Every document is tokenised and closed with an end id, cut into full windows
and one remainder; full windows are sequences of their own.  For the
remainders, all combinations of at most `DEPTH` lengths that fill the window
exactly are enumerated; non-negative least squares finds how often to repeat
each so that the use of every length comes close to the histogram; repeat
counts are rounded down to what the histogram still holds; what is left over
is packed greedily (longest first, then the longest that still fits).

The histogram has one bin per length, so the solver's size depends on the
window alone and not on the data.  Pieces get their place by rank: the plan
says which ranks of a length go to which combination, and ranks are counted
per (length, salt) group.  A length has salts in proportion to its pieces, so
full windows and other common lengths are ranked by many tasks of even size.

Defined results.  A null or empty text is the end id alone.  Repeated rows
are packed as often as they occur.  Empty input gives no sequences.  Ids may
be null.  Columns other than the id and text are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capgrid.llm import common

WINDOW = 1024
DEPTH = 3
END_ID = 0
#: A (length, salt) group holds about this many pieces, or one in GROUPS of all if that is more.
GROUP_ROWS = 256
GROUPS = 1 << 16
#: Texts are encoded in pieces of at most this many characters, cut where two pre-tokens meet.
ENCODE_CHARS = 1 << 18
#: Runs of white space from this length on are encoded without the pattern, whose backtracking overflows the stack on long ones.
RUN_CHARS = 1 << 14
_LONG_RUN = re.compile("[\\x09-\\x0d \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{%d,}" % RUN_CHARS)  # White_Space, as the pattern's \\s
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_encoders: dict[str, tuple] = {}


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(vocabulary: str):
    """Function text -> ids for a byte-level BPE vocabulary file (its ids are its merge ranks); special strings map to their ids."""
    if vocabulary not in _encoders:
        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        _encoders[vocabulary] = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), tuple(special)
    enc, special = _encoders[vocabulary]

    def ordinary(text: str) -> list[int]:
        out: list[int] = []
        at = 0
        while len(text) - at > ENCODE_CHARS:
            end = _boundary(text, at + ENCODE_CHARS)
            if end < 0:
                break
            out += enc.encode_ordinary(text[at:end])
            at = end
        out += enc.encode_ordinary(text[at:] if at else text)
        return out

    def plain(text: str) -> list[int]:
        """A text without special strings; each long white-space run but its last character is a pre-token of its own."""
        out: list[int] = []
        at = 0
        for run in _LONG_RUN.finditer(text) if len(text) >= RUN_CHARS else ():
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += ordinary(text[at : run.start()])
            out += enc._encode_single_piece(text[run.start() : end].encode())
            at = end
        return out + ordinary(text[at:])

    specials = re.compile("(" + "|".join(map(re.escape, special)) + ")")

    def encode(text: str) -> list[int]:
        if not any(s in text for s in special):
            return plain(text)
        out: list[int] = []
        for i, part in enumerate(specials.split(text)):
            out += [enc.encode_single_token(part)] if i % 2 else plain(part)
        return out

    return encode


def _boundary(text: str, at: int) -> int:
    """First place from `at` on where a single space between two letters begins a pre-token; -1 if there is none."""
    while (at := text.find(" ", at)) >= 0:
        if at and at + 1 < len(text) and text[at - 1].isalpha() and text[at + 1].isalpha():
            return at
        at += 1
    return -1


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]): each document's full windows and its remainder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for at, texts in common.byte_lists(batch.column(1), 1 << 21):
                rows: list[int] = []
                start, length, crc, total, ids = [], [], [], [], []
                for i, text in enumerate(texts):
                    tokens = np.array([*encode(text.decode()), END_ID], "<u4")
                    for s in range(0, len(tokens), window):
                        part = tokens[s : s + window]
                        rows.append(at + i)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        total.append(len(tokens))
                        if with_ids:
                            ids.append(part.astype(np.int32))
                columns = [batch.column(0).take(pa.array(rows)), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    ddl = f"id {slim.schema['id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return slim.mapInArrow(run, ddl + (", ids array<int>" if with_ids else ""))


def combinations(window: int, lengths: np.ndarray) -> np.ndarray:
    """All combinations of one to three of the given lengths that fill the window; unused places are zero."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    out = [np.array([[window, 0, 0]])] if have[window] else []
    half = lengths[(lengths <= window // 2)]
    two = half[have[window - half]]
    out.append(np.stack([window - two, two, np.zeros_like(two)], axis=1))
    for c in lengths[lengths <= window // 3]:
        b = lengths[(lengths >= c) & (lengths <= (window - c) // 2)]
        a = window - c - b
        keep = have[a]
        out.append(np.stack([a[keep], b[keep], np.full(int(keep.sum()), c)], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def least_squares(combos: np.ndarray, target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative x that brings the use of every length near `target` (accelerated projected gradient).

    Each length's gap is weighed by one over the number of combinations that
    hold it (a place each), so no eigenvalue exceeds a column's places, at most
    `DEPTH`, and the step is one over that.
    """
    if not len(combos):
        return np.zeros(0)
    size = len(target)
    used = combos > 0
    rows, cols = combos[used], np.nonzero(used)[0]
    weight = 1.0 / np.maximum(np.bincount(rows, minlength=size), 1)
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(rounds):
        gap = (np.bincount(rows, weights=y[cols], minlength=size) - target) * weight
        gradient = np.bincount(cols, weights=gap[rows], minlength=len(combos))
        new = np.maximum(0.0, y - gradient / DEPTH)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often) for a histogram of piece lengths 0 to `window`; uses every piece exactly once."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        out.append(((window,), int(left[window])))
        left[window] = 0
    combos = combinations(window, np.flatnonzero(left))
    x = least_squares(combos, left.astype(float))
    for c in np.argsort(-x, kind="stable"):
        if x[c] < 0.5:
            break
        lengths, times = np.unique(combos[c][combos[c] > 0], return_counts=True)
        n = int(min(round(x[c]), (left[lengths] // times).min()))
        if n:
            left[lengths] -= n * times
            out.append((tuple(int(v) for v in combos[c] if v), n))
    while left.any():  # greedy: each round uses up at least one length
        sequence: list[int] = []
        room = window
        free = left.copy()
        while room and (fits := np.flatnonzero(free[: room + 1])).size:
            size = int(fits[-1])
            take = min(int(free[size]), room // size)
            sequence += [size] * take
            free[size] -= take
            room -= size * take
        lengths, times = np.unique(sequence, return_counts=True)
        n = int((left[lengths] // times).min())
        left[lengths] -= n * times
        out.append((tuple(sequence), n))
    return out


def _ranges(patterns: list[tuple[tuple[int, ...], int]], window: int) -> dict[str, np.ndarray]:
    """For each place of each pattern: the ranks of its length that go there, its first sequence, and its offset."""
    used = np.zeros(window + 1, np.int64)
    length, low, sequence, offset = [], [], [], []
    base = 0
    for lengths, n in patterns:
        at = 0
        for size in lengths:
            length.append(size)
            low.append(used[size])
            sequence.append(base)
            offset.append(at)
            used[size] += n
            at += size
        base += n
    order = np.lexsort((low, length))
    return {k: np.array(v, np.int64)[order] for k, v in (("length", length), ("low", low), ("sequence", sequence), ("offset", offset))}


def salts_by_length(histogram: np.ndarray, group_rows: int = GROUP_ROWS) -> np.ndarray:
    """How many salts each length has: at least one, and no more than GROUPS beyond that over all lengths."""
    share = max(group_rows, -(-int(histogram.sum()) // GROUPS))
    return np.maximum(1, -(-histogram // share))


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The pieces of all documents with the sequence and offset they are packed at.

    (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])
    """
    cutted = common.cut(pieces(docs, vocabulary, window, id_col, text_col, with_ids))
    histogram = np.zeros(window + 1, np.int64)
    for r in cutted.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a length
        histogram[r["length"]] = r["n"]
    salts = salts_by_length(histogram, group_rows)
    of_length = F.get(F.array(*[F.lit(int(v)) for v in salts]), F.col("length").cast("int"))
    salted = cutted.withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), of_length.cast("long")))
    base = np.cumsum(salts) - salts
    grid = np.zeros(int(salts.sum()), np.int64)
    for r in salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).collect():  # at most GROUPS + 2 x window rows
        grid[base[r["length"]] + r["salt"]] = r["n"]
    before = np.cumsum(grid) - grid
    before -= np.repeat(before[base], salts)  # pieces of the same length under smaller salts
    shared = docs.sparkSession.sparkContext.broadcast((base, before, _ranges(plan(histogram, window), window)))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32")).cast("long") - 1)
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, before, r = shared.value
        first = np.searchsorted(r["length"], np.arange(window + 2))
        key = r["length"] * (1 << 48) + r["low"]
        for batch in batches:
            length, salt, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "salt", "rank"))
            rank = rank + before[base[length] + salt]
            at = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            assert not len(at) or (at >= first[length]).all()
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(r["sequence"][at] + rank - r["low"][at]), pa.array(r["offset"][at])], [*names, "sequence_id", "offset"])

    kind = cutted.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + (", ids array<int>" if with_ids else "") + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, ddl)
