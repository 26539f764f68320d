"""Byte-level BPE encoding and decoding by prefix dynamic programming.

A text is cut into pieces by the tokenizer's pattern; a piece that is itself
a token becomes that token, any other is encoded on its own.  Within a piece,
every byte prefix has exactly one encoding, so its *last token* alone has to
be stored: the token t that ends at byte i belongs there when it stands alone
(t is the whole prefix) or when the last token p of the prefix before t and t
are a valid pair, that is, BPE over the bytes of p and t gives [p, t] again.
Walking back from the last byte reads the encoding off the table.  The table
of a prefix does not depend on what follows, hence

* appending bytes extends the table and leaves the stored part as it is, and
* after an edit only the entries from the edit on are computed anew, until as
  many neighbouring entries as the longest token has bytes agree with the old
  ones: from there on old and new table are the same.

The cost of a piece is linear in its bytes, also for a run of millions of
letters or blanks.  Tokens that end at a byte come from an Aho-Corasick
automaton over the vocabulary.  Pairs and pieces that have been seen are kept
in dictionaries of bounded size, which changes the time and nothing else.

`encode` gives the ids (and, on request, what `re_encode` needs), `decode` the
bytes of ids.  The vocabulary file is read by the driver and shipped to the
tasks in one broadcast (its size does not depend on the corpus).

Defined results.  Null and empty texts have no tokens.  Bytes that are not
UTF-8 count as U+FFFD each time a decoder replaces them.  Ids that are null or not in
the vocabulary make the decoded bytes null.  Repeated rows are encoded each;
null ids of rows are kept; extra columns are dropped, whatever their names;
empty tables give empty tables.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capgrid.llm.common import byte_lists

PIECES_KEPT = 1 << 19
PAIRS_KEPT = 1 << 20
CHUNK_BYTES = 8 << 20
_NEVER = float("inf")
_STREAMED = 1 << 20  # characters from which a text's pieces are taken a run at a time


class Vocabulary:
    """Token bytes by id, valid pairs and encodings of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._built: dict[int, tuple] = {}
        self.pieces = _Pieces(self)

    def merged(self, data: bytes) -> list[int]:
        """BPE by its definition: join the neighbouring pair of lowest rank, leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def stands_alone(self, token: int) -> bool:
        return bool(self._spines(token)[0])

    def _spines(self, token: int) -> tuple[list[tuple[bytes, float]], list[tuple[bytes, float]]]:
        """What stands at the token's left end while BPE builds it, each with the rank of the merge that takes it in, and the same at its right end."""
        found = self._built.get(token)
        if found is None:
            data = self.tokens[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            left, right, time = [], [], 0
            while len(parts) > 1:
                rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == 1 << 60:
                    break
                time = max(time, rank)
                if at == 0:
                    left.append((parts[0], time))
                if at == len(parts) - 2:
                    right.append((parts[-1], time))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            alone = len(parts) == 1
            found = self._built[token] = (left + [(data, _NEVER)], right + [(data, _NEVER)]) if alone else ([], [])
        return found

    def valid_pair(self, left: int, right: int) -> bool:
        """Whether BPE over both tokens' bytes gives the two tokens: no merge across their border comes before what stands there is merged on its own side."""
        found = self._pairs.get(left << 32 | right)
        if found is None:
            if len(self._pairs) >= PAIRS_KEPT:
                self._pairs.clear()
            found = self._pairs[left << 32 | right] = self._holds(self._spines(left)[1], self._spines(right)[0])
        return found

    def _holds(self, ends: list[tuple[bytes, float]], begins: list[tuple[bytes, float]]) -> bool:
        if not ends or not begins:
            return False
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = ends[i], begins[j]
            across = self.ranks.get(a + b)
            if across is not None and across < a_until and across <= b_until:  # of equal ranks the leftmost merge goes first
                return False
            if a_until <= b_until:
                if a_until == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        table = PrefixTable(self)
        table.append(piece)
        return table.ids()

    def split(self, text: str) -> Iterator[str]:
        return (m.group() for m in self.pattern.finditer(text))


class _Pieces(dict):
    """Piece -> little-endian 32-bit ids; emptied when full."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        ids = np.array(self.vocabulary.encode_piece(data), np.int32).tobytes()
        if len(data) <= 256:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = ids
        return ids


class PrefixTable:
    """The last token of every byte prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []  # last[i]: last token of the first i + 1 bytes
        self.computed = 0  # entries computed so far, for tests of `replace`

    def _entries(self, data: bytes, first: int, last: list[int]) -> Iterator[int]:
        """The entries from `first` on; `last` holds those before and receives each as it comes."""
        v = self.vocabulary
        done, known, valid, alone = first, v._pairs.get, v.valid_pair, v.stands_alone
        from_byte = max(0, first - v.longest)
        for end, (token, length) in v.automaton.iter(data[from_byte:].decode("latin-1")):
            end += from_byte
            if end < done:
                continue
            before = end - length
            if before < 0:
                fits = alone(token)
            else:
                fits = known(last[before] << 32 | token)
                if fits is None:
                    fits = valid(last[before], token)
            if fits:
                last.append(token)
                done = end + 1
                yield token

    def append(self, more: bytes) -> None:
        first = len(self.data)
        self.data += more
        for _ in self._entries(self.data, first, self.last):
            self.computed += 1

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put `new` in the place of bytes start..stop; entries past the edit are kept as soon as they must agree."""
        old, shift = self.last, start + len(new) - stop
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        agree = 0
        for token in self._entries(self.data, start, self.last):
            self.computed += 1
            i = len(self.last) - 1
            # An entry depends on the bytes and entries of the longest token before it, all of them past the edit here.
            agree = agree + 1 if i >= start + len(new) and old[i - shift] == token else 0
            if agree >= self.vocabulary.longest:
                self.last += old[i - shift + 1 :]
                break

    def ids(self) -> list[int]:
        out, end, tokens = [], len(self.last), self.vocabulary.tokens
        while end:
            out.append(self.last[end - 1])
            end -= len(tokens[out[-1]])
        return out[::-1]


class EncodedText:
    """A text with its pieces' lengths (characters) and tokens, kept exact under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, text: str = "", lengths: list[int] | None = None, ids: list[bytes] | None = None):
        self.vocabulary, self.text = vocabulary, text
        if lengths is None:
            pieces = list(vocabulary.split(text))
            lengths, ids = [len(p) for p in pieces], [vocabulary.pieces[p] for p in pieces]
        self.lengths, self.piece_ids = lengths, ids
        self.encoded = 0  # pieces encoded by the last edit

    def replace(self, start: int, stop: int, new: str) -> None:
        """The text with characters start..stop replaced; only pieces near the edit are cut and encoded again."""
        text = self.text[:start] + new + self.text[stop:]
        shift, resume = start + len(new) - stop, start + len(new)
        starts = np.concatenate(([0], np.cumsum(self.lengths, dtype=np.int64)))
        # A match reads its own characters, up to two beyond (a run of blanks gives its last one up), and three from its start (the contractions).
        reach = np.maximum(starts[1:] + 2, starts[:-1] + 3)
        kept = int(np.argmax(reach > start)) if (reach > start).any() else len(self.lengths)
        at = int(starts[kept])
        boundaries = {int(s): k for k, s in enumerate(starts)} if resume < len(text) else {}
        lengths, ids, self.encoded = self.lengths[:kept], self.piece_ids[:kept], 0
        for match in self.vocabulary.pattern.finditer(text, at):
            if match.start() >= resume and match.start() - shift in boundaries:
                k = boundaries[match.start() - shift]  # the same text follows from a piece's start, so the same pieces do
                lengths, ids = lengths + self.lengths[k:], ids + self.piece_ids[k:]
                break
            piece = match.group()
            lengths.append(len(piece))
            ids.append(self.vocabulary.pieces[piece])
            self.encoded += 1
        self.text, self.lengths, self.piece_ids = text, lengths, ids

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def become(self, text: str) -> None:
        """Change to `text`, taking what lies between the common beginning and end as the edit."""
        start, stop = _common(self.text, text)
        self.replace(start, len(self.text) - stop, text[start : len(text) - stop])


def _common(a: str, b: str) -> tuple[int, int]:
    """Length of the common beginning, and of the common end of what is left."""

    def prefix(x: np.ndarray, y: np.ndarray) -> int:
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[:n] != y[:n])
        return int(differ[0]) if len(differ) else n

    x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
    start = prefix(x, y)
    return start, prefix(x[start:][::-1], y[start:][::-1])


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of lines `base64 rank`."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


_loaded: dict[str, Vocabulary] = {}


def _vocabulary(content: bytes, pattern: str) -> Vocabulary:
    """One vocabulary a worker process."""
    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(read_ranks(content), pattern)
    return _loaded[key]


def _shipped(df: DataFrame, ranks_path: str):
    with open(ranks_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _int_lists(values: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(v) // 4 for v in values], dtype=np.int64)
    if offsets[-1] >= 1 << 31:
        raise ValueError("a batch of texts has 2^31 tokens or more")
    data = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(values))])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), data)


def _encoded(vocabulary: Vocabulary, text: str) -> bytes:
    get = vocabulary.pieces.__getitem__
    if len(text) < _STREAMED:
        return b"".join(map(get, vocabulary.pattern.findall(text)))
    pieces, runs = vocabulary.split(text), []
    while run := b"".join(map(get, islice(pieces, _STREAMED))):
        runs.append(run)
    return b"".join(runs)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", pieces: bool = False) -> DataFrame:
    """(id, ids array<int>); with `pieces` also text, piece_chars and piece_tokens, which `re_encode` starts from."""
    shipped = _shipped(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shipped.value, pattern)
        for batch in batches:
            for first, texts in byte_lists(batch.column(1), CHUNK_BYTES):
                texts = [t.decode("utf-8", "replace") for t in texts]
                own = batch.column(0).slice(first, len(texts))
                if not pieces:
                    yield pa.RecordBatch.from_arrays([own, _int_lists([_encoded(vocabulary, t) for t in texts])], ["id", "ids"])
                    continue
                yield _stored_batch(own, [EncodedText(vocabulary, t) for t in texts])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, ids array<int>" + (", text string, piece_chars array<int>, piece_tokens array<int>" if pieces else "")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _stored_batch(own: pa.Array, texts: list[EncodedText], **more: pa.Array) -> pa.RecordBatch:
    as_ints = [np.array(t.lengths, np.int32).tobytes() for t in texts], [np.array([len(i) // 4 for i in t.piece_ids], np.int32).tobytes() for t in texts]
    columns = {"id": own, "ids": _int_lists([b"".join(t.piece_ids) for t in texts]), "text": pa.array([t.text for t in texts], pa.string())}
    columns |= {"piece_chars": _int_lists(as_ints[0]), "piece_tokens": _int_lists(as_ints[1])} | more
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def re_encode(encoded: DataFrame, edited: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`encoded` (made with `pieces`) after the texts of `edited` took the place of the stored ones of the same id.

    One join by id; rows without a new text stay.  Only the pieces between the
    common beginning and end of the old and the new text are encoded; their
    number is `n_encoded`.  A null new text is empty.  Several new texts of an id
    give a row each; null ids match nothing; texts of unknown ids are dropped.
    """
    shipped = _shipped(encoded, ranks_path)
    new = edited.select(F.col(id_col).alias("new_id"), F.coalesce(F.col(text_col), F.lit("")).alias("new_text"))
    both = encoded.join(new, encoded["id"] == new["new_id"], "left").select("id", "text", "ids", "piece_chars", "piece_tokens", "new_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shipped.value, pattern)
        for batch in batches:
            out, size, first = [], 0, 0
            for i, row in enumerate(batch.to_pylist()):
                ids = np.array(row["ids"], np.int32).tobytes()
                ends = np.cumsum([0] + row["piece_tokens"]) * 4
                text = EncodedText(vocabulary, row["text"], row["piece_chars"], [ids[a:b] for a, b in zip(ends, ends[1:])])
                if row["new_text"] is not None:
                    text.become(row["new_text"])
                out.append(text)
                size += len(text.text)
                if size >= CHUNK_BYTES or i == batch.num_rows - 1:
                    yield _stored_batch(batch.column(0).slice(first, len(out)), out, n_encoded=pa.array([t.encoded for t in out], pa.int32()))
                    out, size, first = [], 0, i + 1

    kind = encoded.schema["id"].dataType.simpleString()
    return both.mapInArrow(run, f"id {kind}, ids array<int>, text string, piece_chars array<int>, piece_tokens array<int>, n_encoded int")


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`encoded` with the bytes of its ids as a binary column; null where an id is null or unknown."""
    shipped = _shipped(encoded, ranks_path)
    columns = [c for c in encoded.columns if c.lower() != out_col.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, starts, lengths = _token_buffer(shipped.value)
        for batch in batches:
            lists = batch.column(columns.index(ids_col))
            decoded = [_bytes_of(lists[i].values, tokens, starts, lengths) if lists[i].is_valid else None for i in range(batch.num_rows)]
            at = 0
            while at < batch.num_rows:
                n, size = 0, 0
                while at + n < batch.num_rows and (not n or size < CHUNK_BYTES):
                    size += len(decoded[at + n] or b"")
                    n += 1
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded[at : at + n], pa.binary())], [*columns, out_col])
                at += n

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*[f"`{c}`" for c in columns]).schema.fields)
    return encoded.select(*[f"`{c}`" for c in columns]).mapInArrow(run, f"{schema}, `{out_col}` binary")


def _token_buffer(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in one buffer, with the start and length of each id (length -1: no such id)."""
    ranks = read_ranks(content)
    lengths = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
    by_id = sorted((rank, token) for token, rank in ranks.items())
    lengths[[rank for rank, _ in by_id]] = [len(token) for _, token in by_id]
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    return np.frombuffer(b"".join(token for _, token in by_id), np.uint8), starts, lengths


def _bytes_of(ids: pa.Array, tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> bytes | None:
    if ids.null_count:
        return None
    ids = ids.to_numpy()
    if len(ids) and (ids.min() < 0 or ids.max() >= len(lengths) or lengths[ids].min() < 0):
        return None
    n = lengths[ids]
    ends = np.cumsum(n)
    return tokens[np.repeat(starts[ids] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
