"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad.  A line's features are shares
of its bytes and words (symbols, capitals, digits, repeated words ...), and
those of the line before and after it.  The field has one weight per feature
and a 2 x 2 matrix for neighbouring labels.  A document's quality is the mean
of its lines' forward-backward marginals for "good", weighted by line length;
a two-parameter logistic curve maps it to the labelled share of good documents.

The field is fitted to a bounded sample of labelled documents, drawn by a
hash of the id: at most `max_docs` per label, all lines of each, at most
`max_lines` together.  A training line's label is its document's.  Scoring reads
every line of every text, never labels, language, source or id.

Defined results.  A text without lines (null, empty, white space) scores the
labelled share of good documents; with no usable labels every score is 0.5;
with labels of one kind only every score is that kind.  Repeated rows are
scored each; a null id counts as held out (hash of the empty string).  Labels
that contradict each other for one id, and null labels, are not learned from.
Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capgrid.llm import common, textscan

CHUNK = 1 << 21
_NOT_NEWLINE = ~textscan.byte_class((0x0A, 0x0A))
_CLASSES = {
    "symbol": np.isin(np.arange(256), np.frombuffer(b"#*$%&<>=@^_`{}[]~\\/+", np.uint8)),
    "pipe": textscan.byte_class((0x7C, 0x7C)),
    "bang": textscan.byte_class((0x21, 0x21)),
    "stop": np.isin(np.arange(256), np.frombuffer(b".,;:?'\"()-", np.uint8)),
    "digit": textscan.byte_class((0x30, 0x39)),
    "upper": textscan.byte_class((0x41, 0x5A)),
    "lower": textscan.byte_class((0x61, 0x7A), (0x80, 0xFF)),
}
OWN = ("bias", "length", "symbol", "pipe", "bang", "stop", "digit", "upper", "repeated_words", "distinct_words", "word_length", "repeated_line", "few_words")
#: Own features that the lines before and after lend to a line.
LENT = [OWN.index(n) for n in ("symbol", "pipe", "bang", "upper", "repeated_words", "distinct_words", "repeated_line")]
N_FEATURES = len(OWN) + 2 * len(LENT) + 2


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each line, bytes of each line, features) over the lines that have a word."""
    joined = b"\n".join(texts)
    buffer = np.frombuffer(joined, np.uint8)
    starts, ends = textscan.spans(buffer, _NOT_NEWLINE)
    word_starts, word_ends = textscan.spans(buffer, textscan.NONSPACE)
    line = np.searchsorted(starts, word_starts, side="right") - 1
    words = np.bincount(line, minlength=len(starts)) if len(starts) else np.zeros(0, np.int64)
    keep = words > 0
    number = np.cumsum(keep) - 1
    starts, ends, words, line = starts[keep], ends[keep], words[keep], number[line]
    n = len(starts)
    offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    if not n:
        return owner, ends - starts, np.zeros((0, N_FEATURES))
    # a kept line's segment may run over blank lines up to the next: these hold white space only
    count = {k: np.add.reduceat(table[buffer], starts, dtype=np.int64) for k, table in _CLASSES.items()}
    size = (ends - starts).astype(float)
    letters = np.maximum(1, count["upper"] + count["lower"])
    h = textscan.word_hashes(buffer, word_starts, word_ends)
    same = np.zeros(n)
    if len(h) > 1:
        again = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
        same = np.bincount(line[1:][again], minlength=n)
    order = np.lexsort((h, line))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=n)
    whole = textscan.word_hashes(buffer, starts, ends)
    order = np.lexsort((np.arange(n), whole, owner))
    repeat = np.zeros(n)
    repeat[order[1:]] = (whole[order][1:] == whole[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    word_bytes = np.bincount(line, weights=word_ends - word_starts, minlength=n)
    own = np.stack(
        [np.ones(n), np.log1p(size) / 8, *(count[k] / size for k in ("symbol", "pipe", "bang", "stop", "digit")), count["upper"] / letters, same / words, distinct / words, np.minimum(word_bytes / words / 10, 5), repeat, words <= 2],
        axis=1,
    )
    first = np.ones(n, bool)
    first[1:] = owner[1:] != owner[:-1]
    last = np.concatenate((first[1:], [True]))
    before, after = np.zeros((n, len(LENT))), np.zeros((n, len(LENT)))
    before[1:], after[:-1] = own[:-1][:, LENT], own[1:][:, LENT]
    before[first], after[last] = 0, 0
    return owner, ends - starts, np.concatenate((own, before, after, first[:, None], last[:, None]), axis=1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of "good"; "bad" has score zero
    transitions: np.ndarray  # [label before, label]
    slope: float
    shift: float
    prior: float
    constant: float | None = None  # score of every text, where the labels leave nothing to learn


def _by_length(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first line, number of lines) of each chain."""
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)
    return first, np.diff(np.concatenate((first, [len(owner)])))


def forward_backward(good: np.ndarray, owner: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log forward, log backward, log normaliser per line) with label 0 bad and 1 good; all chains step together."""
    n = len(good)
    emit = np.stack((np.zeros(n), good), axis=1)
    first, size = _by_length(owner)
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    forward, backward = emit.copy(), np.zeros((n, 2))
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(longest), side="left")  # chains longer than t
    for t in range(1, longest):
        at = first[: live[t]] + t
        prev = forward[at - 1]
        forward[at] += np.logaddexp(prev[:, :1] + transitions[0], prev[:, 1:] + transitions[1])
    for t in range(longest - 1, 0, -1):
        at = first[: live[t]] + t
        coming = backward[at] + emit[at]
        backward[at - 1] = np.logaddexp(coming[:, :1] + transitions[:, 0], coming[:, 1:] + transitions[:, 1])
    total = np.logaddexp.reduce(forward + backward, axis=1) if n else np.zeros(0)
    return forward, backward, total


def marginals(model: Model, features: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Probability that each line is good."""
    good = ((features - model.mean) / model.scale) @ model.weights
    forward, backward, total = forward_backward(good, owner, model.transitions)
    return np.exp(forward[:, 1] + backward[:, 1] - total)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _document_means(p: np.ndarray, size: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    weight = np.bincount(owner, weights=size, minlength=n)
    return np.bincount(owner, weights=p * size, minlength=n) / np.maximum(weight, 1), weight > 0


def fit(features: np.ndarray, owner: np.ndarray, size: np.ndarray, label: np.ndarray, counts: tuple[int, int], rounds: int = 150, penalty: float = 1.0) -> Model:
    """Conditional maximum likelihood (Adam, fixed number of rounds) on chains whose lines carry their document's label."""
    prior = counts[1] / max(1, sum(counts))
    d = features.shape[1]
    if not min(counts) or not len(features):
        return Model(np.zeros(d), np.ones(d), np.zeros(d), np.zeros((2, 2)), 1.0, 0.0, prior, 0.5 if not sum(counts) else prior)
    mean, scale = features.mean(0), features.std(0)
    mean[0] = 0.0
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = (features - mean) / scale
    y = label[owner]
    first, _ = _by_length(owner)
    inner = np.ones(len(owner), bool)
    inner[first] = False
    inner = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner - 1], y[inner]), 1)
    theta = np.zeros(d + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        good, transitions = x @ theta[:d], theta[d:].reshape(2, 2)
        forward, backward, total = forward_backward(good, owner, transitions)
        p = np.exp(forward[:, 1] + backward[:, 1] - total)
        emit = np.stack((np.zeros(len(good)), good), axis=1)
        pair = np.exp(forward[inner - 1][:, :, None] + transitions[None] + (emit[inner] + backward[inner])[:, None, :] - total[inner][:, None, None])
        gradient = np.concatenate((x.T @ (p - y), (pair.sum(0) - seen).ravel())) / len(y) + penalty * theta / len(y)
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = Model(mean, scale, theta[:d], theta[d:].reshape(2, 2), 1.0, 0.0, prior)
    quality, has = _document_means(marginals(model, features, owner), size, owner, len(label))
    z, target = _logit(quality[has]), label[has]
    weight = np.where(target == 1, counts[1] / max(1, (target == 1).sum()), counts[0] / max(1, (target == 0).sum()))
    model.slope, model.shift = _curve(z, target, weight / weight.mean())
    return model


def _curve(z: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic curve target ~ slope * z + shift by damped Newton steps; the slope stays positive."""
    a, b = 0.5, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * z + b)))
        g = np.array([np.sum(weight * (p - target) * z) + 0.01 * a, np.sum(weight * (p - target)) + 0.01 * b])
        r = weight * p * (1 - p)
        hess = np.array([[np.sum(r * z * z) + 0.01, np.sum(r * z)], [np.sum(r * z), np.sum(r) + 0.01]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        a, b = max(1e-3, a - step[0]), b - step[1]
    return float(a), float(b)


def in_fold(id_column: Column, folds: int = 5) -> Column:
    """True for the held-out fold: crc32 of the id as text modulo `folds` is zero."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == 0


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", max_docs: int = 2000, max_lines: int = 500_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit to at most `max_docs` documents of each label outside the held-out fold, every line of each.

    A label's documents are taken in the order of their ids' hashes while their
    lines add up to at most half of `max_lines`; one that does not fit is left
    out whole, none is cut.
    """
    usable = (
        labels.select(F.col(id_col).alias("id"), F.col(target).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~in_fold(F.col("id")))
        .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).filter("y = y2").drop("y2")
    )
    tally = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    counts = tally.get(0, 0), tally.get(1, 0)
    drawn = [usable.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_docs) for y in (0, 1)]
    sample = docs.sparkSession.createDataFrame([(r["id"], r["y"]) for part in drawn for r in part.collect()], usable.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for at, texts in common.byte_lists(batch.column(1), CHUNK):
                owner, size, features = line_features(texts)
                first, count = _by_length(owner)
                for f, c in zip(first.tolist(), count.tolist()):
                    s = slice(f, f + c)
                    row = at + int(owner[f])
                    yield pa.RecordBatch.from_arrays([pa.array([str(ids[row])]), pa.array([ys[row]], pa.int64()), pa.array([size[s].astype("<i8").tobytes()]), pa.array([features[s].astype("<f8").tobytes()])], ["id", "y", "size", "features"])

    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")
    # repeated ids count once; the sample's texts are written, since their lines are counted before they are read
    joined = common.cut(joined.groupBy("id", "y").agg(F.min("text").alias("text")).select("id", "text", "y"))
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    told = joined.select("id", "y", F.coalesce(n_lines, F.lit(1)).alias("n")).orderBy(F.xxhash64("id"), "id").collect()  # at most max_docs a label
    left, chosen = {0: max_lines // 2, 1: max_lines // 2}, []
    for r in told:
        if r["n"] <= left[r["y"]]:
            left[r["y"]] -= r["n"]
            chosen.append(r["id"])
    fits = docs.sparkSession.createDataFrame([(i,) for i in chosen], joined.select("id").schema)
    joined = joined.join(F.broadcast(fits), "id").select("id", "text", "y")
    rows = joined.mapInArrow(run, "id string, y bigint, size binary, features binary").collect()  # bounded by max_docs and max_lines
    rows.sort(key=lambda r: (r["id"], bytes(r["features"])))
    sizes = [np.frombuffer(r["size"], "<i8") for r in rows]
    owner = np.repeat(np.arange(len(rows)), [len(s) for s in sizes])
    features = np.concatenate([np.frombuffer(r["features"], "<f8").reshape(-1, N_FEATURES) for r in rows]) if rows else np.zeros((0, N_FEATURES))
    return fit(features, owner, np.concatenate(sizes) if rows else np.zeros(0), np.array([r["y"] for r in rows], np.int64), counts)


def chunk_scores(model: Model, texts: list[bytes]) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    owner, size, features = line_features(texts)
    quality, has = _document_means(marginals(model, features, owner), size, owner, len(texts))
    return np.where(has, 1 / (1 + np.exp(-(model.slope * _logit(quality) + model.shift))), model.prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in common.byte_lists(batch.column(1), CHUNK):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(chunk_scores(shared.value, texts))], ["id", "score"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, score double")


def line_labels(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line, n_bytes, good): the marginal of every line with a word, lines counted from 0 among those."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in common.byte_lists(batch.column(1), CHUNK):
                owner, size, features = line_features(texts)
                if not len(owner):
                    continue
                first, count = _by_length(owner)
                good = marginals(shared.value, features, owner)
                number = np.arange(len(owner)) - np.repeat(first, count)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at + owner)), pa.array(number), pa.array(size), pa.array(good)], ["id", "line", "n_bytes", "good"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, line bigint, n_bytes bigint, good double")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose text scores at least `threshold`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in common.byte_lists(batch.column(place), CHUNK):
                yield batch.slice(at, len(texts)).filter(pa.array(chunk_scores(shared.value, texts) >= threshold))

    return docs.mapInArrow(run, docs.schema)
