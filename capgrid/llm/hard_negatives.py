"""Hard-negative mining over an inverted multi-index.

Vectors are cut into two halves; a codebook for each half (k-means on a
bounded sample, documented in `SAMPLE`) gives every row of the table a cell
(first code, second code).  For an anchor, the score of a cell's rows is at
most the sum of two half scores, each the product with the code's centre plus
the anchor half's length times the code's radius, the largest distance from
the centre that any indexed row has.  The multi-sequence heap therefore
visits cells by falling summed bounds and may stop at the first cell whose
bound lies below what is already held: the result is the exact one.

On Spark: rows lie in blocks of about `BLOCK` rows of one cell (a hot cell has many),
anchors in packs of about `PACK` of neighbouring cells.  A pack and a block meet in
one group, as one matrix product, if the heap of some anchor of the pack asks
for the block; a group's size does not depend on the data.  Two visits each find the
positives and then the negatives: the first takes the best cells until
`SEED` rows, its k-th score is the certificate's threshold, the second takes
the remaining cells whose bound reaches it.  Windows (share of the positive's score)
also skip cells that lie wholly above them.  The driver holds the codebooks and
one row a cell (at most `CODES`^2).

Defined results.  A row takes no part if its id, label or vector is null or a
component is null, non-finite or beyond +-2^20.  Shorter vectors are filled up
with zeros.  Rows that repeat an id are candidates each; an anchor never meets
rows of its own id; where an anchor's id is repeated, its smallest (label,
vector) is the anchor.  Equal scores go by smaller id.  An anchor without a
positive, and a positive without a row in its window, give no rows; so do
empty tables.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capgrid.llm.common import cut

SAMPLE = 4096  # rows that the codebooks are fitted on
CODES = 64  # most codes a half
CELL_ROWS = 256  # rows a cell that the number of codes aims at
BLOCK = 1024
PACK = 256
SEED = 4096  # rows of the first visit
_EDGE = float(1 << 20)
_META = ["cell", "block", "pack"]


# ---------------------------------------------------------------------------
# Index
# ---------------------------------------------------------------------------
def usable(df: DataFrame, id_col: str, label: Column, vector_col: str, scale: int, anchor: Column) -> DataFrame:
    """(id, label, vector array<double> of whole numbers, anchor) of the rows that take part."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda c: F.coalesce((F.abs(c) <= F.lit(_EDGE)) & ~F.isnan(c), F.lit(False)))
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), vector.alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)
    return rows.withColumn("vector", F.transform("vector", lambda c: F.floor(c * F.lit(float(scale))).cast("double")))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out, flat = np.zeros((len(lists), width)), lists.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(lists)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _packed(vectors: np.ndarray) -> pa.Array:
    width = vectors.shape[1] * 4
    data = vectors.astype(np.int32).tobytes()
    return pa.array([data[i * width : (i + 1) * width] for i in range(len(vectors))], pa.binary())


def _unpacked(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), np.int32).reshape(len(column), width).astype(float)


def codebook(points: np.ndarray, k: int) -> np.ndarray:
    """k-means centres (k-means++ start, 12 rounds, fixed seed)."""
    rng = np.random.default_rng(7)
    centres = points[:1]
    while len(centres) < min(k, len(points)):
        far = _squares(points, centres).min(1)
        if not far.any():
            break
        centres = np.vstack([centres, points[rng.choice(len(points), p=far / far.sum())]])
    for _ in range(12):
        near = _squares(points, centres).argmin(1)
        centres = np.array([points[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
    return centres


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1), 0)


def assign(rows: DataFrame, width: int, books: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Every row with its packed vector, cell, distances from both centres, and a number that spreads rows over blocks."""
    second = len(books[1])
    half = width // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            x = _matrix(batch.column(2), width)
            codes, far = [], []
            for part, book in zip((x[:, :half], x[:, half:]), books):
                code = _squares(part, book).argmin(1)
                codes.append(code)
                far.append(np.sqrt(((part - book[code]) ** 2).sum(1)) * (1 + 1e-9) + 1e-6)
            spread = np.arange(seen, seen + len(x)) & 0x7FFFFFFF
            seen += len(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _packed(x), batch.column(3), pa.array((codes[0] * second + codes[1]).astype(np.int32)),
                 pa.array(far[0]), pa.array(far[1]), pa.array(spread.astype(np.int32))],
                ["id", "label", "x", "anchor", "cell", "far1", "far2", "spread"],
            )

    return rows.mapInArrow(run, "id long, label string, x binary, anchor boolean, cell int, far1 double, far2 double, spread int")


class MultiIndex:
    """Codebooks, radii and row counts of the cells: all that the heap needs."""

    def __init__(self, width: int, books: tuple[np.ndarray, np.ndarray], cells: list):
        self.width, self.books = width, books
        self.block, self.seed = BLOCK, SEED  # travel with the index to the tasks
        self.shape = len(books[0]), len(books[1])
        self.rows = np.zeros(self.shape, np.int64)
        self.radii = np.zeros(self.shape[0]), np.zeros(self.shape[1])
        for cell, n, far1, far2 in cells:
            i, j = divmod(cell, self.shape[1])
            self.rows[i, j] = n
            self.radii[0][i], self.radii[1][j] = max(self.radii[0][i], far1), max(self.radii[1][j], far2)

    def blocks(self, cell: int) -> int:
        return int(-(-self.rows.flat[cell] // self.block))

    def bounds(self, anchor: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Highest and lowest half scores that rows of each code can have, for both halves."""
        half, high, low = self.width // 2, [], []
        for part, book, radius in zip((anchor[:half], anchor[half:]), self.books, self.radii):
            middle, reach = book @ part, np.linalg.norm(part) * radius
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
            high.append(middle + reach + slack)
            low.append(middle - reach - slack)
        return high, low

    def visit(self, high: list[np.ndarray]) -> Iterator[tuple[float, int, int]]:
        """(bound, first code, second code) of all cells that hold rows, by falling bound: the multi-sequence heap."""
        order = [np.argsort(-h, kind="stable") for h in high]
        heap, pushed = [(-(high[0][order[0][0]] + high[1][order[1][0]]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            a, b = int(order[0][i]), int(order[1][j])
            if self.rows[a, b]:
                yield -bound, a, b
            for i2, j2 in ((i + 1, j), (i, j + 1)):
                if i2 < self.shape[0] and j2 < self.shape[1] and (i2, j2) not in pushed:
                    pushed.add((i2, j2))
                    heapq.heappush(heap, (-(high[0][order[0][i2]] + high[1][order[1][j2]]), i2, j2))

    def cells(self, anchor: np.ndarray, windows: list[tuple[float, float]], certificates: list[float] | None) -> list[int]:
        """Cells to visit for score windows (low, high).

        Without certificates: the best cells that can meet a window, until `SEED` rows.
        With them (the least score of interest in each window): all further cells that can hold such a score.
        """
        high, low = self.bounds(anchor)
        floors = [w[0] for w in windows]
        least = min(floors if certificates is None else certificates)
        out, seeding, rows = [], True, 0
        for bound, a, b in self.visit(high):
            if bound < min(floors) or (not seeding and certificates is None) or (not seeding and bound < least):
                break
            bottom = low[0][a] + low[1][b]
            if not any(bound >= f and bottom <= w[1] for f, w in zip(floors, windows)):
                continue
            if seeding:
                if certificates is None:
                    out.append(a * self.shape[1] + b)
                rows += self.rows[a, b]
                seeding = rows < self.seed
            elif any(bound >= c and bottom <= w[1] for c, w in zip(certificates, windows)):
                out.append(a * self.shape[1] + b)
        return out


def build(rows: DataFrame) -> tuple[DataFrame, MultiIndex, DataFrame]:
    """(index rows, MultiIndex, anchors with their pack); all rows are indexed."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    width = max(size["width"] or 0, 2)
    sample = rows.orderBy(F.xxhash64("id", "vector")).limit(SAMPLE).select("vector").toArrow()
    points = _matrix(sample["vector"].combine_chunks(), width) if size["n"] else np.zeros((1, width))
    k = int(min(CODES, max(1, np.ceil(np.sqrt(size["n"] / CELL_ROWS)))))
    books = codebook(points[:, : width // 2], k), codebook(points[:, width // 2 :], k)
    index = cut(assign(rows, width, books))
    cells = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far1").alias("far1"), F.max("far2").alias("far2"), F.sum(F.col("anchor").cast("long")).alias("anchors")).orderBy("cell").collect()
    multi = MultiIndex(width, books, [(c["cell"], c["n"], c["far1"], c["far2"]) for c in cells])
    # Blocks of a cell by the rows' running number; packs fill up along the cells' order.
    blocks, first, packs, before = {}, {}, {}, 0
    for c in cells:
        blocks[c["cell"]] = multi.blocks(c["cell"])
        first[c["cell"]], packs[c["cell"]] = before // PACK, max(1, -(-c["anchors"] // PACK))
        before += c["anchors"]
    side = index.sparkSession.createDataFrame([(c, blocks[c], first[c], packs[c]) for c in blocks], "cell int, blocks int, first_pack long, packs int")
    index = index.join(F.broadcast(side), "cell")
    block = F.pmod(F.xxhash64("id", "spread"), F.col("blocks")).cast("int")
    pack = F.col("first_pack") + F.pmod(F.xxhash64("id"), F.col("packs"))
    anchors = index.filter("anchor").groupBy("id").agg(F.min(F.struct("label", "x")).alias("own"), F.min(pack).alias("pack"))
    anchors = anchors.select(F.col("id").alias("anchor"), F.col("own.label").alias("label"), F.col("own.x").alias("x"), "pack")
    return index.select("cell", block.alias("block"), "id", "label", "x"), multi, cut(anchors)


# ---------------------------------------------------------------------------
# Visits
# ---------------------------------------------------------------------------
def _requests(anchors: DataFrame, multi: MultiIndex) -> DataFrame:
    """One row for each anchor and block to visit; `anchors` has lows, highs and certificates (null on the first visit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _unpacked(batch.column("x"), multi.width)
            wanted = []
            for i in range(batch.num_rows):
                lows, highs, certificates = (batch.column(c)[i].as_py() for c in ("lows", "highs", "certificates"))
                windows = [(-np.inf if a is None else a, np.inf if b is None else b) for a, b in zip(lows, highs)]
                certificates = None if certificates is None else [w[0] if c is None else c for c, w in zip(certificates, windows)]
                wanted.append([{"cell": c, "blocks": multi.blocks(c)} for c in multi.cells(vectors[i], windows, certificates)] if windows else [])
            kind = pa.list_(pa.struct([("cell", pa.int32()), ("blocks", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(wanted, kind)], [*batch.schema.names, "wanted"])

    columns = ["anchor", "label", "x", "pack", "lows", "highs", "certificates"]
    asked = anchors.select(*columns).mapInArrow(run, "anchor long, label string, x binary, pack long, lows array<long>, highs array<long>, certificates array<long>, wanted array<struct<cell:int,blocks:int>>")
    asked = asked.withColumn("want", F.explode("wanted")).withColumn("block", F.explode(F.expr("sequence(0, want.blocks - 1)")))
    return asked.select(F.col("want.cell").alias("cell"), "block", *columns)


def _best(scores: np.ndarray, mask: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores of every row under the mask; columns stand in the order that breaks ties."""
    row, column = np.nonzero(mask)
    if len(row) > 64 * k * len(scores):  # first narrow wide masks down to what can still be among the k
        held = np.where(mask, scores, np.iinfo(np.int64).min)
        bar = np.partition(held, held.shape[1] - k, axis=1)[:, -k] if held.shape[1] > k else np.full(len(held), np.iinfo(np.int64).min)
        row, column = np.nonzero(mask & (held >= bar[:, None]))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _visit(index: DataFrame, requests: DataFrame, width: int, k: int, same_label: bool) -> DataFrame:
    """(anchor, place, id, score): the k best rows of each block in every score window of each anchor that asks for it."""

    def meet(key, rows: pa.Table, asks: pa.Table) -> pa.Table:
        rows = rows.sort_by("id") if rows.num_rows else rows
        out = {"anchor": [], "place": [], "id": [], "score": []}
        if rows.num_rows and asks.num_rows:
            ids, anchors = rows["id"].to_numpy(), asks["anchor"].to_numpy()
            scores = _products(_unpacked(asks["x"], width), _unpacked(rows["x"], width))
            _, codes = np.unique(np.array(asks["label"].to_pylist() + rows["label"].to_pylist(), object), return_inverse=True)
            fits = (codes[: len(anchors), None] == codes[len(anchors) :]) == same_label
            fits &= anchors[:, None] != ids
            lows, highs, certificates = (asks[c].to_pylist() for c in ("lows", "highs", "certificates"))
            end = np.iinfo(np.int64)
            for place in range(max(map(len, lows))):
                here = [len(w) > place for w in lows]
                low = np.array([end.max if not h else end.min if w[place] is None else w[place] for h, w in zip(here, lows)])
                high = np.array([end.min if not h else end.max if w[place] is None else w[place] for h, w in zip(here, highs)])
                least = np.array([end.min if not h or c is None or c[place] is None else c[place] for h, c in zip(here, certificates)])
                row, column = _best(scores, fits & (scores >= np.maximum(low, least)[:, None]) & (scores <= high[:, None]), k)
                out["anchor"].append(anchors[row])
                out["place"].append(np.full(len(row), place, np.int32))
                out["id"].append(ids[column])
                out["score"].append(scores[row, column])
        kinds = {"anchor": np.int64, "place": np.int32, "id": np.int64, "score": np.int64}
        return pa.table({c: np.concatenate(v).astype(kinds[c]) if v else np.zeros(0, kinds[c]) for c, v in out.items()})

    packs = requests.select(*[F.col(c).alias(c) for c in _META]).distinct()
    met = index.join(packs, ["cell", "block"]).groupBy(*_META).cogroup(requests.groupBy(*_META))
    return met.applyInArrow(meet, "anchor long, place int, id long, score long")


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles where no partial sum can be rounded, else in longs."""
    top = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1)
    if top < 1 << 53:
        return (a @ b.T).astype(np.int64)
    if top < float(1 << 62):
        return a.astype(np.int64) @ b.astype(np.int64).T
    return (a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T).astype(np.int64)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every (anchor, place), with their rank."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(index: DataFrame, multi: MultiIndex, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """(anchor, place, id, score, rank): the k best rows in each of the anchors' windows (lows, highs), exactly."""
    first = anchors.withColumn("certificates", F.lit(None).cast("array<long>"))
    seeded = cut(_top(_visit(index, _requests(first, multi), multi.width, k, same_label), k))
    # The k-th score held in a window is the certificate: nothing below it can enter.
    kth = seeded.filter(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("held"))
    places = F.sequence(F.lit(0), F.size("lows") - 1)
    nothing = F.lit(None).cast("long")
    certified = anchors.join(kth, "anchor", "left").withColumn("certificates", F.transform(places, lambda p: F.coalesce(F.col("held")[p], nothing)))
    rest = _visit(index, _requests(certified, multi), multi.width, k, same_label)
    return _top(rest.unionByName(seeded.drop("rank")), k)


def mine(
    df: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 256, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are products of floor(scale * component).  For each anchor's best
    `positives` rows of its label, the best `negatives` rows of other labels
    whose score is between the window's two percentages of the positive's.
    """
    index, multi, anchors = build(usable(df, id_col, label, vector_col, scale, anchor))
    anything = F.array(F.lit(None).cast("long"))
    found = cut(_search(index, multi, anchors.withColumns({"lows": anything, "highs": anything}), positives, True))
    least, most = window
    own = found.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("own"))
    # ceil and floor of whole percentages; a negative score leaves a window without numbers (low above high).
    low = F.transform("own", lambda p: -F.floor((-p["score"] * least) / F.lit(100)).cast("long"))
    high = F.transform("own", lambda p: F.floor((p["score"] * most) / F.lit(100)).cast("long"))
    windows = anchors.join(own, "anchor").withColumns({"lows": low, "highs": high})
    ranked = _search(index, multi, cut(windows), negatives, False)
    named = ranked.join(windows.select("anchor", "own"), "anchor").withColumn("positive", F.col("own")[F.col("place")])
    return named.select(
        F.col("anchor").alias("anchor_id"), F.col("positive.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
