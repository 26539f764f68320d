"""Uniform random shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows each source partition sends to each target is drawn first: the
matrix of a uniformly random permutation, with the partitions' row counts as
row sums and the wanted sizes as column sums.  Then every partition permutes
its rows locally and deals them out by its matrix row, the rows are exchanged
once, and every target permutes what it received.  A shard is made of
`chunks` targets, so no task holds a whole shard.

The matrix is drawn down a binary tree over the partitions: a node splits its
column totals between its two halves by a multivariate hypergeometric draw
(one univariate draw per column), so the halves are independent.  Groups of
about the square root of the partitions' number are drawn first, then each
group's partitions, in tasks of their own: no row of the tree holds more
partitions than that.

A univariate draw costs the same at every size.  Up to a standard deviation of
20 it inverts the distribution, built from ratios of neighbouring
probabilities outward from the mode, 12 standard deviations and 24 more on
each side or the whole support if that is less.  Beyond, it is Stadlober's
ratio-of-uniforms rejection; about four of five trials are accepted, 40 are
at hand, and inversion stands behind them.  The log probability ratio to the
mode is taken from differences of Stirling's series, so its error stays below
1e-9 for 1e12 rows.

All randomness comes from hashes of a seed with the tree position or the
row's `by` columns, so a task that is run again gives the same rows.  Rows that
agree in `by` are interchangeable.

Defined results.  `by` columns may be null.  Repeated rows each get a slot.
With fewer rows than shards some shards are empty; empty input gives empty
output.  Extra columns are carried; result columns replace same-named ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capgrid.llm import common


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of `parts`."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


#: Fixed values of the ratio-of-uniforms hat: 2 sqrt(2 / e) and 3 - 2 sqrt(3 / e).
_HAT_SLOPE, _HAT_SHIFT = 1.7155277699214135, 0.8989161620588988
_INVERT_UP_TO = 20  # standard deviations; above, every cell at the mode holds at least 400
_TRIALS = 40


def _log_factorial_change(v: Column, delta: Column) -> Column:
    """log((v + delta)!) - log(v!) - delta log(v) + delta, for v and v + delta of 80 or more."""
    rest = lambda w: (F.lit(1.0) / 12 - (F.lit(1.0) / 360 - F.lit(1.0) / (F.lit(1260.0) * w * w)) / (w * w)) / w
    return (v + delta + 0.5) * F.log1p(delta / v) + rest(v + delta) - rest(v)


def _rejection(v: Column) -> Column:
    """A hypergeometric draw by ratio of uniforms, for a spread above 20; null if every trial is refused."""
    n, k, d, u = v["n"], v["k"], v["d"], v["u"]

    def trials(r: Column) -> Column:
        """Draws the smaller sample's count of the smaller kind."""
        small, m, sd, mode = r["small"], r["m"], r["sd"], r["mode"]
        width = F.lit(_HAT_SLOPE) * F.sqrt(sd * sd + 0.5) + F.lit(_HAT_SHIFT)

        def gain(delta: Column) -> Column:
            """log p(mode + delta) - log p(mode)."""
            a, b, c, e = mode, small - mode, m - mode, r["n"] - small - m + mode
            change = _log_factorial_change(a, delta) + _log_factorial_change(b, -delta) + _log_factorial_change(c, -delta) + _log_factorial_change(e, delta)
            return -(change + delta * F.log((a / b) * (e / c)))

        def attempt(x: Column, i: Column) -> Column:
            across = F.lit(1.0) - uniform(u, i * 2)
            at = r["center"] + width * (uniform(u, i * 2 + 1) - 0.5) / across
            tried = _let(
                F.struct(across.alias("across"), F.floor(at).cast("double").alias("z")),
                lambda t: F.when((F.abs(t["z"] - mode) <= sd * 16) & (F.log(t["across"]) * 2 <= gain(t["z"] - mode)), t["z"]),
            )
            return F.when(x.isNotNull(), x).otherwise(tried)

        return F.aggregate(F.sequence(F.lit(0), F.lit(_TRIALS - 1)), F.lit(None).cast("double"), attempt)

    small, m = F.least(k, n - k).cast("double"), F.least(d, n - d).cast("double")
    total = n.cast("double")
    reduced = F.struct(
        total.alias("n"), small.alias("small"), m.alias("m"), v["spread"].alias("sd"), (m * small / total + 0.5).alias("center"),
        F.floor((m + 1) * (small + 1) / (total + 2)).cast("double").alias("mode"),
    )
    drawn = _let(reduced, trials).cast("long")
    marked = F.when(k > n - k, F.least(d, n - d) - drawn).otherwise(drawn)  # of the smaller sample
    return F.when(d > n - d, k - marked).otherwise(marked)


def hypergeometric(population: Column, marked: Column, draws: Column, u: Column) -> Column:
    """How many of `draws` rows taken from `population` are among its `marked` ones, for u in [0, 1)."""
    zero, one = F.lit(0).cast("long"), F.lit(1.0)

    def walk(v: Column) -> Column:
        n, k, d = v["n"], v["k"], v["d"]
        up = lambda x: (k - x).cast("double") * (d - x).cast("double") / ((x + 1).cast("double") * (n - k - d + x + 1).cast("double"))  # noqa: E731  p(x + 1) / p(x)
        steps = lambda first, last: F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        above, below = steps(v["mode"], v["high"] - 1), F.reverse(steps(v["low"], v["mode"] - 1))
        total = lambda xs, ratio: F.aggregate(xs, F.struct(one.alias("w"), F.lit(0.0).alias("s")), lambda a, x: _let(a["w"] * ratio(x), lambda w: F.struct(w.alias("w"), (a["s"] + w).alias("s"))), lambda a: a["s"])
        down = lambda x: one / up(x)  # noqa: E731  p(x) / p(x + 1)

        def find(goal: Column) -> Column:
            """The first value, in the order mode, above, below, whose cumulative weight exceeds the goal."""
            begin = lambda cum: F.struct(one.alias("w"), cum.alias("c"), F.lit(None).cast("long").alias("x"))
            move = lambda ratio, value: (lambda a, x: _let(a["w"] * ratio(x), lambda w: F.struct(w.alias("w"), (a["c"] + w).alias("c"), F.coalesce(a["x"], F.when(a["c"] + w > goal, value(x))).alias("x"))))
            rise = F.aggregate(above, begin(one), move(up, lambda x: x + 1))
            return F.when(goal < one, v["mode"]).otherwise(
                _let(rise, lambda a: F.coalesce(a["x"], F.aggregate(below, begin(a["c"]), move(down, lambda x: x), lambda b: b["x"]), v["mode"]))
            )

        return _let(v["u"] * (one + total(above, up) + total(below, down)), find)

    mean = draws.cast("double") * marked / F.greatest(population, F.lit(1))
    spread = F.sqrt(mean * (population - marked) / F.greatest(population, F.lit(1)) * (population - draws) / F.greatest(population - 1, F.lit(1)))
    reach = F.ceil(spread * 12).cast("long") + 24
    low, high = F.greatest(zero, draws - (population - marked)), F.least(draws, marked)
    mode = F.least(high, F.greatest(low, F.floor((draws + 1).cast("double") * (marked + 1) / (population + 2)).cast("long")))
    bounds = F.struct(population.alias("n"), marked.alias("k"), draws.alias("d"), u.alias("u"), mode.alias("mode"), spread.alias("spread"), reach.alias("reach"), low.alias("lo"), high.alias("hi"))
    ranged = lambda b: F.struct(*[b[c].alias(c) for c in ("n", "k", "d", "u", "mode", "spread")], F.greatest(b["lo"], b["mode"] - b["reach"]).alias("low"), F.least(b["hi"], b["mode"] + b["reach"]).alias("high"))
    return _let(_let(bounds, ranged), lambda v: F.coalesce(F.when(v["spread"] > _INVERT_UP_TO, _rejection(v)), walk(v)))


def split_columns(columns: Column, draws: Column, *seed: Column) -> Column:
    """How many of `draws` rows fall to each column, given the columns' totals (an array)."""
    start = F.struct(F.array().cast("array<bigint>").alias("got"), draws.alias("d"), F.aggregate(columns, F.lit(0).cast("long"), lambda a, c: a + c).alias("n"))

    def take(a: Column, k: Column) -> Column:
        x = hypergeometric(a["n"], k, a["d"], uniform(*seed, F.size(a["got"])))
        return _let(x, lambda x: F.struct(F.concat(a["got"], F.array(x)).alias("got"), (a["d"] - x).alias("d"), (a["n"] - k).alias("n")))

    return F.aggregate(columns, start, take, lambda a: a["got"])


def _draw_rows(nodes: DataFrame, levels: int, seed: int, step: int) -> DataFrame:
    """(of, part, sends) from rows (of, parts array of 2 ** levels (part, n), columns): the parts' shares of the columns, down a binary tree."""
    node = nodes.select("of", F.lit(0).cast("long").alias("at"), "parts", "columns")
    for level in range(levels):
        half = 1 << (levels - level - 1)
        first, second = F.slice("parts", 1, half), F.slice("parts", half + 1, half)
        rows = F.aggregate(first, F.lit(0).cast("long"), lambda a, p: a + p["n"])
        left = split_columns(F.col("columns"), rows, F.lit(seed), F.lit(step), F.lit(level), F.col("of"), F.col("at"))
        drawn = node.select("of", "at", first.alias("first"), second.alias("second"), "columns", left.alias("left"))
        rest = F.zip_with("columns", "left", lambda c, x: c - x)
        child = lambda at, parts, columns: F.struct(at.alias("at"), parts.alias("parts"), columns.alias("columns"))
        node = drawn.select("of", F.explode(F.array(child(F.col("at") * 2, F.col("first"), F.col("left")), child(F.col("at") * 2 + 1, F.col("second"), rest))).alias("c")).select("of", "c.*")
        if level % 4 == 3:
            node = node.repartition("of", "at")  # later levels have more nodes than one task should draw
    return node.select("of", F.get("parts", F.lit(0))["part"].alias("part"), F.col("columns").alias("sends")).where("part >= 0")


def _padded(parts: Column, levels: int) -> Column:
    """`parts` sorted, filled up to 2 ** levels with empty ones."""
    none = F.struct(F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("n"))
    return F.concat(F.array_sort(parts), F.array_repeat(none, F.lit(1 << levels) - F.size(parts)))


def communication_matrix(counts: DataFrame, targets: list[int], seed: int = 0) -> DataFrame:
    """(part, sends array<bigint>) from (part, n), parts numbered from 0: rows that each part sends to each target."""
    last = counts.agg(F.max("part")).first()[0]
    levels = (0 if last is None else int(last)).bit_length()
    low = levels // 2  # a group is 2 ** low partitions
    grouped = counts.groupBy(F.shiftright(F.col("part").cast("long"), low).alias("of")).agg(
        F.collect_list(F.struct(F.col("part").cast("long").alias("part"), F.col("n").cast("long").alias("n"))).alias("parts"), F.sum("n").cast("long").alias("n")
    )
    grouped = common.cut(grouped)
    top = grouped.groupBy().agg(F.collect_list(F.struct(F.col("of").alias("part"), "n")).alias("parts"))
    top = top.select(F.lit(0).cast("long").alias("of"), _padded(F.col("parts"), levels - low).alias("parts"), F.array(*[F.lit(t).cast("long") for t in targets]).alias("columns"))
    shares = _draw_rows(top, levels - low, seed, 0).select(F.col("part").alias("of"), F.col("sends").alias("columns"))
    below = grouped.join(shares, on="of").select("of", _padded(F.col("parts"), low).alias("parts"), "columns").repartition("of")
    return _draw_rows(below, low, seed, 1).select(F.col("part").cast("int").alias("part"), "sends")


def _count_up_to(ends: Column, value: Column, n: int) -> Column:
    """How many of n ascending numbers are at most `value` (binary search)."""

    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        return F.when(a["lo"] >= a["hi"], a).when(F.get(ends, middle) <= value, F.struct((middle + 1).alias("lo"), a["hi"].alias("hi"))).otherwise(F.struct(a["lo"].alias("lo"), middle.alias("hi")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(n.bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")), halve, lambda a: a["lo"])


def exact_sizes(n: int, parts: int) -> list[int]:
    """Sizes at most one apart that add up to n."""
    return [n // parts + (i < n % parts) for i in range(parts)]


def shuffle_into_shards(df: DataFrame, by: list[str], n_shards: int = 8, min_chunks: int = 8, chunk_rows: int = 50_000_000, seed: int = 0) -> DataFrame:
    """`df` with `shard` (sizes at most one apart) and `slot` (gapless from 0): a uniform random shuffle.

    A shard's targets hold at most about `chunk_rows` rows.  `df` is written
    once to the checkpoint folder: its files are the source partitions that
    the counts and the dealing both read.
    """
    df = common.without(df, "shard", "slot")
    part, rank, chunk, sends = (common.fresh(n, df.columns) for n in ("shuffle_part", "shuffle_rank", "shuffle_chunk", "shuffle_sends"))
    source = common.cut(df)
    counts = common.cut(source.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    chunks = max(min_chunks, -(-total // (n_shards * chunk_rows)))
    per_shard = [exact_sizes(s, chunks) for s in exact_sizes(total, n_shards)]
    targets = [size for sizes in per_shard for size in sizes]
    matrix = common.cut(communication_matrix(counts, targets, seed))
    key = lambda step: F.xxhash64(F.lit(seed), F.lit(step), *by)
    local = source.sortWithinPartitions(key("deal"), *by).withColumn(rank, F.monotonically_increasing_id())
    local = local.withColumns({part: F.shiftright(rank, 33).cast("int"), rank: F.col(rank).bitwiseAND(F.lit((1 << 33) - 1))})
    ends = F.aggregate("sends", F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)), lambda a: F.slice(a, 2, len(targets)))
    ends_by_part = common.broadcast_if_small(matrix, 8 * len(targets) + 32).select(F.col("part").alias(part + "_m"), ends.alias(sends))
    dealt = local.join(ends_by_part, F.col(part) == F.col(part + "_m"))
    dealt = dealt.withColumn(chunk, _count_up_to(F.col(sends), F.col(rank), len(targets))).drop(sends, rank, part, part + "_m")
    before = F.array(*[F.lit(sum(sizes[:i])).cast("long") for sizes in per_shard for i in range(chunks)])
    place = F.row_number().over(Window.partitionBy(chunk).orderBy(key("place"), *by)).cast("long") - 1
    return dealt.withColumns({"slot": place + F.get(before, F.col(chunk)), "shard": F.floor(F.col(chunk) / chunks).cast("int")}).drop(chunk)
