"""Quality rules: plain text statistics and a hashed n-gram likelihood ratio.

Words and pairs of neighbouring words are hashed into `buckets`.  Counted over
all documents they give the raw multinomial, counted over the trusted ones the
target multinomial (both with add-one smoothing).  A text's score is the mean,
over its n-grams, of log target minus log raw probability; a text is kept if
it passes the base rules and its score is at least a fixed threshold.

Everything stays in DataFrame functions: the count is an explode with a
map-side partial aggregation to at most `buckets` rows, and the ratios reach
the scoring pass as one array from a scalar subquery (8 bytes a bucket).

Repeated three-word windows are found inside the row: window hashes are
compared by a distinct count first, and only texts that have repeats sort
them.  Two different windows of one text would have to share a 64-bit hash to
be taken for a repeat.

The threshold is derived from labels that play no part in the scores they are
set against (`separating_threshold`): labelled texts are scored in folds, each
with the target of the other folds, and the point with the widest gap between
the kept shares of good and bad texts is taken.

Defined results.  Null and empty texts have no words: all counts zero, score
zero, base rules failed.  Without trusted documents all scores are zero.
Repeated rows count as documents each; a trusted id marks every row that has
it; null ids are never trusted.  Only the id and text are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capgrid.llm import common

BUCKETS = 1 << 14
#: `separating_threshold` of the sf0.1 labels outside the held-out fold; of that fold no good text scores below it and no bad one above.
THRESHOLD = -0.065
_BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words between ASCII white space."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def _pair(hashes: str, i: Column) -> Column:
    return F.xxhash64(F.get(hashes, i - 1), F.get(hashes, i))


def _indices(first: int, last: Column) -> Column:
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row: `ratios`, log target minus log raw probability of every bucket."""
    marked = common.broadcast_if_small(trusted.select(F.col(id_col).alias("trusted_id")).filter(F.col("trusted_id").isNotNull()).distinct(), 16)
    split = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w")).join(marked, F.col("id") == F.col("trusted_id"), "left")
    # each word beside the next one, so that hashing runs on exploded rows in generated code
    beside = split.select(F.col("trusted_id").isNotNull().cast("int").alias("t"), F.explode(F.arrays_zip("w", F.slice("w", F.lit(2), F.size("w")).alias("next"))).alias("z"))
    hashed = beside.select("t", F.xxhash64("z.w").alias("h"), F.when(F.col("z.next").isNotNull(), F.xxhash64("z.next")).alias("next"))
    single, double = _bucket(F.col("h"), buckets), _bucket(F.xxhash64("h", "next"), buckets)
    grams = hashed.select("t", F.explode(F.when(F.col("next").isNull(), F.array(single)).otherwise(F.array(single, double))).alias("bucket"))
    counted = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counted, "bucket", "left").select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    sums = full.agg(F.sum("raw").alias("raw_all"), F.sum("target").alias("target_all"), F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("by"))
    ratio = lambda b: (
        F.log((b["target"] + 1) / (F.col("target_all") + buckets)) - F.log((b["raw"] + 1) / (F.col("raw_all") + buckets))
    )
    return sums.select(F.transform("by", lambda b: F.when(F.col("target_all") > 0, ratio(b)).otherwise(0.0)).alias("ratios"))


def evaluate(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept)."""
    ratios = log_ratios(docs, trusted, buckets, id_col, text_col).scalar()
    text = F.coalesce(F.col(text_col), F.lit(""))
    first = docs.select(F.col(id_col).alias("id"), text.alias("text"), words(F.col(text_col)).alias("w"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    second = first.select(
        "id",
        F.size("w").alias("n"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("h"),
    )
    third = second.select(
        "id", "n", "word_chars", "n_symbols", "h",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(_indices(1, F.col("n") - 2), lambda i: F.xxhash64(F.get("h", i - 1), F.get("h", i), F.get("h", i + 1))).alias("win"),
    )
    total = F.aggregate(
        _indices(1, F.col("n")),
        F.lit(0.0),
        lambda a, i: a + F.get("ratios", _bucket(F.get("h", i - 1), buckets)) + F.when(i < F.col("n"), F.get("ratios", _bucket(_pair("h", i), buckets))).otherwise(0.0),
    )
    fourth = third.withColumn("ratios", ratios).select(
        "id", "n", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.size(F.array_distinct("win")) < F.size("win"), F.sort_array(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("sorted"),
        F.when(F.col("n") > 0, total / (2 * F.col("n") - 1)).otherwise(0.0).alias("score"),
    )
    both = F.zip_with(
        F.slice("sorted", F.lit(1), F.size("sorted") - 1), F.slice("sorted", F.lit(2), F.size("sorted") - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.flatten(both), lambda i: F.array(i, i + 1, i + 2)))))
    fifth = fourth.select(
        "id", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("sorted").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"), "score",
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return fifth.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def separating_threshold(docs: DataFrame, labels: DataFrame, folds: int = 3, bin_width: float = 0.005, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> float:
    """Score that best separates `labels` (id, quality) of texts that pass the base rules.

    Each fold of the labels is scored with the target learned from the other
    folds.  Of the bin edges where the kept share of good texts less that of bad
    ones is greatest, the middle one.  At most one row a bin is read.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1)).select(F.col(id_col).alias("label_id"), "quality", F.pmod(F.xxhash64(id_col, F.lit("fold")), F.lit(folds)).alias("fold"))
    scored = []
    for i in range(folds):
        target = known.filter((F.col("fold") != i) & (F.col("quality") == 1)).select(F.col("label_id").alias(id_col))
        # cut, as a filter pushed into the scores would compute them twice
        one = common.cut(evaluate(docs, target, buckets=buckets, id_col=id_col, text_col=text_col).select("id", "score", "base_failed"))
        scored.append(one.filter(~F.col("base_failed")).join(known.filter(F.col("fold") == i), F.col("id") == F.col("label_id")).select("score", "quality"))
    every = reduce(DataFrame.unionAll, scored)
    rows = every.groupBy(F.floor(F.col("score") / bin_width).cast("long").alias("bin")).agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")).collect()
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    if not good or not bad:
        raise ValueError("labels of both kinds are needed to derive a threshold")
    edges = range(min(r["bin"] for r in rows), max(r["bin"] for r in rows) + 2)
    gap = {e: sum(r["good"] / good - r["bad"] / bad for r in rows if r["bin"] >= e) for e in edges}
    best = [e for e in edges if gap[e] >= max(gap.values()) - 1e-12]
    return best[len(best) // 2] * bin_width
