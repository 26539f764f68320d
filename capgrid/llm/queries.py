"""One query per operator over its whole intended table; SQL oracles where SQL can express the result.

Each query calls its operator with production parameters and derives the
columns of its contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capgrid.llm import (
    byte_bpe, captures, decontam, hard_negatives, licenses, line_crf, line_dedup, packing, quality_rules, revisits, sharding, simhash, url_lists, whitening,
)
from capgrid.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def vocabulary_path() -> str:
    """Vocabulary file of the byte-level BPE tokenizer that the packing query names."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_revisit_resolution", captures.REVISIT_ORACLE)
def op1(spark, sf_dir):
    records = captures.warc_records(read(spark, sf_dir, "pages"))
    out = revisits.resolve(records, url_lists.canonical_url(F.col("url")))
    text = F.array_join(F.transform("merged_headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return out.select("record_id", "url", "fetch_time", "outcome", "refers_to", text.alias("merged_headers"))


@query("op2_license_scan")
def op2(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents")).drop("matches").withColumnRenamed("id", "doc_id")


@query("op3_quality_rules")
def op3(spark, sf_dir):
    trusted = read(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules.evaluate(read(spark, sf_dir, "documents"), trusted).withColumnRenamed("id", "doc_id")


@query("op4_uniform_shards")
def op4(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit(""))
    light = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash")
    )
    out = sharding.shuffle_into_shards(light, by=["doc_id", "text_hash"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op5_sequence_packing")
def op5(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary_path()).withColumnRenamed("id", "doc_id")


@query("op6_benchmark_hits")
def op6(spark, sf_dir):
    hits = decontam.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op7_simhash_components")
def op7(spark, sf_dir):
    groups = simhash.components(read(spark, sf_dir, "documents"), shingle=4, distance=4)
    return groups.select(F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query("op8_dated_url_lists", captures.LISTS_ORACLE)
def op8(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    out = url_lists.evaluate(captures.page_visits(pages), captures.list_events(pages))
    return out.select("page_id", "visit", "url", "day", "lists", "blocked")


@query("op9_line_crf_quality")
def op9(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = line_crf.train(docs, read(spark, sf_dir, "labels"))
    scored = line_crf.score(docs, model)
    return scored.select(F.col("id").alias("doc_id"), line_crf.in_fold(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


LINE_DEDUP_ORACLE = """
WITH split AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), total AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
seen AS (
  SELECT source, line, count(*) AS n FROM (
    SELECT source, unnest(list_distinct(list_filter(lines, lambda l: length(trim(l, ' ')) > 0))) AS line FROM split)
  GROUP BY source, line HAVING count(*) > 1
), often AS (
  SELECT s.source, list(s.line) AS cut FROM seen s JOIN total t ON s.source IS NOT DISTINCT FROM t.source
  WHERE s.n - sqrt(s.n) > 0.065 * t.pages GROUP BY s.source
), done AS (
  SELECT doc_id, text, lines, CASE WHEN cut IS NULL THEN lines ELSE list_filter(lines, lambda l: NOT list_contains(cut, l)) END AS kept
  FROM split LEFT JOIN often ON split.source IS NOT DISTINCT FROM often.source
)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_cut,
       CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text
FROM done
"""


@query("op10_site_boilerplate", LINE_DEDUP_ORACLE)
def op10(spark, sf_dir):
    out = line_dedup.drop_boilerplate(read(spark, sf_dir, "documents"), F.col("source"), counts=("n_lines", "n_cut"))
    return out.select("doc_id", "n_lines", "n_cut", "text")


@query("op11_embedding_whitening")
def op11(spark, sf_dir):
    out = whitening.whiten(read(spark, sf_dir, "embeddings"))
    each = out.select(F.col("id").alias("vec_id"), "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of"))
    return each.select("vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error")


@query("op12_prefix_bpe")
def op12(spark, sf_dir):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    both = byte_bpe.decode(encoded, ranks)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


NEGATIVES_ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.x, r.x)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""


@query("op13_hard_negatives", NEGATIVES_ORACLE)
def op13(spark, sf_dir):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, shifted)
