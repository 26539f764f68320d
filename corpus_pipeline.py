"""Corpus pipeline: quality classifier, line dedup, near-dedup, decontamination, packing.

`STAGES` lists (name, function) in order; each function takes (spark, docs,
sf_dir) and its result is written as Parquet and read back as the next one's
`docs`.  All stages but the last return the columns of `documents`.  No SQL
oracle: the classifier, fingerprints and tokenizer are not SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capgrid.llm import decontam, line_crf, line_dedup, packing, simhash
from capgrid.llm.common import read
from capgrid.llm.queries import vocabulary_path
from capgrid.session import scratch_path

ORACLE_SQL = None
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores at 0.3 or more."""
    return line_crf.keep_good(docs, line_crf.train(docs, read(spark, sf_dir, "labels")), threshold=0.3).select(*COLUMNS)


def line_dedup_by_site(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source; n_chars follows the text."""
    cleaned = line_dedup.drop_boilerplate(docs, F.col("source"))
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 4 or fewer bits."""
    return simhash.deduplicate(docs, shingle=4, distance=4).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"), remove="documents").select(*COLUMNS)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack(docs, vocabulary_path()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_by_site),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, with every stage's result written to the shared scratch folder."""
    docs = read(spark, sf_dir, "documents")
    folder = scratch_path(spark, f"corpus_pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
