"""Helpers shared by the operators: lineage cuts, measured broadcasts, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capgrid.session import ensure_checkpoint_dir

#: A side is broadcast only when its measured size is at most this.
BROADCAST_LIMIT = 64 * 1024 * 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint in the shared folder: later stages and retries read it, not its inputs."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(base: str, taken: Iterable[str]) -> str:
    """A column name that no column of the input has (Spark compares names without case)."""
    used = {c.lower() for c in taken}
    name = base
    while name.lower() in used:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop extra columns whose names an operator's own result columns need."""
    lowered = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lowered])


def broadcast_if_small(df: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Measure `df` (one aggregate) and mark it for broadcast only within `limit` bytes; otherwise leave the join to shuffle."""
    size = df.agg(F.coalesce(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(df) if size <= limit else df


def byte_lists(column: pa.Array | pa.ChunkedArray, chunk_bytes: int) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first row, UTF-8 texts) in runs of at most `chunk_bytes`, or one text; null gives an empty text."""
    run: list[bytes] = []
    size = first = 0
    for i, value in enumerate(column.cast(pa.binary())):
        text = value.as_buffer().to_pybytes() if value.is_valid else b""
        if run and size + len(text) > chunk_bytes:
            yield first, run
            run, size, first = [], 0, i
        run.append(text)
        size += len(text) + 1
    if run:
        yield first, run
