"""Session helpers: a local session for tests and lineage cutting."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FIXED_WIDTH = {"byte", "short", "integer", "long", "float", "double", "boolean", "date", "timestamp"}

#: Settings every job in the library is written against.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "capgrid") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only when unset.

    On a cluster `spark.checkpoint.dir` names a shared folder and is used as
    is.  Only a local test session without it gets a fresh temporary folder,
    which is removed when the session's process ends; other masters fail.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set: master {master} needs a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="capgrid-ckpt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, limit: int = 32 * 1024 * 1024, measured: DataFrame | None = None) -> DataFrame:
    """Mark `df` for broadcast if its rows, measured by one aggregate, fit in `limit` bytes; else leave the join to shuffle.

    Texts, arrays and other values of any length count with the length of
    their text form.  `measured`, when given, is a table known to have as many
    rows and cheaper to count; it gives the number of rows, at 64 bytes for
    each value of any length.  Pass tables that are cheap to read twice (cut,
    or read from files): the measure runs the plan of what it is given.
    """
    fixed = 16 + 8 * len(df.schema.fields)
    loose = [f.name for f in df.schema.fields if f.dataType.typeName() not in _FIXED_WIDTH]
    if measured is not None:
        size = measured.count() * (fixed + 56 * len(loose))
    else:
        lengths = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in loose), F.lit(fixed))
        size = df.agg(F.sum(lengths).alias("n")).first()["n"] or 0
    return F.broadcast(df) if size <= limit else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def cluster_conf(total_input_bytes: int, executor_cores: int = 4, executors: int = 1000) -> dict:
    """Recommended settings for a large run (returned, not applied).

    Scans split at 256 MB; the initial shuffle partition count is sized so a
    partition holds about 256 MB of the input (AQE then coalesces small ones
    and splits skewed ones); broadcasts are decided by the library's own
    measured checks, so the automatic threshold stays modest.
    """
    target = 256 * 1024 * 1024
    partitions = max(executors * executor_cores * 2, total_input_bytes // target)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "5000",
    }
