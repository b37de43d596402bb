"""Session settings, the shared scratch folder, and size checks used before broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have to be broadcast on request. Rows are lookup-sized (a few strings), so this
# stays in the tens of megabytes; anything larger takes the shuffled path.
BROADCAST_ROWS = 100_000

_local_scratch: dict[str, str] = {}


def build_session(app: str = "reviewloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for. Cluster settings win where present."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a skewed join partition even when that costs an extra shuffle afterwards
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and tasks share one disk, falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="reviewloom-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives the loss of executors, fixes values that depend on the
    physical layout, and gives the optimiser true sizes for the joins that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def has_at_most(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a row count; a larger frame is returned unhinted for a shuffled join."""
    return F.broadcast(df) if has_at_most(df, rows) else df


def spread(scan: DataFrame, key: str) -> DataFrame:
    """A scan that has fewer splits than there are cores, hashed over the cores by ``key``.

    Meant in front of work that costs far more than moving the row, such as pattern matching. A scan of
    many files is returned as it is, so large inputs are not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)
