"""Helpers shared by the corpus operators: reading, defined nulls, held-out folds, iterating Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.session import BROADCAST_ROWS, broadcast_if_small, has_at_most, materialise

# Ids that may be broadcast: 16-byte digests, about 50 MB with the hash table around them.
BROADCAST_IDS = 300_000

# Bytes of text that numpy works on at once inside a task; a longer text is one piece of its own.
CHUNK_BYTES = 1 << 19

__all__ = ["batch_chunks", "broadcast_if_small", "components", "fold", "materialise", "narrowed", "one_worker_each", "read", "semi", "small_batches", "text_array"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrowed(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns of the input cannot clash with an operator's own.

    Where the input has a name several times, also in other case, the exact and first one counts.
    """
    low = [c.lower() for c in df.columns]
    if len(set(low)) == len(low):
        return df.select(*columns)
    renamed = df.toDF(*[f"_c{i}" for i in range(len(low))])
    place = {c: df.columns.index(c) if c in df.columns else low.index(c.lower()) for c in columns}
    return renamed.select(*[F.col(f"_c{place[c]}").alias(c) for c in columns])


def fold(key: str | Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(buckets)


def one_worker_each(spark: SparkSession) -> int:
    """Partitions for work that is dealt out by key: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Bounds what travels to a Python worker at a time, unless the session is stricter already.

    Texts are long: the default of ten thousand rows or 64 MB would be held twice in the JVM and in the worker.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1_000), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        now = int(re.sub(r"\D", "", spark.conf.get(key)) or 0) if not spark.conf.get(key).startswith("-") else 0
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def semi(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids``. Few ids are broadcast, so that wide rows stay where they are."""
    return df.join(F.broadcast(ids) if has_at_most(ids, BROADCAST_IDS) else ids, key, "left_semi")


def text_array(column: pa.Array) -> pa.Array:
    """A text column with nulls as empty texts, without a slice offset into the middle of a buffer."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def batch_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes of text (one row, if longer): rows, UTF-8 bytes, offsets."""
    texts = text_array(batch.column(batch.schema.get_field_index(column)))
    n = len(texts)
    if n == 0:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        end = min(end, n)
        yield batch.slice(start, end - start), data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): every linked node with the smallest node it is connected to.

    ``links`` has the columns a and b. Large-star and small-star rounds: each stores its links in the shared
    folder, so a lost executor costs one round, and the number of rounds grows with the logarithm of the
    longest chain. They end when every node is the smallest of its neighbours or has one neighbour, a smaller one,
    and that is seen from the aggregate a round begins with. A hub is met by an aggregate and a join that adaptive
    execution can split; the smallest neighbours of few nodes are broadcast, so that links stay where they are.
    """
    smaller, larger = F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")
    edges = materialise(links.where(F.col("a") != F.col("b")).select(larger, smaller), label)
    while True:
        ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        both = edges.select(F.explode(ways).alias("way")).select("way.u", "way.v")
        below, above = F.max(F.when(F.col("v") < F.col("u"), F.col("v"))).alias("below"), F.max(F.col("v") > F.col("u")).alias("above")
        low = materialise(both.groupBy("u").agg(F.min("v").alias("m"), below, above), label)
        at_rest = F.col("below").isNull() | ((F.col("below") == F.col("m")) & ~F.col("above"))
        n_nodes, moving = low.agg(F.count(F.lit(1)), F.count_if(~at_rest)).first()
        low = low.select("u", F.least("m", "u").alias("m"))
        if not moving:
            return low.select(F.col("u").alias("node"), F.col("m").alias("root"))
        few = F.broadcast if n_nodes <= BROADCAST_ROWS else lambda df: df
        large = edges.join(few(low.withColumnRenamed("u", "v")), "v").select("u", F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        ways = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        small = large.join(few(least), "u").select(F.explode(ways).alias("way")).select("way.u", "way.v")
        edges = materialise(small.where(F.col("u") != F.col("v")).distinct(), label)
