"""Document fingerprints: bottom-k sketches of hashed word shingles.

A sketch holds the ``k`` smallest distinct hashes of a text's five-word shingles as hex text, eight digits a
hash, in rising order. Sketches of parts merge into the sketch of the whole by keeping the k smallest of
their union; two sketches estimate resemblance and containment, and one alone the number of distinct
shingles.

Defined cases: a null text counts as empty; a text without words has an empty sketch; two empty sketches
have resemblance 1, an empty and a filled one 0. Equal texts have equal sketches.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import batch_chunks, materialise, narrowed, one_worker_each, small_batches
from reviewloom.llm.words import text_shingles

K = 128
# Bytes of text in a run of neighbouring documents, of which a task works on one.
RUN_BYTES = 32 << 20
_SPACE = float(1 << 32)


def sketches(data: np.ndarray, offsets: np.ndarray, k: int = K) -> list[np.ndarray]:
    """The ``k`` smallest distinct 32-bit shingle hashes of every text."""
    hashes, at = text_shingles(data, offsets)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    found = []
    for start, end in zip(at[:-1], at[1:]):
        own = short[start:end]
        # repeats may fill the front, so take distinct values of a growing front until there are k
        front = 2 * k
        while True:
            part = own if front >= len(own) else np.partition(own, front)[:front]
            low = np.unique(part)
            if len(low) >= k or front >= len(own):
                break
            front *= 4
        found.append(low[:k])
    return found


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def from_text(sketch: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(sketch), ">u4").astype(np.uint32)


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of what two sketches were made of."""
    return np.union1d(a, b)[:k]


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles: exact below ``k``."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) * _SPACE / (float(sketch[k - 1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the share of the union's bottom k that both hold. Exact for small sets."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    union = merged(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum()) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    if len(a) == 0:
        return 1.0
    share = resemblance(a, b, k)
    union = distinct_count(merged(a, b, k), k)
    return min(1.0, share * union / max(distinct_count(a, k), 1.0))


def merge_groups(parts: DataFrame, key: str, sketch: str = "fingerprint", k: int = K) -> DataFrame:
    """(key, fingerprint) of all parts of each key. Values are made distinct first, so a hot key is met as
    a map-side combine over its k smallest values and never as a list of its parts."""
    count = F.floor(F.length(sketch) / 8).cast("int")
    digits = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.substring(F.col(sketch), i * 8 - 7, F.lit(8)))
    listed = F.when(F.length(sketch) > 0, digits)
    per_part = parts.select(F.col(key), F.posexplode_outer(listed).alias("place", "value")).where(F.coalesce("place", F.lit(0)) < k)
    order = Window.partitionBy(key).orderBy("value")
    ranked = per_part.select(key, "value").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    listed = ranked.groupBy(key).agg(F.array_sort(F.collect_list("value")).alias("v"))
    return listed.select(key, F.concat_ws("", "v").alias(sketch))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, fingerprint, n_shingles): a map over the texts without a shuffle."""
    rows = narrowed(docs, "doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text"):
                own = sketches(data, offsets, k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([to_text(s) for s in own], pa.string()), pa.array([distinct_count(s, k) for s in own], pa.float64())],
                    ["doc_id", "fingerprint", "n_shingles"],
                )

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string, n_shingles double")


def with_successor(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows (part, doc_id, text, borrowed) dealt out so that each task holds whole runs in descending order.

    Ids are cut into ``ranges`` runs at approximate quantiles. The first row of every run is also given, as a
    borrowed row, to the run before it, and the first row of all to the last run. So the successor of each
    row is the next row of its run, and the texts are moved only once.
    """
    rows = narrowed(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*[F.lit(s) for s in shares]), F.lit(10 * ranges)).alias("q")).first().q if shares else []
    cuts = sorted({c for c in cuts or []}, reverse=True)
    run = F.lit(0)
    if cuts:
        # the number of cuts that lie above the id: first among every ``leap``-th, then between two of those
        leap = math.isqrt(len(cuts)) + 1
        above = lambda lows: F.size(F.filter(lows, lambda c: c > F.col("doc_id")))
        leaps = above(F.lit(cuts[leap - 1 :: leap])) * leap
        run = F.coalesce(leaps + above(F.slice(F.lit(cuts), leaps + 1, F.lit(leap - 1))), F.lit(len(cuts)))
        run = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(run)
    placed = rows.withColumn("part", run.cast("int"))
    keys = narrowed(docs, "doc_id").select(F.col("doc_id").cast("bigint").alias("doc_id")).withColumn("part", run.cast("int"))
    # the first id of each run, at most ``ranges`` rows; null ids stand last
    heads = materialise(keys.groupBy("part").agg(F.max("doc_id").alias("head")), "heads")
    everything = heads.agg(F.array_sort(F.collect_list("part")).alias("parts")).first().parts
    before = {p: everything[i - 1] if i else everything[-1] for i, p in enumerate(everything)}
    to = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("part")) if before else F.lit(0)
    first = placed.join(F.broadcast(heads), "part").where(F.col("doc_id").eqNullSafe(F.col("head")))
    # of repeated ids the row with the smallest text leads, as it does in its own run
    first = first.groupBy("part", "doc_id").agg(F.min("text").alias("text"))
    borrowed = first.select(to.cast("int").alias("part"), "doc_id", "text", F.lit(1).alias("borrowed"))
    own = placed.select("part", "doc_id", "text", F.lit(0).alias("borrowed"))
    return (
        own.unionByName(borrowed)
        .repartitionById(max(1, ranges), "part")
        .sortWithinPartitions("part", "borrowed", F.col("doc_id").desc_nulls_last(), "text")
    )


def edited_fingerprints(docs: DataFrame, k: int = K, ranges: int | None = None) -> DataFrame:
    """Fingerprint of every text and of its edit, whose last half is taken from the next document.

    Documents are ordered by descending id, repeated ids by text, null ids last; the last is followed by the
    first. The last floor(n / 2) code points are replaced by as many first ones of the next text. Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if ranges is None:
        size = narrowed(docs, "text").agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(one_worker_each(spark), -(-size // RUN_BYTES))
    dealt = with_successor(docs, ranges)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row, whose successor is not there yet

        def finished(rows: list[tuple]) -> pa.RecordBatch:
            """rows: (doc_id, text, sketch, next text, next sketch)"""
            edits = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for _, t, _, n, _ in rows]
            raw = [e.encode() for e in edits]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
            after = sketches(np.frombuffer(b"".join(raw), np.uint8), offsets, k)
            columns = [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([len(r[1]) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                pa.array([to_text(r[2]) for r in rows], pa.string()),
                pa.array([to_text(s) for s in after], pa.string()),
                pa.array([resemblance(r[2], s, k) for r, s in zip(rows, after)], pa.float64()),
                pa.array([resemblance(r[2], r[4], k) for r in rows], pa.float64()),
                pa.array([distinct_count(r[2], k) for r in rows], pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, OUT)

        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text"):
                own = sketches(data, offsets, k)
                texts = part.column(2).to_pylist()
                rows = []
                for p, i, text, borrowed, sketch in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, part.column(3).to_pylist(), own):
                    if waiting is not None and waiting[0] == p:
                        rows.append((*waiting[1:], text, sketch))
                    waiting = None if borrowed else (p, i, text, sketch)
                if rows:
                    yield finished(rows)

    OUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles"]
    return dealt.mapInArrow(
        work,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_shingles double",
    )
