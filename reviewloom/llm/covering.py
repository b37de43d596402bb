"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has 64 bits: bit i is set where more than half of its shingle hashes have bit i set. Texts are
linked where their fingerprints differ in at most two bits.

Every bit place i carries a non-zero vector m(i) of three bits. For each of the seven non-zero vectors v there is a
table whose key is the fingerprint under the mask of the places with odd <m(i), v>. Two differing places span at most
two of three dimensions, so some v is orthogonal to both: in that table the two fingerprints have the same key. No
link within the radius is ever missed, whatever the masks' random choice would be elsewhere; keys hold 36 or 37 bits.

A crowded bucket is covered again in the same manner, over the places its key leaves free: 28, then 12, then 6 at
most, so that the third table's buckets hold 64 fingerprints or fewer. Inside a bucket all fingerprints are compared,
and what leaves the task is a forest of its links, one row per fingerprint at most.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and is linked like any other;
repeated rows stay; a null id never names a component unless all its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import batch_chunks, components, materialise, narrowed, small_batches
from reviewloom.operators.keys import hot_keys, join_split
from reviewloom.session import broadcast_if_small

BITS = 64
RADIUS = 2
WORDS = 3
SEED = 42
# Fingerprints that one bucket may hold before it is covered again; 64 at least, so that the third table is the last.
BUCKET = 512
# Shingles whose bits are counted at a time.
_RUN = 1 << 15


def fingerprint(raw: bytes) -> int:
    """Of one text in UTF-8; only A-Z are lower-cased, words end at ASCII white space."""
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(WORDS, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _RUN):
        hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts[at : at + _RUN], ends[at : at + _RUN])]
        set_bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += set_bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. A map over the texts."""
    rows = narrowed(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text"):
                raw = data.tobytes()
                own = np.array([fingerprint(raw[s:e]) for s, e in zip(offsets[:-1], offsets[1:])], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.view(np.int64))], ["doc_id", "fp"])

    return rows.mapInArrow(work, "doc_id bigint, fp bigint")


def cover(free: int) -> list[int]:
    """Seven masks over the places of ``free``: whichever two places differ, one mask holds neither."""
    places = [i for i in range(BITS) if free >> i & 1]
    vectors = 1 << (RADIUS + 1)
    return [
        sum(1 << i for at, i in enumerate(places) if ((1 + at % (vectors - 1)) & v).bit_count() % 2) for v in range(1, vectors)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that connect what lies within the radius inside each bucket; rows come sorted by bucket."""
    waiting: pa.RecordBatch | None = None

    def linked(table: np.ndarray, part: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        n = len(fp)
        new = np.ones(n, bool)
        new[1:] = (table[1:] != table[:-1]) | (part[1:] != part[:-1])
        starts = np.flatnonzero(new)
        end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
        bits = fp.view(np.uint64)
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step, todo = 1, np.arange(n)
        while True:
            # each row against the row ``step`` places on, while that is in its bucket
            todo = todo[todo + step < end[todo]]
            if not len(todo):
                break
            near = todo[np.bitwise_count(bits[todo] ^ bits[todo + step]) <= RADIUS]
            found_a.append(near)
            found_b.append(near + step)
            step += 1
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        label = np.arange(n)
        while True:
            before = label.copy()
            np.minimum.at(label, b, label[a])
            np.minimum.at(label, a, label[b])
            label = label[label]
            if (label == before).all():
                break
        member = np.flatnonzero(label != np.arange(n))
        return pa.RecordBatch.from_arrays([pa.array(fp[label[member]]), pa.array(fp[member])], ["a", "b"])

    for batch in batches:
        if waiting is not None:
            batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
        if batch.num_rows == 0:
            continue
        table, part, fp = (np.asarray(batch.column(i)) for i in range(3))
        last = int(np.flatnonzero((table != table[-1]) | (part != part[-1]))[-1]) + 1 if ((table != table[-1]) | (part != part[-1])).any() else 0
        waiting = batch.slice(last)
        if last:
            yield linked(table[:last], part[:last], fp[:last])
    if waiting is not None:
        yield linked(*(np.asarray(waiting.column(i)) for i in range(3)))


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect all fingerprints ``fp`` of ``nodes`` (distinct) within the radius."""
    whole = (1 << BITS) - 1
    # masks by the path of tables that led to a bucket: one number a level
    masks = {0: 0}
    rows = nodes.select(F.lit(0).alias("path"), "fp")
    found = None
    while masks:
        following: dict[int, int] = {}
        for path, used in masks.items():
            for v, mask in enumerate(cover(whole & ~used)):
                following[path * 8 + v + 1] = used | mask
        tables = F.explode(F.sequence(F.col("path") * 8 + 1, F.col("path") * 8 + 7)).alias("path")
        # a level has at most 7 ** 3 masks, a fixed number
        low = min(following)
        listed = [_signed(following.get(p, 0)) for p in range(low, max(following) + 1)]
        used = F.element_at(F.lit(listed).cast("array<bigint>"), F.col("path") - low + 1)
        hits = rows.select(tables, "fp").select("path", F.col("fp").bitwiseAND(used).alias("part"), "fp")
        last = all((whole & ~m).bit_count() <= bucket.bit_length() - 1 for m in following.values())
        if last:
            kept, masks = hits, {}
        else:
            hits = materialise(hits, "covering")
            sizes = hits.groupBy("path", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
            crowded = materialise(sizes.select("path", "part"), "crowded")
            some = not crowded.isEmpty()
            small = broadcast_if_small(crowded)
            kept = hits.join(small, ["path", "part"], "left_anti") if some else hits
            rows = hits.join(small, ["path", "part"], "left_semi").select("path", "fp")
            masks = following if some else {}
        dealt = kept.repartition("path", "part").sortWithinPartitions("path", "part", "fp")
        forest = dealt.select("path", "part", "fp").mapInArrow(_forest, "a bigint, b bigint")
        found = forest if found is None else found.unionByName(forest)
    return found


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per input row.

    ``component_id`` is the smallest id among all documents reachable over links of at most two differing bits.
    """
    small_batches(docs.sparkSession)
    signed = materialise(fingerprints(docs), "fingerprints")
    nodes = materialise(signed.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), bucket).distinct())
    named = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = materialise(named.join(heads, "root").select("fp", "component_id"), "of-fingerprint")
    # a fingerprint that a large part of the documents share meets its one row by a broadcast
    joined = join_split(signed, of_node, "fp", hot_keys(signed, "fp"))
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
