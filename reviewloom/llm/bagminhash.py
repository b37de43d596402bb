"""Near-duplicate documents by weighted Jaccard of word shingles, with BagMinHash signatures.

A document is the multiset of its five-word shingles. For two multisets the weighted Jaccard similarity is
the sum of the smaller counts over the sum of the larger counts. BagMinHash draws, for every shingle, Poisson
processes over discretised weights: the weights (0, 1], (1, 2], (2, 4], (4, 8], ... form a hierarchy of
blocks, each with one process whose points carry a time, a weight level inside the block and a component of
the signature. A point counts if its level is not above the shingle's weight, and every component keeps its
earliest point. Two documents keep the same point with exactly their weighted Jaccard as probability. Points
come in order of time, so a process stops as soon as it is past the time by which all components are filled:
about one point per shingle and m * ln(m) per document, instead of m per shingle.

Defined cases: a null text counts as empty; texts without words are alike only if they are equal; equal
texts are always one class; every input row gives one output row, also for null or repeated ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import BROADCAST_IDS, batch_chunks, broadcast_if_small, components, materialise, narrowed, one_worker_each, semi, small_batches
from reviewloom.llm.words import counted, mix, text_shingles
from reviewloom.session import has_at_most

# 45 bands of 7 rows: a pair at similarity 0.8 is missed with probability (1 - 0.8**7)**45 < 3e-5, and one at 0.4
# meets with probability 0.07.
BANDS = 45
ROWS = 7
SIMILARITY = 0.8
# Bands whose buckets are starred first; what they link is one class before any other texts are compared.
FIRST_BANDS = 6
# Members of one bucket that meet in one task; larger buckets are cut into parts, every two of which meet.
BLOCK_ROWS = 4_096
# One bit of each of the first components goes with a text. Bits agree with probability (1 + similarity) / 2, so a
# pair at 0.8 differs in more than FAR_BITS of 256 with probability 6.4e-7; such pairs are not compared.
SKETCH_BITS = 256
FAR_BITS = 51
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
# Sixteen bits of each of the 315 components are compared next. At 0.8 fewer than LEAST_EQUAL of them agree with
# probability 6e-7; of texts at 0.6 that have come so far, one pair in some hundreds goes on to the exact comparison.
LEAST_EQUAL = 216
# Pairs whose components are compared at a time.
_PAIRS = 1 << 13
# Texts of a block; a task holds the shingles of two blocks while it compares their pairs.
BLOCK_BYTES = 2 << 20
# Shingles of one bucket whose texts meet in one task; heavier buckets are cut into parts, every two of which meet.
BLOCK_SHINGLES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _block_entries(values: np.ndarray, counts: np.ndarray, texts: np.ndarray):
    """One entry per shingle and weight block that its count reaches into."""
    blocks = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
    which = np.repeat(np.arange(len(values)), blocks)
    block = np.arange(len(which)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(block == 0, 0, 1 << np.maximum(block - 1, 0))
    size = np.maximum(low, 1)
    seeds = mix(values[which] + mix(block.astype(np.uint64) + np.uint64(1)))
    return seeds, texts[which], low, size, counts[which]


def bag_signatures(values: np.ndarray, counts: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """A row of ``m`` point identities for each multiset; zeros for an empty one."""
    n_texts = len(at) - 1
    marks = np.zeros((n_texts, m), np.uint64)
    texts = np.repeat(np.arange(n_texts), np.diff(at))
    weight = np.bincount(texts, counts, n_texts)
    seeds, owner, low, size, count = _block_entries(values, counts, texts)
    times = np.full((n_texts, m), np.inf)
    spread = np.log(m) + 4.0
    todo = np.flatnonzero(weight > 0)
    while len(todo):
        chosen = np.zeros(n_texts, bool)
        chosen[todo] = True
        use = np.flatnonzero(chosen[owner])
        times[todo] = np.inf
        limit = np.where(weight > 0, spread / np.maximum(weight, 1), 0.0)
        seed, own, rate = seeds[use], owner[use], m * size[use].astype(float)
        below, width, most = low[use], size[use], count[use]
        index, clock = np.zeros(len(use), np.int64), np.zeros(len(use))
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        alive = np.arange(len(use))
        while len(alive):
            run = np.maximum(1, np.ceil(rate[alive] * limit[own[alive]] * 0.5)).astype(np.int64)
            ends = np.cumsum(run)
            entry = np.repeat(alive, run)
            place = np.arange(ends[-1]) - np.repeat(ends - run, run)
            point = mix(seed[entry] + (index[entry] + place + 1).astype(np.uint64) * _STEP)
            gap = -np.log(((point >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / rate[entry]
            total = np.cumsum(gap)
            time = total - np.repeat(total[ends - run] - gap[ends - run], run) + clock[entry]
            clock[alive], index[alive] = time[ends - 1], index[alive] + run
            second = mix(point)
            level = below[entry] + 1 + (second & np.uint64(0xFFFFFFFF)).astype(np.int64) % width[entry]
            part = ((second >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            good = (time <= limit[own[entry]]) & (level <= most[entry])
            kept.append((own[entry][good] * m + part[good], time[good], point[good]))
            alive = alive[clock[alive] <= limit[own[alive]]]
        cell = np.concatenate([k[0] for k in kept])
        time = np.concatenate([k[1] for k in kept])
        point = np.concatenate([k[2] for k in kept])
        flat = times.reshape(-1)
        np.minimum.at(flat, cell, time)
        best = time == flat[cell]
        marks.reshape(-1)[cell[best]] = point[best]
        todo = todo[np.isinf(times[todo]).any(axis=1)]
        spread *= 2
    return marks


def band_keys(marks: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band from ``rows`` neighbouring components and the band's number."""
    total = np.zeros((len(marks), bands), np.uint64) + mix(np.arange(bands, dtype=np.uint64) + np.uint64(77))
    cut = marks[:, : bands * rows].reshape(len(marks), bands, rows)
    for k in range(rows):
        total = mix(total * _STEP + cut[:, :, k])
    return total.view(np.int64)


def sketch_words(marks: np.ndarray) -> np.ndarray:
    """One bit of each of the first components, in 64-bit words."""
    bits = ((marks[:, :SKETCH_BITS] >> np.uint64(17)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64).reshape(len(marks), -1)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two multisets given as sorted distinct values and counts."""
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][at_a], b[1][at_b]).sum())
    whole = int(a[1].sum() + b[1].sum()) - shared
    return shared / whole if whole else 0.0


def _signed(bands: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text"):
                values, counts, at = counted(*text_shingles(data, offsets))
                weight = np.add.reduceat(np.append(counts, 0), at[:-1]) * (np.diff(at) > 0)
                marks = bag_signatures(values, counts, at, max(bands * rows, SKETCH_BITS))
                keys, words = band_keys(marks, bands, rows), sketch_words(marks)
                raw = data.tobytes()
                digests = [hashlib.md5(raw[s:e], usedforsecurity=False).digest() for s, e in zip(offsets[:-1], offsets[1:])]
                lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(digests, pa.binary()), pa.array(weight, pa.int64()), lists]
                    + [pa.array(np.ascontiguousarray(words[:, k])) for k in range(len(SKETCH))]
                    + [pa.array([m.tobytes() for m in (marks[:, : bands * rows] >> np.uint64(32)).astype(np.uint16)], pa.binary())]
                    + [pa.array([k.tobytes() for k in keys.astype(np.uint32)], pa.binary())],
                    ["doc_id", "node", "weight", "keys", *SKETCH, "marks", "bands"],
                )

    return work


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact similarity of candidate pairs. Rows come by block pair, in each the texts before the pairs that need them."""
    here, held = None, {}
    for batch in batches:
        blocks, ids_a, ids_b = (batch.column(i).to_pylist() for i in range(3))
        texts, found = batch.column(3), []
        for i, (block, a, b) in enumerate(zip(blocks, ids_a, ids_b)):
            if block != here:
                here, held = block, {}
            if b is None:
                data = np.frombuffer(texts[i].as_py().encode(), np.uint8)
                values, counts, _ = counted(*text_shingles(data, np.array([0, len(data)])))
                held[a] = values, counts
            else:
                found.append((a, b, weighted_jaccard(held[a], held[b])))
        columns = list(zip(*found)) or [(), (), ()]
        kinds = (pa.binary(), pa.binary(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", "score"])


def _links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs of at least ``similarity``, by exact multiset overlap of their whole texts.

    Texts are dealt into blocks of some ``BLOCK_BYTES`` by their digests, and pairs meet by their two blocks. A text
    travels once to every block pair that needs it, not once for each of its pairs, and is cut into shingles there.
    """
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    # one text for each node: copies have equal texts, so any will do
    own = materialise(semi(texts, needed, "node").groupBy("node").agg(F.first("text").alias("text")), "texts")
    n_blocks = max(1, -(-(own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))

    def block(node: str) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(n_blocks))

    low, high = F.least(block("a"), block("b")), F.greatest(block("a"), block("b"))
    dealt = pairs.select((low * n_blocks + high).alias("blocks"), "a", "b", F.lit(None).cast("string").alias("text"))
    wanted = dealt.select("blocks", F.explode(F.array("a", "b")).alias("node")).distinct()
    sent = wanted.join(own, "node").select("blocks", F.col("node").alias("a"), F.lit(None).cast("binary").alias("b"), "text")
    met = sent.unionByName(dealt).repartition("blocks").sortWithinPartitions("blocks", F.col("b").isNotNull())
    scored = met.mapInArrow(_verified, "a binary, b binary, score double")
    return materialise(scored.where(F.col("score") >= similarity), "links")


def _candidates(rows: pa.RecordBatch, similarity: float, far_bits: int, least_equal: int, run: np.ndarray):
    """Pairs of rows (p, q) of one bucket and different runs that may be alike, as arrays, some at a time.

    ``run`` numbers the classes of each bucket; its caller may give runs one number while pairs are drawn. Of all the
    buckets that hold both texts of a pair only that of the first band brings it up.
    """
    n = rows.num_rows
    key, side, bucket, weight = (np.asarray(rows.column(i)) for i in (0, 1, 4, 5))
    words = np.stack([np.asarray(rows.column(6 + k)).view(np.uint64) for k in range(len(SKETCH))], axis=1)
    marks = np.frombuffer(b"".join(rows.column(6 + len(SKETCH)).to_pylist()), np.uint16).reshape(n, -1)
    bands = np.frombuffer(b"".join(rows.column(7 + len(SKETCH)).to_pylist()), np.uint32).reshape(n, -1)
    here = bucket.astype(np.uint32)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    stop = np.append(starts[1:], n)
    end = np.repeat(stop, stop - starts)
    # every row against the rows of its bucket behind its own class, one place further at each step
    change = np.append(np.flatnonzero((run[1:] != run[:-1]) | (key[1:] != key[:-1])) + 1, n)
    todo = np.arange(n)
    other = change[np.searchsorted(change, todo, side="right")]
    while True:
        inside = other < end[todo]
        todo, other = todo[inside], other[inside]
        if not len(todo):
            return
        fits = np.minimum(weight[todo], weight[other]) >= similarity * np.maximum(weight[todo], weight[other])
        fits &= ((side[todo] == 0) | (side[todo] != side[other])) & (run[todo] != run[other])
        x, y = todo[fits], other[fits]
        near = np.flatnonzero(np.bitwise_count(words[x] ^ words[y]).sum(axis=1) <= far_bits)
        for at in range(0, len(near), _PAIRS):
            p, q = x[near[at : at + _PAIRS]], y[near[at : at + _PAIRS]]
            first = (bands[p] == bands[q]).argmax(axis=1)
            own = bands[p, first] == here[p]
            p, q = p[own], q[own]
            kept = (marks[p] == marks[q]).sum(axis=1) >= least_equal
            if kept.any():
                yield p[kept], q[kept]
        other = other + 1


def _runs(rows: pa.RecordBatch) -> np.ndarray:
    """A number for each class of each bucket, from rows sorted by bucket and class."""
    key, root, n = np.asarray(rows.column(0)), rows.column(2), rows.num_rows
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | pc.not_equal(root.slice(1), root.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.cumsum(new) - 1


def _suspects(similarity: float, far_bits: int, least_equal: int):
    """The rows that stand in a candidate pair: at most as many as there are."""

    def met(rows: pa.RecordBatch) -> pa.RecordBatch:
        seen = np.zeros(rows.num_rows, bool)
        for p, q in _candidates(rows, similarity, far_bits, least_equal, _runs(rows)):
            seen[p] = seen[q] = True
        chosen = rows.take(pa.array(np.flatnonzero(seen)))
        return pa.RecordBatch.from_arrays([chosen.column(i) for i in (4, 2, 3, 5)], ["key", "root", "node", "weight"])

    return _by_bucket(met)


def _joined(similarity: float, far_bits: int, least_equal: int):
    """Links (a, b) of each bucket that join its classes, by exact similarity: fewer than it has classes.

    A pair whose classes earlier links of the bucket have joined is passed over.
    """

    def met(rows: pa.RecordBatch) -> pa.RecordBatch:
        run, node, texts = _runs(rows), rows.column(3), rows.column(8 + len(SKETCH))
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def bag(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in held:
                data = np.frombuffer(texts[i].as_py().encode(), np.uint8)
                held[i] = counted(*text_shingles(data, np.array([0, len(data)])))[:2]
            return held[i]

        found_a, found_b = [], []
        for p, q in _candidates(rows, similarity, far_bits, least_equal, run):
            for a, b in zip(p.tolist(), q.tolist()):
                if run[a] != run[b] and weighted_jaccard(bag(a), bag(b)) >= similarity:
                    run[run == run[b]] = run[a]
                    found_a.append(a)
                    found_b.append(b)
        return pa.RecordBatch.from_arrays([node.take(pa.array(f, pa.int64())) for f in (found_a, found_b)], ["a", "b"])

    return _by_bucket(met)


def _by_bucket(met):
    """Calls ``met`` with whole buckets, from rows sorted by their first column."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.asarray(batch.column(0))
            change = np.flatnonzero(key != key[-1])
            if len(change) or (waiting and waiting[-1].column(0)[0].as_py() != key[0]):
                last = int(change[-1]) + 1 if len(change) else 0
                yield met(pa.Table.from_batches([*waiting, batch.slice(0, last)]).combine_chunks().to_batches()[0])
                waiting, batch = [], batch.slice(last)
            waiting.append(batch)
        if waiting:
            yield met(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    return work


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, class_id, kept, weight, n_links, digest): one row per input row.

    ``class_id`` is the smallest id among all documents connected by links of at least ``similarity``; ``kept``
    marks the rows that carry it; ``weight`` counts the shingles; ``n_links`` the verified links that joined the text to
    its class; ``digest`` is the text's MD5.

    Equal texts become one node first. In the buckets of the first bands every node is checked against the bucket's
    smallest node, and links are classes from then on. Then, in the buckets of all bands, only nodes of different
    classes are compared: by their weights, bits and components first. Only the nodes of pairs that these allow come
    again, with their texts, and are compared exactly inside the task until their classes are joined; no row is made
    for a pair unless it joins two classes. Buckets of any size are treated alike; the parts of a large one meet two
    by two. A pair at 0.8 is missed if no band agrees (below 3e-5), or its bits or its
    components are too far apart (6.4e-7 and 6e-7).
    """
    small_batches(docs.sparkSession)
    rows_in = narrowed(docs, "doc_id", "text")
    signed = materialise(
        rows_in.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
            _signed(bands, rows), "doc_id bigint, node binary, weight bigint, keys array<bigint>, " + ", ".join(f"{c} bigint" for c in SKETCH) + ", marks binary, bands binary"
        ),
        "signed",
    )
    light = ["weight", *SKETCH]
    one = [F.first(c).alias(c) for c in (*light, "marks", "bands", "keys")]
    nodes = materialise(signed.groupBy("node").agg(F.min("doc_id").alias("first"), *one), "nodes")
    texts = rows_in.select(
        F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("node"), F.coalesce("text", F.lit("")).alias("text")
    )

    def alike(a: str, b: str) -> Column:
        """Whether the texts described by the structs a and b can have the similarity."""
        weights = F.least(f"{a}.weight", f"{b}.weight") >= similarity * F.greatest(f"{a}.weight", f"{b}.weight")
        far = sum(F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in SKETCH)
        return weights & (far <= far_bits)

    # the bound on bits is that of the standard similarity; below it bits rule nothing out
    far_bits = FAR_BITS if similarity >= SIMILARITY else SKETCH_BITS
    least_equal = LEAST_EQUAL if similarity >= SIMILARITY and bands * rows == BANDS * ROWS else 0
    some = nodes.where(F.col("weight") > 0)
    # what is compared travels with the keys, so no pair has to fetch it
    hits = some.select(F.struct("node", *light).alias("own"), F.explode(F.slice("keys", 1, FIRST_BANDS)).alias("key"))
    crowded = hits.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("own").alias("head")).where(F.col("n") > 1)
    starred = hits.join(crowded, "key").where((F.col("own.node") != F.col("head.node")) & alike("head", "own"))
    stars = materialise(starred.select(F.col("head.node").alias("a"), F.col("own.node").alias("b")).distinct(), "stars")
    links = _links(stars, texts, similarity)
    roots = components(links)

    # members of the buckets that hold more than one class; a node without a class of its own is its class
    n_rows = F.count(F.lit(1))
    hits = some.join(broadcast_if_small(roots), "node", "left").select("node", F.nullif("root", "node").alias("root"), F.explode("keys").alias("key"))
    root = F.coalesce("root", "node")
    spread = hits.groupBy("key").agg(F.min(root).alias("x"), F.max(root).alias("y"), F.ceil(n_rows / block_rows).cast("int").alias("parts"))
    rest = hits.join(spread.where(F.col("x") != F.col("y")).select("key", "parts"), "key")
    rest = materialise(rest.select("key", root.alias("root"), "node", "parts"), "open")

    tasks = one_worker_each(docs.sparkSession)
    traits = ["weight", *SKETCH, "marks", "bands"]

    def met(rest: DataFrame, known: DataFrame) -> DataFrame:
        """Rows (key, root, node) with what is known of their nodes, sorted by bucket; wide ones in ``parts`` that meet."""
        dealt = rest.where(F.col("parts") == 1).select("key", "root", "node", F.col("key").alias("bucket"), F.lit(0).alias("side"))
        wide = rest.where(F.col("parts") > 1)
        if not wide.isEmpty():
            split = wide.withColumn("_part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
            split = split.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            low, high = F.least("_part", "_with"), F.greatest("_part", "_with")
            side = F.when(low == high, 0).otherwise(F.when(F.col("_part") == low, 1).otherwise(2))
            split = split.select(F.xxhash64("key", low, high).alias("key"), "root", "node", F.col("key").alias("bucket"), side.alias("side"))
            dealt = dealt.unionByName(split)
        columns = [c for c in known.columns if c != "node"]
        dealt = dealt.join(known, "node").select("key", "side", "root", "node", "bucket", *columns)
        return dealt.repartition(tasks, "key").sortWithinPartitions("key", "root")

    limits = (similarity, far_bits, least_equal)
    suspects = met(rest, nodes.select("node", *traits)).mapInArrow(_suspects(*limits), "key bigint, root binary, node binary, weight bigint")
    suspects = materialise(suspects.distinct(), "suspects")
    parts = F.ceil(F.greatest(n_rows / block_rows, F.sum("weight") / BLOCK_SHINGLES)).cast("int").alias("parts")
    again = suspects.select("node")
    # one text for each node: copies have equal texts, so any will do
    own = materialise(semi(texts, again, "node").groupBy("node").agg(F.first("text").alias("text")), "texts")
    known = semi(nodes.select("node", *traits), again, "node").join(own, "node")
    dealt = materialise(suspects.join(suspects.groupBy("key").agg(parts), "key"), "dealt")
    joined = met(dealt, known).mapInArrow(_joined(*limits), "a binary, b binary")
    more = joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    every_link = materialise(links.select("a", "b").unionByName(more), "every_link")
    roots = components(every_link)

    # nodes without links are classes of their own and take no part in what follows
    degree = every_link.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(n_rows.alias("n_links"))
    linked = materialise(nodes.select("node", "first").join(broadcast_if_small(roots), "node"), "linked")
    heads = linked.groupBy("root").agg(F.min("first").alias("class_id"))
    of_linked = materialise(linked.join(heads, "root").join(degree, "node").select("node", "class_id", "n_links"), "of_linked")
    of_node = nodes.select("node", "first").join(broadcast_if_small(of_linked), "node", "left")
    of_node = of_node.select("node", F.coalesce("class_id", "first").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return (
        signed.select("doc_id", "node", "weight")
        .join(of_node, "node")
        .select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"), "weight", "n_links", F.col("node").alias("digest"))
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, all columns: the row with the class's smallest id.

    Rows with a null or repeated id stay once per id and text.
    """
    classes = near_duplicates(docs, **options)
    gone = materialise(classes.where(~F.col("kept")).select("doc_id", "digest").distinct(), "gone")

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if has_at_most(df, BROADCAST_IDS) else df

    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull())
    again = small(materialise(again.select(F.col("doc_id").alias("_again")), "again"))
    rows = docs.select("doc_id", "text", F.struct("*").alias("_row"))
    twice = F.col("doc_id").eqNullSafe(F.col("_again"))
    # an id that occurs once names its row; the few others are told apart by their texts as well
    once = rows.join(again, twice, "left_anti").join(small(gone.select("doc_id").distinct()), "doc_id", "left_anti")
    some = rows.join(again, twice, "left_semi").withColumn("_digest", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    out = small(gone.select(F.col("doc_id").alias("_out"), "digest"))
    some = some.join(out, F.col("doc_id").eqNullSafe(F.col("_out")) & (F.col("_digest") == F.col("digest")), "left_anti")
    return once.select("_row.*").unionByName(some.dropDuplicates(["doc_id", "_digest"]).select("_row.*"))
