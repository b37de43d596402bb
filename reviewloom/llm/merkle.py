"""Merkle manifest of a dataset by time-forward processing.

Rows are leaves; per language they ascend by id and every eight neighbours hash to a node, until one is left. The
trees' roots, ordered by language, hash in the same way to the root of the dataset.

The trees are worked off in the order of node labels, children before parents: a node that is done sends its digest
to its parent through a priority queue ordered by label, and the parent, when its turn comes, finds all of them at
the head. A reversed sweep then goes from the root down: each node finds the siblings along its own way to the root
in the queue and sends its children theirs. Inside a task the queue spans ``LEVELS`` levels, that is a run of 8 **
LEVELS neighbours; between such runs messages are rows that Spark's sorted shuffle brings to the run of the
receiver. Each round takes a table to one 8 ** LEVELS times smaller, so nothing is ever whole in one place.

Defined cases: a null field is hashed as ``-``; null languages form the first tree; null ids stand before all others,
repeated ids by leaf; an id that is null counts as empty text where tampering is decided; an empty table gives no
rows. A single row is leaf, subroot and root, and its proof is the hash of nothing.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import fold, materialise, narrowed

FANOUT = 8
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows of one range when leaves are numbered.
RANGE_ROWS = 50_000

PATH = "lefts array<string>, rights array<string>, subroot string, root string"


def digest(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


def height_of(size: int, levels: int) -> int:
    """Levels that a run of a tree with ``size`` nodes is lifted: all of them, or up to the tree's root."""
    height = 0
    while height < levels and size > FANOUT**height:
        height += 1
    return height


def forward(leaves: list[bytes], height: int) -> list[list[bytes]]:
    """Digests of a run's nodes by level. A node's label is (its last leaf, its level)."""
    n = len(leaves)
    levels: list[list[bytes]] = [[] for _ in range(height + 1)]
    queue: list[tuple[int, int, int, bytes]] = []
    for at, own in enumerate(leaves):
        level = 0
        while True:
            levels[level].append(own)
            if level == height:
                break
            place = at // FANOUT**level
            last = min((place // FANOUT + 1) * FANOUT ** (level + 1), n) - 1
            heapq.heappush(queue, (last, level + 1, place, own))
            if last > at:
                break
            level += 1
            parts = []
            while queue and queue[0][:2] == (at, level):
                parts.append(heapq.heappop(queue)[3])
            own = digest(b"".join(parts))
    return levels


def backward(levels: list[list[bytes]], above: tuple) -> list[tuple]:
    """The way to the root of every leaf of a run: (left siblings, right siblings, rest of the way), innermost first.

    ``above`` is the way of the run's own root. Ways share their tails.
    """
    n = len(levels[0])
    ways: list[tuple] = [()] * n
    queue = [(-(n - 1), -(len(levels) - 1), 0, above)]
    while queue:
        last, level, place, way = heapq.heappop(queue)
        level = -level
        if level == 0:
            ways[place] = way
            continue
        first = place * FANOUT
        children = levels[level - 1][first : first + FANOUT]
        for k in range(len(children)):
            beside = (b"".join(children[:k]), b"".join(children[k + 1 :]), way)
            end = min((first + k + 1) * FANOUT ** (level - 1), n) - 1
            heapq.heappush(queue, (-end, 1 - level, first + k, beside))
    return ways


def _steps(way: tuple) -> list[tuple[bytes, bytes]]:
    steps = []
    while way:
        steps.append(way[:2])
        way = way[2]
    return steps


def _ordered(table: pa.Table) -> pa.Table:
    return table.take(pa.array(np.argsort(np.asarray(table.column("pos")), kind="stable")))


def _bytes(column: pa.ChunkedArray) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def climb(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Tables (tree, pos, digest, size) of rising height; the last has the root of every tree."""
    run = FANOUT**levels

    def lift(table: pa.Table) -> pa.Table:
        table = _ordered(table)
        size, pos = table.column("size")[0].as_py(), table.column("pos")[0].as_py()
        top = forward(_bytes(table.column("digest")), height_of(size, levels))[-1][0]
        return pa.table(
            {"tree": [table.column("tree")[0].as_py()], "pos": [pos // run], "digest": [top.decode()], "size": [-(-size // run)]},
            pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("size", pa.int64())]),
        )

    rounds = [nodes]
    while True:
        low = rounds[-1].select("tree", "pos", "digest", "size").withColumn("run", F.expr(f"pos div {run}"))
        up = low.groupBy("tree", "run").applyInArrow(lift, "tree string, pos bigint, digest string, size bigint")
        rounds.append(materialise(up, "nodes"))
        if (rounds[-1].agg(F.max("size")).first()[0] or 1) <= 1:
            return rounds


def descend(rounds: list[DataFrame], messages: DataFrame, finish: Callable[[pa.Table, pa.Table, list[tuple]], pa.Table], schema: str, levels: int = LEVELS) -> DataFrame:
    """The reversed sweep from (tree, pos, PATH) of the roots; ``finish`` makes the rows of the lowest table."""
    run = FANOUT**levels

    def passed_on(table: pa.Table, message: pa.Table, ways: list[tuple]) -> pa.Table:
        steps = [_steps(w) for w in ways]
        n = table.num_rows
        strings = pa.list_(pa.string())
        return pa.table(
            {
                "tree": table.column("tree"),
                "pos": table.column("pos"),
                "lefts": pa.array([[s[0].decode() for s in x] for x in steps], strings),
                "rights": pa.array([[s[1].decode() for s in x] for x in steps], strings),
                "subroot": pa.array(message.column("subroot").to_pylist() * n, pa.string()),
                "root": pa.array(message.column("root").to_pylist() * n, pa.string()),
            }
        )

    def sweep(of: Callable[[pa.Table, pa.Table, list[tuple]], pa.Table]):
        def work(table: pa.Table, message: pa.Table) -> pa.Table:
            table = _ordered(table)
            above: tuple = ()
            sides = zip(message.column("lefts")[0].as_py(), message.column("rights")[0].as_py())
            for left, right in reversed(list(sides)):
                above = (left.encode(), right.encode(), above)
            height = height_of(table.column("size")[0].as_py(), levels)
            return of(table, message, backward(forward(_bytes(table.column("digest")), height), above))

        return work

    for nodes in reversed(rounds[:-1]):
        lowest = nodes is rounds[0]
        runs = nodes.withColumn("run", F.expr(f"pos div {run}")).groupBy("tree", "run")
        met = runs.cogroup(messages.groupBy("tree", "pos"))
        if lowest:
            return met.applyInArrow(sweep(finish), schema)
        messages = materialise(met.applyInArrow(sweep(passed_on), f"tree string, pos bigint, {PATH}"), "ways")
    raise ValueError("no rounds")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos`` (from 0 in each tree, by ``order``) and ``size`` (rows of the tree).

    Rows are cut into ranges of the order, each range is numbered on its own, and the ranges' counts, one row per
    tree and range, give what stands before.
    """
    n = rows.count()
    ranges = max(1, -(-n // RANGE_ROWS))
    parts = materialise(rows.repartitionByRange(ranges, "tree", *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = parts.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("tree").orderBy("_range")
    before = F.coalesce(F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    offsets = counts.select("tree", "_range", before.alias("_before"), total.alias("size"))
    inside = Window.partitionBy("tree", "_range").orderBy(*order)
    placed = parts.join(offsets, ["tree", "_range"]).withColumn("pos", F.col("_before") + F.row_number().over(inside) - 1)
    return placed.drop("_range", "_before")


def leaf_digest(**replaced: Column) -> Column:
    """H of the five fields, each with its length in front."""
    parts = []
    for name in FIELDS:
        text = replaced.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): one row per input row.

    Where the checksum of the id is divisible by 3 the stored text is lower-cased (A-Z) before its leaf is folded with
    the original siblings; ``verified`` tells whether the folded root is the manifest's.
    """
    rows = narrowed(docs, *FIELDS)
    tampered = leaf_digest(text=F.translate("text", UPPER, LOWER))
    # the empty text stands before every marked language
    tree = F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("tree")
    leaves = materialise(
        rows.select(
            tree,
            F.col("doc_id").cast("bigint").alias("doc_id"),
            leaf_digest().alias("digest"),
            F.when(fold("doc_id", 3) == 0, tampered).alias("stored"),
            F.monotonically_increasing_id().alias("tie"),  # lets equal rows fall into several ranges
        ),
        "leaves",
    )
    placed = materialise(numbered(leaves, ["doc_id", "digest", "tie"]).drop("tie"), "placed")
    rounds = climb(placed, levels)
    languages = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    languages = materialise(numbered(languages, ["name"]), "subroots")
    upper = climb(languages, levels)
    nothing = F.array().cast("array<string>")
    tops = upper[-1].select("tree", "pos", nothing.alias("lefts"), nothing.alias("rights"), F.lit("").alias("subroot"), F.col("digest").alias("root"))

    def to_language(table: pa.Table, message: pa.Table, ways: list[tuple]) -> pa.Table:
        steps = [_steps(w) for w in ways]
        strings = pa.list_(pa.string())
        return pa.table(
            {
                "tree": table.column("name"),
                "pos": pa.array([0] * table.num_rows, pa.int64()),
                "lefts": pa.array([[s[0].decode() for s in x] for x in steps], strings),
                "rights": pa.array([[s[1].decode() for s in x] for x in steps], strings),
                "subroot": table.column("digest"),
                "root": pa.array(message.column("root").to_pylist() * table.num_rows, pa.string()),
            }
        )

    def to_document(table: pa.Table, message: pa.Table, ways: list[tuple]) -> pa.Table:
        root = message.column("root")[0].as_py()
        proofs, folded = [], []
        for leaf, stored, way in zip(_bytes(table.column("digest")), _bytes(table.column("stored")), ways):
            proof, own = sha256(), leaf if stored is None else stored
            for left, right in _steps(way):
                proof.update(left)
                proof.update(right)
                own = digest(left + own + right)
            proofs.append(proof.hexdigest())
            folded.append(own.decode())
        n = table.num_rows
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "leaf": table.column("digest"),
                "subroot": pa.array(message.column("subroot").to_pylist() * n, pa.string()),
                "root": pa.array([root] * n, pa.string()),
                "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array(folded, pa.string()),
                "verified": pa.array([f == root for f in folded], pa.bool_()),
            }
        )

    ways = materialise(descend(upper, tops, to_language, f"tree string, pos bigint, {PATH}", levels), "ways")
    out = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if len(rounds) == 1:
        raise ValueError("no rounds")
    # the lowest table's own roots receive what their language received
    return descend(rounds, ways, to_document, out, levels)
