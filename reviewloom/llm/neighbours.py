"""Approximate nearest neighbours by learned partitions.

On a bounded sample, every vector is joined to its nearest ones, and that neighbour graph is cut into parts of
equal size with as few cut edges as possible. A small classifier learns the part of a vector from the
parts of its neighbours. All rows are dealt to their most probable part; a query is routed to the several
parts that are most probable for it, and the rows there are ranked by their exact distance. How much
probability a query's parts must cover is set on the sample, where recall can be measured against all
pairs.

Parts are worked on in blocks of rows and of queries, so that a part which holds most rows (one vector may be
very common) is many small tasks. Queries are a stated share of the rows.

Defined cases: vectors that are null, zero, of another length than most, or that hold a null or a number that
is not finite take no part, nor do rows without id. Rows with a query's own id are not its candidates. Of a
query id that occurs several times, the smallest vector asks. Equal distances go by the smaller id. A query
whose parts hold too few rows is routed further, so fewer than ``k`` results mean fewer candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import materialise, narrowed, small_batches

# Vectors that the graph and the classifier are made from, at most: those whose ids hash lowest.
SAMPLE = 6_000
GRAPH_DEGREE = 10
# A part is meant to hold this many rows, between the bounds on the number of parts.
ROWS_PER_PART = 2_000
FEWEST_PARTS, MOST_PARTS = 4, 128
HIDDEN = 96
RECALL = 0.99
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 1_024
K = 10


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Squared distances by one matrix product: close, but not exact."""
    cross = queries @ rows.T
    return np.maximum((queries**2).sum(axis=1)[:, None] + (rows**2).sum(axis=1)[None, :] - 2 * cross, 0)


def neighbour_graph(vectors: np.ndarray, degree: int) -> np.ndarray:
    """The ``degree`` nearest other vectors of each, in blocks against all."""
    n = len(vectors)
    found = np.empty((n, min(degree, n - 1)), np.int64)
    for start in range(0, n, 512):
        part = distances(vectors[start : start + 512], vectors)
        part[np.arange(len(part)), np.arange(start, start + len(part))] = np.inf
        found[start : start + 512] = np.argsort(part, axis=1, kind="stable")[:, : found.shape[1]]
    return found


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 8) -> np.ndarray:
    """A part for every node: halves along the widest direction first, then moves that cut fewer edges.

    ``parts`` is a power of two. No part grows beyond a twentieth over its share.
    """
    n = len(vectors)
    part = np.zeros(n, np.int64)
    for _ in range(parts.bit_length() - 1):
        fresh = np.empty(n, np.int64)
        for own in np.unique(part):
            rows = np.flatnonzero(part == own)
            centred = vectors[rows] - vectors[rows].mean(axis=0)
            direction = centred[np.argmax((centred**2).sum(axis=1))]
            for _ in range(5):
                direction = centred.T @ (centred @ direction)
                direction /= max(np.linalg.norm(direction), 1e-12)
            order = np.argsort(centred @ direction, kind="stable")
            fresh[rows[order]] = own * 2 + (np.arange(len(rows)) >= len(rows) // 2)
        part = fresh
    limit = int(np.ceil(n / parts * 1.05)) + 1
    size = np.bincount(part, minlength=parts)
    ends = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.reshape(-1)], axis=1)])
    for _ in range(sweeps):
        pull = np.zeros((n, parts))
        np.add.at(pull, (ends[:, 0], part[ends[:, 1]]), 1)
        np.add.at(pull, (ends[:, 1], part[ends[:, 0]]), 1)
        target = pull.argmax(axis=1)
        gain = pull[np.arange(n), target] - pull[np.arange(n), part]
        moved = 0
        for node in np.argsort(-gain, kind="stable"):
            if gain[node] <= 0:
                break
            if size[target[node]] < limit:
                size[part[node]] -= 1
                size[target[node]] += 1
                part[node] = target[node]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """One hidden layer from a vector to the probabilities of the parts."""

    centre: np.ndarray
    scale: float
    first: np.ndarray
    shift: np.ndarray
    second: np.ndarray
    bias: np.ndarray
    cover: float = 0.9

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((vectors - self.centre) / self.scale) @ self.first + self.shift, 0)
        logits = hidden @ self.second + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        powers = np.exp(logits)
        return powers / powers.sum(axis=1, keepdims=True)

    def routes(self, vectors: np.ndarray, sizes: np.ndarray, need: int) -> list[np.ndarray]:
        """Parts of each query, most probable first: enough for the cover and for ``need`` rows."""
        chance = self.probabilities(vectors)
        order = np.argsort(-chance, axis=1, kind="stable")
        covered = np.cumsum(np.take_along_axis(chance, order, axis=1), axis=1)
        rows = np.cumsum(sizes[order], axis=1)
        enough = (covered >= self.cover) & (rows >= need)
        count = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, len(sizes))
        return [order[i, :c] for i, c in enumerate(count)]


def train_router(vectors: np.ndarray, shares: np.ndarray, epochs: int = 40, batch: int = 128) -> Router:
    """Adam on the cross entropy between a vector's probabilities and its neighbours' shares of the parts."""
    rng = np.random.default_rng(5)
    n, width = vectors.shape
    parts = shares.shape[1]
    centre = vectors.mean(axis=0)
    scale = max(float(vectors.std()), 1e-9)
    weights = [rng.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    mean = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    inputs = (vectors - centre) / scale
    step = 0
    for epoch in range(epochs):
        pace = 3e-3 * (1 - epoch / epochs)
        order = rng.permutation(n)
        for start in range(0, n, batch):
            rows = order[start : start + batch]
            x = inputs[rows]
            raw = x @ weights[0] + weights[1]
            hidden = np.maximum(raw, 0)
            logits = hidden @ weights[2] + weights[3]
            powers = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (powers / powers.sum(axis=1, keepdims=True) - shares[rows]) / len(rows)
            back = (error @ weights[2].T) * (raw > 0)
            grads = [x.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for w, g, m, s in zip(weights, grads, mean, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g**2 - s)
                w -= pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Router(centre, scale, *weights)


def learned_router(vectors: np.ndarray, parts: int, recall: float = RECALL, k: int = K) -> Router:
    """Graph, parts and classifier of the sample, and the cover at which its own recall is reached."""
    graph = neighbour_graph(vectors, GRAPH_DEGREE)
    part = balanced_parts(vectors, graph, parts)
    shares = np.zeros((len(vectors), parts))
    np.add.at(shares, (np.repeat(np.arange(len(vectors)), graph.shape[1]), part[graph.reshape(-1)]), 1.0)
    shares[np.arange(len(vectors)), part] += 1
    router = train_router(vectors, shares / shares.sum(axis=1, keepdims=True))
    chance = router.probabilities(vectors)
    home = chance.argmax(axis=1)
    order = np.argsort(-chance, axis=1, kind="stable")
    covered = np.cumsum(np.take_along_axis(chance, order, axis=1), axis=1)
    place = np.argsort(order, axis=1)
    # the cover a query needs so that the part of each neighbour is among those it is routed to
    at = np.take_along_axis(place, home[graph], axis=1)
    needed = np.where(at > 0, np.take_along_axis(covered, np.maximum(at - 1, 0), axis=1), 0.0)
    router.cover = float(min(0.9999, np.quantile(needed, recall) + 1e-6))
    return router


def usable(vector: Column) -> Column:
    """Whether a vector has only finite numbers, and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(rows: DataFrame, is_query: Column, k: int = K, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row that ``is_query`` selects.

    ``rows`` has vec_id and embedding; ``is_query`` is a column over vec_id. Scores are Euclidean distances.
    """
    spark = rows.sparkSession
    small_batches(spark)
    given = narrowed(rows, "vec_id", "embedding").select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    good = given.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    width = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if width is None:
        return spark.createDataFrame([], result)
    good = good.where(F.size("v") == width.d)
    parts = int(np.clip(2 ** round(np.log2(max(width["count"], 1) / ROWS_PER_PART)), FEWEST_PARTS, MOST_PARTS))
    seen = good.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).collect()
    points = np.unique(np.array([r.v for r in seen]), axis=0)
    # a graph needs more points than parts; fewer points are one part
    router = learned_router(points, parts, recall, k) if len(points) > 16 * parts else None
    shared = spark.sparkContext.broadcast(router)  # a network whose size the parameters fix
    parts = parts if router else 1

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.zeros(batch.num_rows, np.int32)
            if shared.value is not None and batch.num_rows:
                own = shared.value.probabilities(_matrix(batch.column(1))).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], ["vec_id", "v", "part"])

    index = materialise(good.mapInArrow(dealt, "vec_id bigint, v array<double>, part int"), "index")
    sizes = np.zeros(parts, np.int64)
    for row in index.groupBy("part").count().collect():  # one row per part
        sizes[row.part] = row["count"]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            router = shared.value
            routes = router.routes(_matrix(batch.column(1)), sizes, k + 1) if router else [np.zeros(1, np.int64)] * batch.num_rows
            count = [len(r) for r in routes]
            take = pa.array(np.repeat(np.arange(batch.num_rows), count))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(routes), pa.int32())], ["query_id", "q", "part"]
            )

    # candidates of a query can be of its own id only if that is repeated
    queries = index.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    probes = materialise(queries.mapInArrow(routed, "query_id bigint, q array<double>, part int"), "probes")
    asked = np.zeros(parts, np.int64)
    for row in probes.groupBy("part").count().collect():
        asked[row.part] = row["count"]
    row_blocks = [int(max(1, -(-s // BLOCK_ROWS))) for s in sizes]
    query_blocks = [int(max(1, -(-a // BLOCK_QUERIES))) for a in asked]

    def blocks_of(counts: list[int]) -> Column:
        return F.get(F.array(*[F.lit(c) for c in counts]), F.col("part"))

    def block(key: str, counts: list[int]) -> Column:
        return F.pmod(F.xxhash64(key), blocks_of(counts)).cast("int")

    def every(counts: list[int]) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks_of(counts) - 1))

    left = index.withColumn("rb", block("vec_id", row_blocks)).withColumn("qb", every(query_blocks))
    right = probes.withColumn("qb", block("query_id", query_blocks)).withColumn("rb", every(row_blocks))

    def ranked(candidates: pa.Table, questions: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if candidates.num_rows and questions.num_rows:
            ids, vectors = candidates.column("vec_id").to_numpy(), _matrix(candidates.column("v"))
            asks, points = questions.column("query_id").to_numpy(), _matrix(questions.column("q"))
            for start in range(0, len(asks), 256):
                near = distances(points[start : start + 256], vectors)
                for i, row in enumerate(near):
                    ask = asks[start + i]
                    row[ids == ask] = np.inf
                    limit = np.partition(row, min(k, len(row)) - 1)[min(k, len(row)) - 1]
                    # rounding of the product may swap what is nearly equal, so a little more is measured exactly
                    pick = np.flatnonzero((row <= limit + 1e-9 * (1 + (points[start + i] ** 2).sum())) & np.isfinite(row))
                    exact = np.sqrt(((vectors[pick] - points[start + i]) ** 2).sum(axis=1))
                    best = np.lexsort((ids[pick], exact))[:k]
                    out[0].append(np.full(len(best), ask))
                    out[1].append(ids[pick][best])
                    out[2].append(exact[best])
        columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    keys = ["part", "rb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(ranked, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
