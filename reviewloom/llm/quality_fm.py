"""Quality of documents by a factorisation machine over hashed words, structure statistics and length.

The score of a feature vector x is w0 + sum(w_i x_i) + sum over pairs <v_i, v_j> x_i x_j, passed through the
logistic function. All pairs are scored in linear time by the sum-of-squares identity: for every factor,
half of (sum v_i x_i)**2 - sum (v_i x_i)**2. The model is fitted in numpy on the driver, on a bounded sample
of labelled documents (``bound``); scoring is one pass over all documents, in batches of Arrow rows.

Defined cases: a null text counts as empty, and an empty text has a score like any other; a null id belongs
to the fold of the empty text; without labelled rows every score is 0.5 (predicted 1). Ids, languages and
sources are not read for a score. Every input row gives one output row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import batch_chunks, fold, narrowed, small_batches
from reviewloom.llm.labelled import labelled_sample
from reviewloom.llm.words import counted, letters_only, lowered, shingle_hashes, word_hashes

BUCKETS = 1 << 12
FACTORS = 8
# Labelled documents that the model is fitted on, at most.
BOUND = 6_000
LENGTHS = 8


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def structure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of kinds of bytes, repetition of words and word runs, and a one-hot length class, per text."""
    size = np.maximum(np.diff(offsets), 1).astype(float)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit, wide = (data >= 48) & (data <= 57), data >= 128
    space = (data == 32) | ((data >= 9) & (data <= 13))
    plain = np.isin(data, np.frombuffer(b".,;:?'\"()-", np.uint8))
    symbol = ~(upper | lower | digit | wide | space | plain)
    letters = np.maximum(_per_text(upper | lower | wide, offsets), 1)
    words, at = word_hashes(lowered(data), offsets)
    n = np.diff(at).astype(float)
    least = np.maximum(n, 1)
    values, counts, places = counted(words, at)
    top = np.maximum.reduceat(np.append(counts, 0), places[:-1]) * (np.diff(places) > 0) if len(values) else n
    same = np.concatenate([[False], words[1:] == words[:-1]]) if len(words) else np.zeros(0, bool)
    same[at[:-1][at[:-1] < len(words)]] = False
    runs, run_at = shingle_hashes(words, at)
    distinct_runs, _, distinct_at = counted(runs, run_at)
    chars = _per_text((data & 0xC0) != 0x80, offsets)
    shares = [
        _per_text(upper, offsets) / letters,
        _per_text(digit, offsets) / size,
        _per_text(symbol, offsets) / size,
        _per_text(data == 33, offsets) / size,
        _per_text(plain, offsets) / size,
        _per_text(space, offsets) / size,
        _per_text(data == 10, offsets) / least,
        _per_text(wide, offsets) / size,
        size / least,
        np.diff(places) / least,
        top / least,
        _per_text(same, at) / least,
        np.diff(distinct_at) / np.maximum(np.diff(run_at), 1),
        np.log1p(n),
        np.log1p(chars),
    ]
    kind = np.clip(np.log2(np.maximum(chars, 1)).astype(int) - 5, 0, LENGTHS - 1)
    return np.concatenate([np.stack(shares, axis=1), np.eye(LENGTHS)[kind]], axis=1)


def word_features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, length-one weight and start per text of the hashed words."""
    low = lowered(data)
    words, at = word_hashes(low, offsets, letters_only(low))
    values, counts, places = counted(words % np.uint64(buckets), at)
    weight = np.log1p(counts)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(places))
    norm = np.sqrt(np.bincount(owner, weight**2, len(at) - 1))
    return values.astype(np.int64), weight / np.maximum(norm[owner], 1e-9), places


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    buckets: int

    def vectors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature number and value of every text in one list, and where each text begins in it."""
        ids, values, at = word_features(data, offsets, self.buckets)
        dense = np.clip((structure(data, offsets) - self.centre) / self.scale, -4, 4)
        return joined(ids, values, at, dense, self.buckets)

    def raw(self, ids: np.ndarray, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic function, and the sum of v_i x_i per factor."""
        scaled = self.factors[ids] * values[:, None]
        total = np.add.reduceat(scaled, at[:-1], axis=0)
        squares = np.add.reduceat(scaled**2, at[:-1], axis=0)
        line = np.add.reduceat(self.linear[ids] * values, at[:-1])
        return self.bias + line + 0.5 * (total**2 - squares).sum(axis=1), total

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.vectors(data, offsets))[0], -30, 30)))


def joined(ids, values, at, dense, buckets):
    """Word features of each text followed by its dense features, numbered from ``buckets``."""
    n, width = dense.shape
    starts = at[:-1] + np.arange(n) * width
    total = len(ids) + n * width
    out_ids, out_values = np.empty(total, np.int64), np.empty(total)
    slots = (at[1:] + np.arange(n) * width)[:, None] + np.arange(width)
    words = np.ones(total, bool)
    words[slots.reshape(-1)] = False
    out_ids[slots] = buckets + np.arange(width)
    out_values[slots] = dense
    out_ids[words], out_values[words] = ids, values
    return out_ids, out_values, np.append(starts, total)


def fit(texts: list[str], y: np.ndarray, buckets: int = BUCKETS, rank: int = FACTORS, epochs: int = 8, batch: int = 32) -> FactorisationMachine:
    """Adagrad on the logistic loss. The order of rows is fixed by a seed."""
    rng = np.random.default_rng(7)
    parts = [t.encode() for t in texts]
    n_dense = structure(np.zeros(0, np.uint8), np.array([0, 0])).shape[1]
    rows, dense = [], np.zeros((len(parts), n_dense))
    for i, raw in enumerate(parts):
        data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
        rows.append(word_features(data, offsets, buckets)[:2])
        dense[i] = structure(data, offsets)[0]
    centre = dense.mean(axis=0) if len(rows) else np.zeros(n_dense)
    scale = np.maximum(dense.std(axis=0), 1e-3) if len(rows) else np.ones(n_dense)
    model = FactorisationMachine(0.0, np.zeros(buckets + n_dense), rng.normal(0, 0.01, (buckets + n_dense, rank)), centre, scale, buckets)
    if len(rows) == 0 or len(set(y.tolist())) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1) if len(rows) else 0.5
        model.bias, model.factors = float(np.log(share / (1 - share))), model.factors * 0
        return model
    dense = np.clip((dense - centre) / scale, -4, 4)
    model.bias = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    seen_bias, seen_linear, seen_factors = 1e-6, np.full(model.linear.shape, 1e-6), np.full(model.factors.shape, 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), batch):
            take = order[start : start + batch]
            sizes = np.array([len(rows[i][0]) for i in take])
            ids, values, at = joined(
                np.concatenate([rows[i][0] for i in take]),
                np.concatenate([rows[i][1] for i in take]),
                np.concatenate([[0], np.cumsum(sizes)]),
                dense[take],
                buckets,
            )
            raw, total = model.raw(ids, values, at)
            slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[take]) / len(take)
            owner = np.repeat(np.arange(len(take)), np.diff(at))
            used, place = np.unique(ids, return_inverse=True)
            by_line = np.bincount(place, slope[owner] * values) + 1e-5 * model.linear[used]
            pair = slope[owner][:, None] * (values[:, None] * total[owner] - model.factors[ids] * values[:, None] ** 2)
            by_factor = np.stack([np.bincount(place, pair[:, k]) for k in range(rank)], axis=1) + 1e-4 * model.factors[used]
            seen_bias += slope.sum() ** 2
            seen_linear[used] += by_line**2
            seen_factors[used] += by_factor**2
            model.bias -= 0.1 * slope.sum() / np.sqrt(seen_bias)
            model.linear[used] -= 0.1 * by_line / np.sqrt(seen_linear[used])
            model.factors[used] -= 0.05 * by_factor / np.sqrt(seen_factors[used])
    return model


def quality_model(docs: DataFrame, labels: DataFrame, train: Column, bound: int = BOUND) -> FactorisationMachine:
    """A machine fitted on at most ``bound`` labelled documents of the training fold (a column over doc_id)."""
    sample = labelled_sample(docs, labels, "quality", train, bound).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y")
    rows = sorted(sample.collect())
    return fit([r.text for r in rows], np.array([r.y for r in rows], float))


def with_quality(docs: DataFrame, model: FactorisationMachine, score: str = "score") -> DataFrame:
    """``docs`` with the model's probability of good quality in the column ``score`` (replaced, if there)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # some 300 kB, whatever the input
    schema = docs.drop(score).schema
    n = len(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text"):
                scores = pa.array(shared.value.score(data, offsets), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns[:n], scores], [*part.schema.names[:n], score])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.drop(score).mapInArrow(work, f"{names}, `{score}` double")


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, bound: int = BOUND) -> DataFrame:
    """(doc_id, held_out, score, predicted): learned from labelled rows outside the held-out fold."""
    model = quality_model(docs, labels, fold("doc_id", folds) != held, bound)
    scored = with_quality(narrowed(docs, "doc_id", "text"), model)
    return scored.select(
        "doc_id", (fold("doc_id", folds) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
