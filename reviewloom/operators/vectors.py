"""Centroids and nearest-centroid decisions over vector columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Centroids travel to the tasks inside the plan: one per label, so a few thousand at the most.
MAX_CENTROIDS = 5_000


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two vector columns; NULL when either has no length."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def centroids(seeds: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Element-wise mean of the seed vectors of a label; the mean is not normalised again."""
    means = (
        seeds.select(*keys, F.posexplode(vector).alias("pos", "x"))
        .groupBy(*keys, "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"])
    return means.groupBy(*keys).agg(ordered.alias("vec"))


def load_centroids(table: DataFrame, label: str, vector: str = "vec", order: str | None = None) -> list[tuple[str, list]]:
    """Centroids in label order, for ``nearest``. One row per label, refused beyond the bound."""
    rows = table.select(F.col(label).cast("string"), vector).orderBy(order or label).limit(MAX_CENTROIDS + 1).collect()
    if len(rows) > MAX_CENTROIDS:
        raise ValueError(f"at most {MAX_CENTROIDS} centroids are supported")
    return [(r[0], list(r[1])) for r in rows]


def nearest(vector: Column, labels: list[tuple[str, list]]) -> Column:
    """Best label with its score and its margin to the runner-up, scored batch by batch.

    Ties go to the first label given. With one label the margin is 1. A vector of the wrong length or
    without length gives an error text instead of a label; a NULL vector gives NULLs.
    """
    names = np.array([name for name, _ in labels], dtype=object)
    matrix = np.array([vec for _, vec in labels], dtype="float64")
    matrix = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    width = matrix.shape[1]

    @F.pandas_udf("label string, score double, margin double, error string")
    def score(vectors: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame(
            {"label": None, "score": np.nan, "margin": np.nan, "error": None}, index=vectors.index, dtype=object
        )
        given = vectors.notna()
        sized = given & vectors.map(lambda v: v is not None and len(v) == width)
        out.loc[given & ~sized, "error"] = f"vector must have {width} elements"
        if sized.any():
            rows = np.stack(vectors[sized].to_list()).astype("float64")
            length = np.linalg.norm(rows, axis=1)
            usable = np.isfinite(length) & (length > 0)
            idx = vectors.index[sized]
            out.loc[idx[~usable], "error"] = "vector has no length"
            if usable.any():
                sims = (rows[usable] / length[usable, None]) @ matrix.T
                best = sims.argmax(axis=1)
                top = sims[np.arange(len(best)), best]
                if sims.shape[1] > 1:
                    margin = top - np.partition(sims, -2, axis=1)[:, -2]
                else:
                    margin = np.ones(len(best))
                out.loc[idx[usable], "label"] = names[best]
                out.loc[idx[usable], "score"] = top
                out.loc[idx[usable], "margin"] = margin
        return out.astype({"score": "float64", "margin": "float64"})

    return score(vector)


def decide(best: Column, threshold: float, margin: float) -> Column:
    """Whether the best label is clear enough. Tests use the unrounded values."""
    return F.coalesce((best["score"] >= threshold) & (best["margin"] >= margin), F.lit(False))
