import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm.neighbours import balanced_parts, nearest, neighbour_graph

SCHEMA = "vec_id bigint, embedding array<float>"


def exact(rows, queries, k=10):
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in queries:
        d = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        order = [i for i in np.lexsort((ids, d)) if np.isfinite(d[i])][:k]
        out[q] = [(int(ids[i]), d[i]) for i in order]
    return out


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_recall_and_scores(spark, scale):
    rows = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet")
    got = nearest(rows, F.col("vec_id") % 100 == 0).collect()
    want = exact([(r.vec_id, r.embedding) for r in rows.collect()], {r.query_id for r in got})
    hits = sum((r.vec_id, pytest.approx(r.score, rel=1e-12)) in want[r.query_id] for r in got)
    assert hits >= 0.9 * sum(len(w) for w in want.values())
    assert {r.query_id for r in got} == {r.vec_id for r in rows.where("vec_id % 100 = 0").collect()}
    for q in want:
        own = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, 11)) and own == sorted(own, key=lambda r: r[1:])


def test_parts_are_balanced():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(1000, 8)) + 6 * rng.integers(0, 3, 1000)[:, None]
    part = balanced_parts(vectors, neighbour_graph(vectors, 8), 8)
    assert np.bincount(part, minlength=8).max() <= 1000 / 8 * 1.05 + 2


def test_one_common_vector_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 700)] + [(i, rng.normal(size=3).tolist()) for i in range(700, 1500)]
    got = nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 100).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 0.0) for i in range(10)]


def test_unusable_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0], [1.0, 2.0, 3.0]]
    rows = [(100 * i, v) for i, v in enumerate(bad, 1)] + [(None, [1.0, 1.0]), (5000, [1.0, 0.0]), (5001, [0.0, 1.0]), (5002, [1.0, 0.5]), (5001, [0.0, 2.0])]
    wide = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", query_id string, part int")
    got = nearest(wide, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(5000, 5002), (5000, 5001), (5000, 5001)]
    assert nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0])], SCHEMA), F.col("vec_id") % 100 == 0).count() == 0
