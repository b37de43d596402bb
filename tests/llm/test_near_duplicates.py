import brute
import numpy as np
from conftest import frame, odd
from pyspark.sql import functions as F

from reviewloom.llm import bagminhash, common
from reviewloom.llm.bagminhash import FAR_BITS, bag_signatures, deduplicated, near_duplicates, sketch_words, weighted_jaccard
from reviewloom.llm.common import components, materialise


def test_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    for _ in range(10):
        ids = np.sort(rng.integers(1, 2**63, 150).astype(np.uint64))
        counts, other = rng.integers(1, 9, 150), rng.integers(1, 9, 150)
        keep = rng.random(150) < 0.8
        a, b = (ids, counts), (ids[keep], np.where(rng.random(150) < 0.5, counts, other)[keep])
        marks = bag_signatures(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.array([0, 150, 150 + keep.sum()]), 3000)
        assert abs((marks[0] == marks[1]).mean() - weighted_jaccard(a, b)) < 0.05


def test_bits_of_like_texts_agree():
    rng = np.random.default_rng(1)
    ids = np.sort(rng.integers(1, 2**63, 400).astype(np.uint64))
    ones = np.ones(400, np.int64)
    for _ in range(20):
        keep = np.sort(rng.permutation(400)[:320])  # similarity 0.8
        marks = bag_signatures(np.concatenate([ids, ids[keep]]), np.concatenate([ones, ones[:320]]), np.array([0, 400, 720]), 315)
        a, b = (w.view(np.uint64) for w in sketch_words(marks))
        assert sum(int(x ^ y).bit_count() for x, y in zip(a, b)) <= FAR_BITS


def test_classes_equal_all_pairs(spark, documents):
    got = {r.doc_id: r.class_id for r in near_duplicates(odd(spark, documents)).collect()}
    assert got == brute.near_classes(documents)


def test_wide_buckets_are_split_without_loss(spark):
    # every text shares most of its words with all others, and some are near copies in chains
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for j in rng.choice(120, rng.integers(1, 9), replace=False):
            words[j] = f"x{i}-{j}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.class_id for r in near_duplicates(frame(spark, rows), block_rows=7).collect()}
    assert got == brute.near_classes(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "z"), (3, "z"), (4, None), (5, "")]
    got = near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.class_id) for r in got} == {(None, 3), (3, 3), (4, 4), (5, 4)}
    left = sorted((str(r.doc_id), str(r.text)) for r in deduplicated(frame(spark, rows)).collect())
    assert left == [("3", "a b c d e f"), ("3", "z"), ("4", "None")]


def test_empty(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    assert deduplicated(frame(spark, [])).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200)] + [(300, 300)]
    got = {r.node: r.root for r in components(frame(spark, links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200, 202: 200}


def test_stars_need_no_round(spark, monkeypatch):
    # links whose nodes hang on the smallest one already, some of them twice, are seen to be at rest by one aggregate
    links = [(100, i) for i in range(101, 140)] + [(139, 100), (7, 9)]
    stored = []
    monkeypatch.setattr(common, "materialise", lambda df, label: stored.append(label) or materialise(df, label))
    got = {r.node: r.root for r in components(frame(spark, links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 140)}, 7: 7, 9: 7}
    assert len(stored) <= 2


def test_components_without_broadcast(spark, monkeypatch):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(i, 100) for i in range(150, 160)]
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0, raising=False)
    got = {r.node: r.root for r in components(frame(spark, links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in [*range(100, 140), *range(150, 160)]}}


def test_kept_is_one_of_each_class(spark, documents):
    kept = near_duplicates(frame(spark, documents)).where(F.col("kept"))
    assert kept.count() == kept.select("class_id").distinct().count() == len(set(brute.near_classes(documents).values()))


def test_no_row_for_each_pair_of_texts_that_are_almost_near(spark, monkeypatch):
    # any two texts are at some 0.76, so most pairs pass for candidates and none is a link
    rng = np.random.default_rng(5)
    rows = []
    for i in range(150):
        words = [f"b{k}" for k in range(604)]
        for j in range(8):
            words[int(rng.integers(8 + j * 74, 70 + j * 74))] = f"x{i}-{j}"
        rows.append((i, " ".join(words)))
    stored = []

    def counted_rows(df, label):
        out = materialise(df, label)
        stored.append(out.count())
        return out

    monkeypatch.setattr(bagminhash, "materialise", counted_rows)
    got = near_duplicates(frame(spark, rows)).select("doc_id", "class_id").collect()
    assert {r.doc_id: r.class_id for r in got} == brute.near_classes(rows)
    assert max(stored) <= len(rows) * bagminhash.BANDS < 150 * 149 // 2
