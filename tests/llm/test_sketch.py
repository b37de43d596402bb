import hashlib

import brute
import numpy as np
import pytest
from conftest import frame, odd
from pyspark.sql import functions as F

from reviewloom.llm.sketch import (
    containment,
    distinct_count,
    edited_fingerprints,
    fingerprints,
    from_text,
    merge_groups,
    merged,
    resemblance,
    sketches,
    to_text,
    with_successor,
)


def sketch(text, k=128):
    raw = np.frombuffer(text.encode(), np.uint8)
    return sketches(raw, np.array([0, len(raw)]), k)[0]


def test_estimates():
    rng = np.random.default_rng(0)
    words = [f"{x}" for x in rng.integers(10**9, size=6000)]
    a, b = " ".join(words[:4000]), " ".join(words[2000:])
    x, y = sketch(a, 512), sketch(b, 512)
    assert resemblance(x, y, 512) == pytest.approx(1 / 3, abs=0.08)
    assert containment(x, y, 512) == pytest.approx(0.5, abs=0.12)
    assert distinct_count(x, 512) == pytest.approx(3996, rel=0.15)
    assert (merged(x, y, 512) == sketch(" ".join(words[:4004]), 512)).mean() < 1
    small = sketch("one two three four five six seven")
    assert distinct_count(small) == 3 and from_text(to_text(small)).tolist() == small.tolist()
    assert resemblance(sketch(""), sketch("")) == 1.0 and resemblance(sketch(""), small) == 0.0


def test_repeated_shingles_do_not_crowd_out_others():
    text = "a b c d e " * 2000 + " ".join(f"w{i}" for i in range(40))
    assert len(sketch(text, 16)) == 16
    assert sketch(text, 16).tolist() == np.unique(sketch(text, 4096))[:16].tolist()


@pytest.mark.parametrize("ranges", [1, 2, 7, 30])
def test_edits_follow_the_order_of_ids(spark, documents, ranges):
    rows = documents + [(None, "first without id"), (None, "second without id"), (17, "same id, other text"), (17, "same id, other text")]
    got = edited_fingerprints(odd(spark, rows), ranges=ranges).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    want = []
    for k, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        want.append((str(i), len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    by_text = {}
    for r in got:
        by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    exact = {i: set(brute.shingles(t)) for i, t in documents}
    # likeness of sketches made here of the text, its edit and the next text
    texts = [t or "" for _, t in ordered]
    alike = []
    for k, (i, _) in enumerate(ordered):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        own = sketch(text)
        alike.append((str(i), len(text), resemblance(own, sketch(text[: len(text) - half] + after[:half])), resemblance(own, sketch(after))))
    assert sorted((str(r.doc_id), r.n_chars, r.near_edited, r.near_next) for r in got) == sorted(alike)
    several = [r for r in got if r.doc_id in exact and len(exact[r.doc_id]) < 100 and r.doc_id != 17]
    assert all(r.n_shingles == len(exact[r.doc_id]) for r in several)


def test_merging_parts_of_groups(spark):
    rng = np.random.default_rng(1)
    words = [f"{x}" for x in rng.integers(10**9, size=900)]
    parts = [(i, " ".join(words[100 * i : 100 * i + 104])) for i in range(8)] + [(99, None)]
    prints = {r.doc_id: r for r in fingerprints(frame(spark, parts), 64).collect()}
    rows = [("all", prints[i].fingerprint) for i in range(8)] + [("none", prints[99].fingerprint)]
    got = {r.key: r.fingerprint for r in merge_groups(spark.createDataFrame(rows, "key string, fingerprint string"), "key", k=64).collect()}
    assert got == {"all": to_text(sketch(" ".join(words[:804]), 64)), "none": ""}


def test_runs_have_tasks_of_their_own(spark):
    dealt = with_successor(frame(spark, [(i, f"text {i}") for i in range(400)]), 23)
    sizes = [r.n for r in dealt.groupBy(F.spark_partition_id().alias("p"), "part").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 23 and max(sizes) < 2 * min(sizes)


def test_empty(spark):
    assert edited_fingerprints(frame(spark, [])).count() == 0
    one = edited_fingerprints(frame(spark, [(1, "abcd")])).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(4, 1.0)]
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
