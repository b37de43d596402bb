import numpy as np
import pytest
from conftest import frame

from reviewloom.llm import mixing


def three_domains(spark):
    rng = np.random.default_rng(2)
    words = {d: [f"{d}{i}" for i in range(40)] + [f"all{i}" for i in range(20)] for d in "abc"}
    docs = [(i, " ".join(rng.choice(words["abc"[i % 3]], 30))) for i in range(240)]
    labels = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(0, 240, 2)], "doc_id bigint, domain string")
    return docs, labels


@pytest.mark.parametrize("gone", range(3))
def test_labels_of_missing_documents_do_not_count(spark, gone):
    docs, labels = three_domains(spark)
    left = [r for r in docs if r[0] % 3 != gone]
    targets = {"a": 0.25, "b": 0.5, "c": 0.25}
    anchor = "abc"[(gone + 1) % 3]
    got = mixing.mixing_rates(frame(spark, left), labels, targets, anchor).collect()
    own = labels.where(f"doc_id % 3 <> {gone}")
    want = mixing.mixing_rates(frame(spark, left), own, targets, anchor).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert all(r[f"p_{'abc'[gone]}"] == 0.0 for r in got)


def test_anchor_without_members_leaves_rates(spark):
    docs, labels = three_domains(spark)
    left = frame(spark, [r for r in docs if r[0] % 3 != 2])
    got = mixing.mixing_rates(left, labels, {"a": 0.25, "b": 0.5, "c": 0.25}, "c").collect()
    assert len(got) == 160 and all(r.rate == 1.0 for r in got)
