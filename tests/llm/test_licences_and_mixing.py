import re

import numpy as np
import pytest
from conftest import SMALL, frame, odd
from pyspark.sql import functions as F

from reviewloom.llm import licences, mixing
from reviewloom.llm.queries import DOMAIN_TARGETS, labelled_domains


def split(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower()) if w]


def runs(text):
    words = split(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def all_pairs(docs, templates, least=0.8):
    own = {}
    for i, t in docs:
        own.setdefault(i, set()).update(runs(t))
    return {
        (i, name, len(s & runs(t)), len(runs(t)))
        for i, s in own.items()
        for name, t in templates
        if runs(t) and len(s & runs(t)) / len(runs(t)) >= least
    }


def test_licences_equal_all_pairs(spark, documents):
    templates = list(licences.TEMPLATES)
    rows = list(documents)
    for n, (name, text) in enumerate(templates):
        words = text.split()
        rows.append((300_000 + n, "Some words before. " + text.upper() + " And after."))
        rows.append((310_000 + n, " ".join(words[: len(words) * 9 // 10])))
        changed = ["changed" if i == len(words) // 2 else w for i, w in enumerate(words)]
        rows.append((320_000 + n, "x y z " + " ".join(changed)))
    rows += [(None, templates[0][1]), (None, templates[1][1]), (1, templates[0][1])]
    table = spark.createDataFrame(templates, "template string, text string")
    got = licences.found_licences(odd(spark, rows), table).collect()
    assert {(r.doc_id, r.template, r.n_shared, r.n_template) for r in got} == all_pairs(rows, templates)
    assert all(r.containment == r.n_shared / r.n_template for r in got)


def test_licence_edge_cases(spark):
    table = spark.createDataFrame([("none", None), ("short", "one two"), ("five", "a b c d e")], "template string, text string")
    rows = [(1, None), (2, ""), (3, "one two"), (4, "x a b c d e y"), (5, "a b c d")]
    got = licences.found_licences(frame(spark, rows), table).collect()
    assert [(r.doc_id, r.template) for r in got] == [(4, "five")]
    assert licences.found_licences(frame(spark, []), table).count() == 0
    assert licences.found_licences(frame(spark, rows), table.limit(0)).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    return labelled_domains(spark.read.parquet(f"{SMALL}/labels.parquet"))


def test_rates_meet_the_targets(spark, documents, labelled):
    rows = documents + [(None, "null id"), (5, "again"), (5, "again")]
    got = mixing.mixing_rates(odd(spark, rows), labelled, DOMAIN_TARGETS, "clean").toPandas()
    assert len(got) == len(rows)
    names = [f"p_{d}" for d in DOMAIN_TARGETS]
    assert np.allclose(got[names].sum(axis=1), 1) and (got.rate >= 0).all()
    mass = np.array([(got.tokens * got.rate * got[n]).sum() for n in names])
    before = (got.tokens * got["p_clean"]).sum()
    goal = before * np.array(list(DOMAIN_TARGETS.values())) / DOMAIN_TARGETS["clean"]
    assert np.abs(mass - goal).max() <= 2e-4 * goal.sum()
    assert ((got.copies - got.rate).abs() < 1 + 1e-9).all()


def test_least_squares_equals_numpy(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.4, 0.3, 0.3], 500)
    tokens = rng.integers(1, 2000, 500)
    rows = spark.createDataFrame([(int(t), *map(float, x)) for t, x in zip(tokens, p)], "_mix_tokens bigint, _mix_p0 double, _mix_p1 double, _mix_p2 double")
    goal = [0.6, 0.1, 0.3]
    steps = mixing.fitted_steps(rows, goal, 0)
    rate = np.ones(500)
    for step in steps:
        rate = np.maximum(0, rate - p @ np.array(step))
    got = np.array([r.rate for r in rows.select(mixing.rate_column(steps).alias("rate")).collect()])
    assert np.allclose(np.sort(got), np.sort(rate))
    mass = (tokens * rate) @ p
    want = (tokens @ p)[0] * np.array(goal) / goal[0]
    assert np.abs(mass - want).max() < 1e-3 * want.sum()


def test_classifier_and_copies(spark):
    rng = np.random.default_rng(1)
    words = {d: [f"{d}{i}" for i in range(40)] for d in "abc"}
    docs, labels = [], []
    for i in range(240):
        d = "abc"[i % 3]
        docs.append((i, " ".join(rng.choice(words[d], 30))))
        if i % 2:
            labels.append((i, d))
    docs = frame(spark, docs)
    table = spark.createDataFrame([*labels, (None, "a"), (3, None), (4, "unknown")], "doc_id bigint, domain string")
    targets = {"a": 0.25, "b": 0.5, "c": 0.25}
    rates = mixing.mixing_rates(docs, table, targets, "a").toPandas().sort_values("doc_id")
    for k, d in enumerate("abc"):
        assert (rates[f"p_{d}"][rates.doc_id % 3 == k] > 0.9).all()
    out = mixing.mixed(docs.withColumn("copies", F.lit("mine")), table, targets, "a")
    assert out.columns == ["doc_id", "text", "copies"]
    count = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert count == {int(i): int(c) for i, c in zip(rates.doc_id, rates.copies) if c}


def test_mixing_edge_cases(spark, labelled):
    assert mixing.mixing_rates(frame(spark, []), labelled, DOMAIN_TARGETS, "clean").count() == 0
    rows = [(1, None), (2, ""), (3, "some words"), (None, "x")]
    got = mixing.mixing_rates(frame(spark, rows), labelled.limit(0), DOMAIN_TARGETS, "clean").collect()
    assert len(got) == 4 and all(r.p_clean == 1.0 and r.rate == 1.0 and r.copies == 1 for r in got)
