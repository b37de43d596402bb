import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL, frame, odd
from pyspark.sql import functions as F

from reviewloom.llm import lm, quality_fm, toxicity
from reviewloom.llm.common import fold

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{MIDDLE}/labels.parquet")


def accuracy(scored, labels, label):
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    return sum(r.predicted == r[label] for r in rows) / len(rows)


def test_linear_time_pairs_equal_all_pairs():
    rng = np.random.default_rng(0)
    model = quality_fm.FactorisationMachine(0.3, rng.normal(size=20), rng.normal(size=(20, 4)), np.zeros(1), np.ones(1), 20)
    ids, values = np.array([1, 5, 7, 19]), rng.normal(size=4)
    pairs = sum(model.factors[a] @ model.factors[b] * x * y for i, (a, x) in enumerate(zip(ids, values)) for b, y in list(zip(ids, values))[i + 1 :])
    assert model.raw(ids, values, np.array([0, 4]))[0][0] == pytest.approx(0.3 + model.linear[ids] @ values + pairs)


def test_quality_on_held_out_labels(spark, labels):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    scored = quality_fm.quality_scores(docs, labels)
    assert scored.count() == docs.count()
    assert scored.where("score < 0 or score > 1 or predicted != cast(score >= 0.5 as int)").count() == 0
    assert accuracy(scored, labels, "quality") > 0.95
    fold_of = {r.doc_id: r.held_out for r in scored.collect()}
    assert all(held == (zlib.crc32(str(i).encode()) % 3 == 1) for i, held in fold_of.items())


def test_toxicity_on_held_out_labels(spark, labels):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    assert accuracy(toxicity.toxicity_scores(docs, labels), labels, "toxic") > 0.9


def test_toxicity_learns_words_and_their_forms():
    rng = np.random.default_rng(1)
    plain = [" ".join(f"w{rng.integers(3000)}" for _ in range(60)) for _ in range(300)]
    marked = [f"{t} grumz{rng.integers(99)}x {t[:30]}" for t in plain[:150]]
    net = toxicity.fit(marked + plain[150:], np.array([1.0] * 150 + [0.0] * 150), ["en"] * 300)
    fresh = [" ".join(f"v{rng.integers(3000)}" for _ in range(80)) for _ in range(40)]

    def score(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return net.score(raw, np.array([0, len(raw)]))[0]

    assert np.mean([score(t + " grumz123 end") > 0.5 for t in fresh]) > 0.9
    assert np.mean([score(t) < 0.5 for t in fresh]) > 0.9


@pytest.mark.parametrize("scores", [quality_fm.quality_scores, toxicity.toxicity_scores])
def test_defined_cases(spark, documents, scores):
    labelled = frame(spark, [(1, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, None)], "doc_id bigint, quality int, toxic int")
    rows = documents + [(None, "null id"), (5, "again"), (5, "again")]
    got = scores(odd(spark, rows), labelled)
    assert got.count() == len(rows)
    assert got.where("score is null or isnan(score) or held_out is null").count() == 0
    assert scores(odd(spark, rows), labelled.limit(0)).count() == len(rows)
    assert scores(odd(spark, []), labelled).count() == 0


def tokens(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w] + [None]


def test_language_model_counts_and_base_score(spark, documents):
    rows = documents + [(None, "null id"), (5, "Again AGAIN"), (5, "again")]
    # small chunks, so that counts come from many of them
    got = lm.held_out_scores(odd(spark, rows), chunk_text=20_000, vocabulary=64).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), held(i), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens(t)))
        for i, t in rows
    )
    for w, g in zip(want, sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)):
        assert w[:5] == g[:5] and g[5] == pytest.approx(w[5], rel=1e-9)


def test_language_model_is_normalised():
    rng = np.random.default_rng(0)
    words = np.sort(rng.integers(1, 2**63, 30).astype(np.uint64))
    size = lm.LogBilinear.outputs_of(words, 3) + 1
    model = lm.LogBilinear.fresh(words, rng.integers(1, 100, size), 3)
    outputs = np.arange(size, dtype=np.int32)
    assert model.outputs(words).tolist() == [i + int(w >> np.uint64(61)) for i, w in enumerate(words)]
    trained, visits = model.trained([(outputs, outputs[::-1], outputs)], seed=1)
    assert len(visits) == len(model.flat())
    for tried in (model, trained):
        for one, two in [(0, 0), (size - 1, size - 1), (31, 5)]:
            p = 10 ** tried.log10s(outputs, np.full(size, one, np.int32), np.full(size, two, np.int32))
            assert p.sum() == pytest.approx(1, abs=1e-4)


def test_language_model_learns_what_follows_what(spark):
    rng = np.random.default_rng(2)
    def text():
        out = []
        for _ in range(60):
            a = rng.integers(8)
            out += [f"a{a}", f"b{a}"]
        return " ".join(out)
    rows = [(i, text()) for i in range(300)]
    got = lm.text_scores(frame(spark, rows), fold("doc_id", 7) == 2, vocabulary=40, rounds=3, chunk_text=20_000).where("held_out").collect()
    assert sum(r.score for r in got) > 0.85 * sum(r.base_score for r in got)  # scores are negative


def test_language_model_without_training_texts(spark):
    got = lm.text_scores(frame(spark, [(1, "a b"), (2, None)]), F.lit(True)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert all(r.score < 0 for r in got)
    assert lm.text_scores(frame(spark, []), F.lit(False)).count() == 0


def test_toxicity_learns_from_rows_beyond_those_that_begin_it(spark):
    """Two marks, one of them only in documents that do not begin the network."""
    rng = np.random.default_rng(5)
    plain = [" ".join(f"w{rng.integers(300)}" for _ in range(30)) for _ in range(900)]
    first = {r[0] for r in spark.range(900).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(300).collect()}
    toxic = {i for i in range(900) if i % 3 == 0}
    rows = [(i, f"{t} {'grumzo' if i in first else 'plovkat'} {t[:20]}" if i in toxic else t, "en") for i, t in enumerate(plain)]
    labels = frame(spark, [(i, int(i in toxic)) for i in range(900)], "doc_id bigint, toxic int")
    net = toxicity.toxicity_network(frame(spark, rows, "doc_id bigint, text string, lang string"), labels, F.lit(True), bound=200, group=150)

    def score(text):
        return net.score(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))[0]

    fresh = [" ".join(f"w{rng.integers(300)}" for _ in range(30)) for _ in range(40)]
    assert np.mean([score(f"{t} plovkat w1") > score(t) + 0.2 for t in fresh]) > 0.9


def test_toxicity_thresholds_come_from_all_rows(spark):
    """Distributed thresholds over all rows equal those of the rows at hand, ties included."""
    rng = np.random.default_rng(6)
    rows = [("en" if i % 3 else None if i % 2 else "de", float(np.round(rng.random(), 2)), int(rng.random() < 0.3)) for i in range(2000)]
    rows += [("fr", 0.5, 1)] * 9 + [("fr", 0.1, 0)] * 50
    got = toxicity.best_thresholds(frame(spark, rows, "lang string, score double, y int").repartition(5))
    scores, marks = np.array([r[1] for r in rows]), np.array([float(r[2]) for r in rows])
    want = {"": toxicity.best_threshold(scores, marks)}
    for lang in ("en", "de"):
        own = np.array([r[0] == lang for r in rows])
        want[lang] = toxicity.best_threshold(scores[own], marks[own])
    assert got == pytest.approx(want)
