"""Work that is done for every word of every text."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.functions import keywords
from reviewloom.operators import encode, tagging
from reviewloom.operators import taxonomy as tax


def plan(df):
    return df._jdf.queryExecution().toString().lower()


def test_words_meet_patterns_only_behind_plain_comparisons(spark):
    texts = ["Don't can’t it's they're 12 １２ ½x x2 a1 ²³ élan Éclair's rock'n'roll ir dogs' n't l'eau we'd panels IR ٣٤ ٣ab", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    got = rows.select("k", keywords.keyword_list(F.col("t")).alias("w"))
    assert {r.k: r.w for r in got.collect()} == {0: ["élan", "éclair", "rock'n'roll", "ir", "dogs", "l'eau", "panel", "ir", "٣ab"], 1: [], 2: []}
    assert "rlike(n't$)" not in plan(got) and "n't$" not in plan(got)


def test_large_form_tables_look_each_word_up(spark):
    forms = {f"form{i}s": f"form{i}" for i in range(600)}
    rows = spark.createDataFrame([(i, f"form{i}s other form{i + 1}s form{i}s" if i % 5 else None) for i in range(40)], "k int, t string").repartition(3)
    got = {r.k: r.w for r in rows.select("k", keywords.keyword_list(F.col("t"), forms=forms).alias("w")).collect()}
    # "other" is a stop word
    assert got == {i: [f"form{i}", f"form{i + 1}", f"form{i}"] if i % 5 else [] for i in range(40)}


def test_signs_are_made_per_distinct_word(spark, monkeypatch):
    monkeypatch.setattr(encode, "STRETCH", 3)
    rows = [(i, " ".join(f"word{(i * 7 + j) % 11}" for j in range(i % 6))) for i in range(20)]
    counts = encode.word_counts(spark.createDataFrame(rows, "k int, t string"), "k", "t")
    projected = encode.projected_vectors(counts, "k", encode.document_frequencies(counts), 20, width=200)
    assert "md5" not in plan(projected)
    bags = {}
    for r in counts.collect():
        bags.setdefault(r.k, {})[r.word] = r.n
    texts = {w: sum(w in bag for bag in bags.values()) for bag in bags.values() for w in bag}
    got = {r.k: r.embedding for r in projected.collect()}
    assert set(got) == set(bags)
    for k, bag in bags.items():
        want = np.zeros(200)
        for w, n in bag.items():
            bits = b"".join(hashlib.md5(f"{b}:{w}".encode()).digest() for b in range(2))
            want += n * np.log(21 / (1 + texts[w])) * (2.0 * np.unpackbits(np.frombuffer(bits, np.uint8))[:200] - 1)
        assert got[k] == pytest.approx(want / np.sqrt(200), abs=1e-5)


def test_bridges_run_patterns_and_scores_once(spark):
    """Reviews that need a vector: neither a pattern nor the scoring may be copied below a filter on the status."""
    rules = [tax.Rule("scene", "Sky", "blue", 0, "blue.?sky")]
    reviews = spark.createDataFrame(
        [("a", "Blue sky", None, None), ("b", "grey", None, [1.0, 0.0]), ("c", "grey", None, [1.0]), ("d", " ", None, [1.0, 0.0])],
        "Review_ID string, Clean_Text string, Rating int, embedding array<float>",
    )
    tagged = tagging.tag_reviews(reviews, rules, {"scene": [("blue", [1.0, 0.0]), ("red", [0.0, 1.0])]}, vector="embedding")
    bridge = tagging.bridges(tagged)["scene_bridge"]
    optimised = bridge._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("ArrowEvalPython") == 1 and optimised.count("blue.?sky") == 1
    assert sorted((r.Review_ID, r.Sub_Scene) for r in bridge.collect()) == [("a", "blue"), ("b", "blue")]
