import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.functions import dates
from reviewloom.operators import encode
from reviewloom.plans import dims
from reviewloom.session import scratch_path

TEXTS = [(1, "red panel warm panel"), (2, "warm knee"), (3, "the of"), (4, None), (5, ""), (6, "panel " * 3000 + "unseen"), (7, "warm knee")]


def by_hand(bag, texts_of, texts):
    out = np.zeros(384)
    for word, n in bag.items():
        bits = "".join(f"{byte:08b}" for b in range(3) for byte in hashlib.md5(f"{b}:{word}".encode()).digest())
        out += n * math.log((1 + texts) / (1 + texts_of.get(word, 0))) * np.array([1 if bit == "1" else -1 for bit in bits])
    return out / math.sqrt(384)


def test_projected_vectors(spark):
    rows = spark.createDataFrame(TEXTS, "id long, t string")
    counts = encode.word_counts(rows, "id", "t")
    frequencies = encode.document_frequencies(counts.where("id <> 6"))
    got = {r[0]: np.array(r[1]) for r in encode.projected_vectors(counts, "id", frequencies, 6).collect()}
    assert set(got) == {1, 2, 6, 7}  # no words, no row
    texts_of = {"red": 1, "panel": 1, "warm": 3, "knee": 2}
    bags = {1: {"red": 1, "panel": 2, "warm": 1}, 2: {"warm": 1, "knee": 1}, 6: {"panel": 3000, "unseen": 1}}
    for key, bag in bags.items():
        assert np.allclose(got[key], by_hand(bag, texts_of, 6), rtol=1e-5, atol=1e-4)
    assert (got[2] == got[7]).all()
    none = encode.word_counts(rows.where("false"), "id", "t")
    assert encode.projected_vectors(none, "id", encode.document_frequencies(none), 0).count() == 0


def test_frequencies_of_batches_merge(spark):
    rows = spark.createDataFrame(TEXTS, "id long, t string")
    counts = encode.word_counts(rows, "id", "t")
    parts = [encode.document_frequencies(counts.where(c)) for c in ("id <= 2", "id > 2")]
    assert sorted(encode.merged_frequencies(*parts).collect()) == sorted(encode.document_frequencies(counts).collect())


@pytest.fixture
def facts(spark):
    days = [(1, "2024-01-05", 1), (2, "2024-01-31", 5), (3, "2024-03-01", 4), (4, None, 3), (5, "2023-12-31", 2), (6, "2025-02-01", 1)]
    reviews = spark.createDataFrame(days, "review_id long, d string, rating int").select("review_id", F.to_date("d").alias("review_date"), "rating")
    tagged = spark.createDataFrame([(1,), (1,), (5,)], "review_id long")
    path = scratch_path(spark, "facts")
    dims.write_by_month(dims.review_facts(reviews, tagged), path)
    return spark.read.parquet(path), dates.calendar(reviews, "review_date")


def test_months_without_reviews_are_blank_rows(facts):
    rows, calendar = facts
    got = {str(r[0])[:7]: tuple(r)[1:] for r in dims.months_on_calendar(rows, calendar.where("Year = 2024 AND QuarterNo = 1")).collect()}
    assert got == {"2024-01": (2, 1, 3.0), "2024-02": (None, None, None), "2024-03": (1, None, 4.0)}


def test_only_chosen_months_are_read(facts):
    rows, calendar = facts
    picked = dims.months_on_calendar(rows, calendar.where("Year = 2024 AND MonthNo = 3"))
    plan = picked._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()
    assert [r["reviews"] for r in picked.collect()] == [1]
