import brute
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from reviewloom.llm import mixing
from reviewloom.llm.queries import DOMAIN_TARGETS, REGISTERED, labelled_domains

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, out[-1], SMALL).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_registered():
    names = entry.queries()
    assert set(REGISTERED) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTERED) == list(range(1, 14))


def test_columns(stages):
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_quality_rejects_what_is_labelled_so(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    left = {i for i, _ in pairs(stages[1])}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(good - left) <= 0.02 * len(good) and len(bad & left) <= 0.1 * len(bad)


def test_one_of_each_class_stays(stages):
    classes = brute.near_classes(pairs(stages[1]))
    assert sorted(i for i, _ in pairs(stages[2])) == sorted(set(classes.values()))


def test_passages_go_and_columns_stay(stages):
    removed = {r[0]: r for r in brute.remove_repeats(pairs(stages[2]))}
    before = {r.doc_id: r for r in stages[2].collect()}
    for r in stages[3].collect():
        kept = removed[r.doc_id][1] - removed[r.doc_id][2]
        # at most the broken characters at the edges of cuts are lost beyond that
        assert kept - 6 * removed[r.doc_id][3] <= len(r.text.encode()) <= kept
        assert (r.lang, r.source, r.n_chars) == (before[r.doc_id].lang, before[r.doc_id].source, len(r.text))


def test_mixture_repeats_or_drops_whole_rows(spark, stages):
    rows = {tuple(r) for r in stages[3].collect()}
    assert {tuple(r) for r in stages[4].collect()} <= rows


def test_every_row_is_packed(stages):
    last = stages[5]
    assert last.where("piece = 0").count() == stages[4].count()
    assert last.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_run_equals_the_stages(spark, stages):
    got = pipeline.run(spark, SMALL)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, stages[5].select(*key).collect()))


def test_mixture_keeps_clean_documents(spark, stages):
    labels = labelled_domains(spark.read.parquet(f"{SMALL}/labels.parquet"))
    got = {r.doc_id: r for r in mixing.mixing_rates(stages[3], labels, DOMAIN_TARGETS, "clean").collect()}
    domain = dict(pairs_of(labels))
    buckets = {i: list(w) for i, w in pairs_of(stages[3].select("doc_id", mixing.word_buckets(F.col("text"))))}
    want = brute.memberships(buckets, domain, list(DOMAIN_TARGETS), mixing.BUCKETS, mixing.SMOOTH, mixing.SHARP)
    assert sorted(got) == sorted(want)
    for i, shares in want.items():
        assert [got[i][f"p_{d}"] for d in DOMAIN_TARGETS] == pytest.approx(shares, abs=1e-6)
    clean = [i for i in got if domain.get(i) == "clean"]
    assert sum(got[i].copies == 0 for i in clean) <= 0.03 * len(clean)


def pairs_of(df):
    return [tuple(r) for r in df.where("doc_id IS NOT NULL").collect() if r[1] is not None]


def test_quality_stage_leaves_a_column_of_its_name_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40).withColumn("_Quality", F.lit("mine"))
    docs = docs.unionByName(docs.limit(2)).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    kept = pipeline.good_quality(spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert {r["_Quality"] for r in kept.collect()} == {"mine"}
    assert pipeline.good_quality(spark, docs.limit(0), SMALL).count() == 0
