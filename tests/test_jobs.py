import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.operators import encode
from reviewloom.plans import dims, jobs
from reviewloom.schemas import BRIDGES, FEATURE_TABLES
from reviewloom.streaming.ingest import ingest, rejected_files

URL = "https://h/gp/customer-reviews/{}/ref=cm"
TEXTS = {
    "r1": "The mask gets too hot.",
    "r2": "Poor quality plastic, used at home in the morning.",
    "r3": "Relaxing at home.",
    "r4": "Bought this for my back pain.",
    "r5": None,
}


def raw(spark, extra=()):
    data = [(f"A_{k}", k, "A", 3, v, 1) for k, v in TEXTS.items()] + list(extra)
    return spark.createDataFrame(data, "Review_Key string, Review_ID string, ASIN string, Rating bigint, Clean_Text string, Helpful_Votes bigint").withColumn("Review_Date", F.lit("2024-01-01").cast("date"))


def status(spark):
    data = [("r1", "SUCCESS", "v1"), ("r2", "FAILED", "v1"), ("r3", "SUCCESS", "v0")]
    return spark.createDataFrame(data, "Review_ID string, Processing_Status string, Model_Version string").select(
        "Review_ID", "Model_Version", F.lit("2024-01-01").cast("timestamp").alias("Processed_Time"), "Processing_Status", F.lit(None).cast("string").alias("Error_Message")
    )


def content(house):
    tables = {}
    for name in FEATURE_TABLES:
        df = house.table(name)
        tables[name] = sorted(map(str, df.drop("Processed_Time").collect()))
    return tables


@pytest.fixture
def house(spark, warehouse):
    warehouse.overwrite("review_raw", raw(spark))
    warehouse.overwrite("review_processing", status(spark), FEATURE_TABLES["review_processing"])
    old = spark.createDataFrame([("r1", "Old", "old"), ("r3", "Old", "old")], "Review_ID string, Main_Scene string, Sub_Scene string")
    warehouse.append("scene_bridge", old)
    return warehouse


def test_unprocessed(spark):
    todo = jobs.unprocessed(raw(spark, [("B_r4", "r4", "B", 1, "other text", 1)]), status(spark), "v1").orderBy("Review_ID").collect()
    assert [r["Review_ID"] for r in todo] == ["r2", "r3", "r4"]
    assert todo[2]["Clean_Text"] == TEXTS["r4"]


def test_run_updates_only_what_it_processed(spark, house):
    summary = jobs.run_tagging(house, jobs.Tagger("v1")).first()
    assert (summary["reviews"], summary["success"], summary["failed"]) == (3, 3, 0)
    state = {r["Review_ID"]: (r["Model_Version"], r["Processing_Status"]) for r in house.table("review_processing").collect()}
    assert state == {k: ("v1", "SUCCESS") for k in ("r1", "r2", "r3", "r4")}
    scenes = sorted((r["Review_ID"], r["Sub_Scene"]) for r in house.table("scene_bridge").collect())
    # r1 was finished before, so its old row stays; r3 lost its old row
    assert scenes == [("r1", "old"), ("r3", "emotional_relaxing"), ("r4", "back_recovery")]
    assert [r["Review_ID"] for r in house.table("friction_bridge").collect()] == ["r2"]
    done = {r["Review_ID"] for r in house.table("review_processing").where("Processing_Status = 'SUCCESS'").collect()}
    for name in BRIDGES:
        assert {r["Review_ID"] for r in house.table(name).collect()} <= done


def test_second_run_changes_nothing(spark, house):
    jobs.run_tagging(house, jobs.Tagger("v1"))
    before = content(house)
    assert jobs.run_tagging(house, jobs.Tagger("v1")) is None
    assert content(house) == before
    jobs.run_tagging(house, jobs.Tagger("v2"))
    after = content(house)
    assert after["review_processing"] != before["review_processing"]
    assert after["motivation_bridge"] == before["motivation_bridge"]
    assert house.table("review_processing").count() == 4


def test_new_reviews_are_added_without_a_rewrite(spark, house):
    jobs.run_tagging(house, jobs.Tagger("v1"))
    before = {name: house._versions(name)[-1] for name in FEATURE_TABLES}
    house.overwrite("review_raw", raw(spark, [("A_r9", "r9", "A", 2, "Relaxing but flimsy.", 0)]))
    assert jobs.run_tagging(house, jobs.Tagger("v1")).first()["reviews"] == 1
    assert {name: house._versions(name)[-1] for name in FEATURE_TABLES} == before
    assert house.table("friction_bridge").where("Review_ID = 'r9'").first()["Friction_Sub"] == "Build_Quality"
    assert house.table("review_processing").count() == 5 and house.table("review_features").count() == 4


def test_failed_reviews_are_tried_again(spark, house):
    vectors = spark.createDataFrame([("r2", [1.0]), ("r4", [1.0, 0.0])], "Review_ID string, embedding array<float>")
    labels = {"scene": [("yoga", [1.0, 0.0]), ("nap", [0.0, 1.0])]}
    summary = jobs.run_tagging(house, jobs.Tagger("v1", centroids=labels, vectors=vectors)).first()
    assert (summary["success"], summary["failed"]) == (2, 1)
    failed = house.table("review_processing").where("Processing_Status = 'FAILED'").collect()
    assert [(r["Review_ID"], bool(r["Error_Message"])) for r in failed] == [("r2", True)]
    assert house.table("review_features").where("Review_ID = 'r2'").first()["Keywords"] == ""
    jobs.run_tagging(house, jobs.Tagger("v1"))
    assert house.table("review_processing").where("Processing_Status = 'FAILED'").count() == 0


def test_partitions_do_not_matter(spark, warehouse):
    """One id with a third of all rows; one partition or many give the same tables."""
    many = [(f"{a}_", "", f"{a}", 3, f"relaxing {a:03d}", a) for a in range(100)]
    results = []
    for parts in (1, 8):
        warehouse.create_feature_tables()
        warehouse.overwrite("review_raw", raw(spark, many).repartition(parts))
        jobs.run_tagging(warehouse, jobs.Tagger("v1"))
        results.append(content(warehouse))
    assert results[0] == results[1]
    assert sum("Review_ID=''" in r for r in results[0]["review_processing"]) == 1


def test_large_backlog_path(spark, house, monkeypatch):
    jobs.run_tagging(house, jobs.Tagger("v1"))
    broadcasted = content(house)
    house.create_feature_tables()
    house.overwrite("review_processing", status(spark), FEATURE_TABLES["review_processing"])
    monkeypatch.setattr(jobs, "BROADCAST_ROWS", 0)
    jobs.run_tagging(house, jobs.Tagger("v1"))
    shuffled = content(house)
    del broadcasted["scene_bridge"], shuffled["scene_bridge"]
    assert shuffled == broadcasted


def test_dimensions(spark, house):
    jobs.run_tagging(house, jobs.Tagger("v1"))
    house.overwrite("review_raw", raw(spark, [("B_r1", "r1", "B", 5, "x", 9), ("A_r1", "r1", "A", 3, TEXTS["r1"], 1)]))
    jobs.rebuild_dimensions(house)
    review = {r["Review_ID"]: r for r in house.table("dim_review").collect()}
    assert len(review) == 5 and review["r1"]["Rating"] == 3 and review["r1"]["Helpful"] == 1
    assert review["r5"]["Clean_Text"] is None and review["r5"]["Keywords"] is None and review["r2"]["Keywords"]
    assert house.table("dim_asinreview").count() == 6


def test_product_dimension(spark):
    listing = spark.createDataFrame([("a", "z", 2.0, "g"), ("a", "b", 9.0, "a"), ("b", "b", 1.0, "a"), (None, "n", 1.0, "a")], "asin string, brand string, price double, price_band string")
    models = spark.createDataFrame([("a", "M1"), ("a", "M2")], "asin string, model string")
    links = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "asin string")
    got = sorted(tuple(r) for r in dims.dim_product(listing, models, links).collect())
    assert got == [("a", "b", 9.0, "a", "M1"), ("a", "b", 9.0, "a", "M2")]


def test_etl_overwrites_or_appends(spark, warehouse, folder):
    Path(folder, "B1-x.csv").write_text(f"Title,Content,URL,Rating\nt,c,{URL.format('R1')},5\n")
    jobs.run_etl(spark, warehouse, folder)
    jobs.run_etl(spark, warehouse, folder)
    assert warehouse.table("review_raw").count() == 1
    jobs.run_etl(spark, warehouse, folder, append=True)
    assert warehouse.table("review_raw").count() == 2
    empty = Path(folder, "empty")
    empty.mkdir()
    jobs.run_etl(spark, warehouse, str(empty))
    assert warehouse.table("review_raw").count() == 2


def test_stream_picks_up_new_files_once(spark, warehouse, folder):
    def land(name, rid, text):
        Path(folder, "in").mkdir(exist_ok=True)
        Path(folder, "in", name).write_text(json.dumps({"Title": "t", "Content": text, "URL": URL.format(rid), "Rating": 3}) + "\n")

    def run():
        ingest(spark, warehouse, f"{folder}/in", f"{folder}/state", jobs.Tagger("v1")).awaitTermination()
        return sorted((r["Review_ID"], r["Sub_Scene"]) for r in warehouse.table("scene_bridge").collect())

    land("A-1.json", "R1", "relaxing")
    assert run() == [("R1", "emotional_relaxing")]
    land("A-2.json", "R2", "cozy")
    land("B-1.json", "R1", "relaxing")
    assert run() == [("R1", "emotional_relaxing"), ("R2", "emotional_cozy")]
    assert run() == [("R1", "emotional_relaxing"), ("R2", "emotional_cozy")]
    assert warehouse.table("review_raw").count() == 3
    # the same files under a lost stream state are not added again
    ingest(spark, warehouse, f"{folder}/in", f"{folder}/state2", jobs.Tagger("v1")).awaitTermination()
    assert warehouse.table("review_raw").count() == 3


def test_hashed_vectors_need_no_model(spark):
    df = spark.createDataFrame([("a", "blue mask"), ("b", "mask, blue!"), ("c", "")], "k string, t string")
    got = {r["k"]: r["embedding"] for r in encode.hashed_vectors(df, "k", "t").collect()}
    assert len(got["a"]) == 384 and got["a"] == got["b"] and sum(got["a"]) == 2 and sum(got["c"]) == 0


def test_encoder_failures_stay_with_their_text(spark):
    def encoder(texts):
        if any("bad" in t for t in texts):
            raise ValueError("unreadable")
        return np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["abc", "bad", "  ", None])], "k bigint, t string").coalesce(1)
    got = {r["k"]: (r["embedding"], r["error"]) for r in encode.encoded_vectors(df, "k", "t", encoder, batch=3).collect()}
    assert got == {0: ([3.0, 1.0], None), 1: (None, "unreadable"), 2: ([1.0, 1.0], None), 3: ([1.0, 1.0], None)}


def test_seed_phrases_to_centroids(spark):
    seeds = spark.createDataFrame([("scene", "nap", 0, "short nap"), ("scene", "nap", 0, "nap"), ("scene", "yoga", 1, "yoga")], "family string, sub string, ord int, phrase string")
    got = encode.seed_centroids(seeds, lambda df: encode.hashed_vectors(df, "seed", "phrase", 16)).orderBy("ord").collect()
    assert [r["sub"] for r in got] == ["nap", "yoga"]
    assert sum(got[0]["vec"]) == 1.5 and max(got[0]["vec"]) == 1.0


def test_append_after_a_failed_overwrite(spark, warehouse):
    ddl = "k bigint, v string"
    warehouse.overwrite("things", spark.createDataFrame([(1, "a")], ddl), ddl)

    class Broken(Exception):
        pass

    real = spark.sql

    def failing(text, *args, **kwargs):
        if text.startswith("CREATE OR REPLACE VIEW"):
            raise Broken
        return real(text, *args, **kwargs)

    warehouse.spark = type("Session", (), {"sql": staticmethod(failing), "table": spark.table, "catalog": spark.catalog})
    with pytest.raises(Broken):
        warehouse.overwrite("things", spark.createDataFrame([(9, "z")], ddl), ddl)
    warehouse.spark = spark
    warehouse.append("things", spark.createDataFrame([(2, "b")], ddl))
    assert sorted(tuple(r) for r in warehouse.table("things").collect()) == [(1, "a"), (2, "b")]
    warehouse.overwrite("things", warehouse.table("things").where("k = 2"), ddl)
    assert [tuple(r) for r in warehouse.table("things").collect()] == [(2, "b")]
    assert len(warehouse._versions("things")) == 2


def test_stream_and_batch_load_alike(spark, warehouse, folder):
    landing = Path(folder, "in")
    landing.mkdir()
    full = {"Title": "t", "Content": "cozy", "URL": URL.format("R1"), "Rating": 3}
    (landing / "A-1.json").write_text("".join(json.dumps(r) + "\n" for r in (full, {**full, "URL": None, "Title": "no link"})))
    (landing / "B-1.json").write_text(json.dumps({"Content": "x", "URL": URL.format("R2")}) + "\n")
    ingest(spark, warehouse, str(landing), f"{folder}/state", jobs.Tagger("v1")).awaitTermination()
    streamed = sorted(map(str, warehouse.table("review_raw").drop("ETL_Time").collect()))
    lacking = sorted((r["Source_File"], r["missing"]) for r in rejected_files(warehouse).collect())
    rejects = jobs.run_etl(spark, warehouse, str(landing), "json")
    assert streamed == sorted(map(str, warehouse.table("review_raw").drop("ETL_Time").collect())) and len(streamed) == 2
    assert lacking == sorted((r["Source_File"], r["missing"]) for r in rejects.collect()) and len(lacking) == 1


def files_of(spark, house, name):
    rows = spark.read.parquet(*[f for f in spark.table(house._current(name)).inputFiles()]).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    return {(r[0].rsplit("/", 2)[1], r[0], r[1]) for r in rows}


def test_replacing_few_ids_leaves_other_buckets_alone(spark, warehouse):
    rows = spark.range(400).select(F.col("id").cast("string").alias("Review_ID"), F.lit("m").alias("Main_Scene"), F.lit("old").alias("Sub_Scene"))
    warehouse.overwrite("scene_bridge", rows.repartition(4), FEATURE_TABLES["scene_bridge"])
    before = files_of(spark, warehouse, "scene_bridge")
    keys = spark.createDataFrame([("7",), ("7",), ("123",), ("new",), (None,)], "Review_ID string")
    new = spark.createDataFrame([("7", "m", "a"), ("7", "m", "b"), ("new", "m", "c")], "Review_ID string, Main_Scene string, Sub_Scene string")
    touched = warehouse.replace_keys("scene_bridge", new, keys)
    assert 1 <= len(touched) <= 4
    after = files_of(spark, warehouse, "scene_bridge")
    names = {f"key_bucket={b}" for b in touched}
    assert {f for f in before if f[0] not in names} == {f for f in after if f[0] not in names}
    assert not {f[1] for f in before if f[0] in names} & {f[1] for f in after}
    table = warehouse.table("scene_bridge")
    assert table.columns == ["Review_ID", "Main_Scene", "Sub_Scene"]
    got = {(r.Review_ID, r.Sub_Scene) for r in table.collect()}
    assert got == {(str(i), "old") for i in range(400) if i not in (7, 123)} | {("7", "a"), ("7", "b"), ("new", "c")}
    assert table.count() == len(got)


def test_a_bucket_that_loses_its_last_row_is_empty(spark, warehouse):
    one = spark.createDataFrame([("a", "m", "x"), ("b", "m", "y")], "Review_ID string, Main_Scene string, Sub_Scene string")
    warehouse.overwrite("scene_bridge", one, FEATURE_TABLES["scene_bridge"])
    warehouse.replace_keys("scene_bridge", one.limit(0), one.where("Review_ID = 'a'"))
    assert [tuple(r) for r in warehouse.table("scene_bridge").collect()] == [("b", "m", "y")]
    assert warehouse.replace_keys("scene_bridge", one, one.limit(0)) == []
    # a repetition after a crash gives the same table
    for _ in range(2):
        warehouse.replace_keys("scene_bridge", one, one)
    assert warehouse.table("scene_bridge").count() == 2
