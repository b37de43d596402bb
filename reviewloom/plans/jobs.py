"""The two batch jobs: landing files to the raw table, and raw reviews to tag tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators import tagging
from reviewloom.operators.keys import any_value, restrict
from reviewloom.operators.taxonomy import Rule
from reviewloom.plans.dims import dim_asinreview, dim_review
from reviewloom.schemas import REVIEW_RAW
from reviewloom.session import BROADCAST_ROWS, has_at_most, materialise
from reviewloom.sources.landing import read_landing, to_review_raw
from reviewloom.sources.warehouse import Warehouse

MODEL_VERSION = "rules-1"


@dataclass(frozen=True)
class Tagger:
    """What a tagging run needs besides the reviews. ``vectors`` holds (Review_ID, embedding)."""

    version: str = MODEL_VERSION
    rules: list[Rule] | None = None
    centroids: dict[str, list[tuple[str, list]]] | None = None
    vectors: DataFrame | None = None
    forms: dict[str, str] | None = None
    withdrawals: dict[str, str] | None = None


def finished(status: DataFrame, version: str) -> DataFrame:
    """Ids that a run of ``version`` skips. Failed reviews are tried again."""
    done = (F.col("Processing_Status") == "SUCCESS") & (F.col("Model_Version") == version)
    return status.where(done).select("Review_ID")


def unprocessed(raw: DataFrame, status: DataFrame, version: str) -> DataFrame:
    """One row per review that has text and is not finished.

    Copies of a review are merged before the anti join, so both steps share one shuffle by id and an id
    with very many copies travels as one row per map task.
    """
    reviews = any_value(
        raw.where(F.col("Clean_Text").isNotNull()),
        "Review_ID",
        {"Clean_Text": "Clean_Text", "Rating": "Rating"},
        "Review_Key",
    )
    return reviews.join(finished(status, version), "Review_ID", "left_anti")


def run_etl(
    spark: SparkSession, warehouse: Warehouse, folder: str, kind: str = "csv", append: bool = False, multiline: bool = True
) -> DataFrame:
    """Load the landing folder into ``review_raw``; returns the rejected files. No files, no change.

    CSV texts may hold line breaks; ``multiline=False`` is for files known to have none, which can then be split.
    """
    rows, rejects = read_landing(spark, folder, kind, multiline)
    if rows is not None:
        raw = to_review_raw(rows)
        if append and warehouse.exists("review_raw"):
            warehouse.append("review_raw", raw)
        else:
            warehouse.overwrite("review_raw", raw, REVIEW_RAW)
    return rejects


def run_tagging(warehouse: Warehouse, tagger: Tagger) -> DataFrame | None:
    """Tag what is unprocessed and update the feature tables; returns the run summary.

    Tag tables are replaced first and the status last, so a run that dies half-way is simply repeated.
    """
    raw = warehouse.table("review_raw")
    status = warehouse.table("review_processing")
    with_text = raw.where(F.col("Clean_Text").isNotNull())
    # narrow pass first: when little is new, the texts of old reviews are never shuffled
    todo = materialise(
        with_text.select("Review_ID").distinct().join(finished(status, tagger.version), "Review_ID", "left_anti"), "todo"
    )
    if todo.isEmpty():
        return None
    if has_at_most(todo, BROADCAST_ROWS):
        with_text = with_text.join(F.broadcast(todo), "Review_ID", "left_semi")
    batch = any_value(with_text, "Review_ID", {"Clean_Text": "Clean_Text", "Rating": "Rating"}, "Review_Key").join(
        todo, "Review_ID", "left_semi"
    )
    vector = None
    if tagger.vectors is not None:
        vector = "embedding"
        batch = batch.join(tagger.vectors.select("Review_ID", vector), "Review_ID", "left")
    tagged = materialise(
        tagging.tag_reviews(batch, tagger.rules, tagger.centroids, vector=vector, forms=tagger.forms, withdrawals=tagger.withdrawals), "tagged"
    )
    tables = dict(tagging.bridges(tagged))
    tables["review_features"] = tagged.select("Review_ID", F.col("keywords").alias("Keywords"))
    # the tables do not depend on each other, so their writes share the cluster
    with ThreadPoolExecutor(len(tables)) as writers:
        list(writers.map(lambda name: replace_rows(warehouse, name, tables[name], todo), tables))
    replace_rows(warehouse, "review_processing", status_rows(tagged, tagger.version), todo)
    return tagging.run_summary(tagged)


def replace_rows(warehouse: Warehouse, name: str, rows: DataFrame, processed: DataFrame) -> None:
    """Give the processed reviews their new rows in a feature table.

    New reviews have no old rows, so theirs are added without touching the table; that is found by
    looking at the ids alone. Only when old rows exist are the buckets of the processed ids rewritten.
    """
    target = warehouse.table(name)
    if restrict(target.select("Review_ID"), processed, "Review_ID").isEmpty():
        warehouse.append(name, rows)
    else:
        warehouse.replace_keys(name, rows, processed)


def status_rows(tagged: DataFrame, version: str) -> DataFrame:
    return tagged.select(
        "Review_ID",
        F.lit(version).alias("Model_Version"),
        F.current_timestamp().alias("Processed_Time"),
        F.col("status").alias("Processing_Status"),
        F.col("error").alias("Error_Message"),
    )


def rebuild_dimensions(warehouse: Warehouse) -> None:
    raw = warehouse.table("review_raw")
    warehouse.overwrite("dim_review", dim_review(raw, warehouse.table("review_features")))
    warehouse.overwrite("dim_asinreview", dim_asinreview(raw))
