"""Incremental ingest: new landing files are cleaned, appended and tagged, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewloom.plans.jobs import Tagger, run_tagging
from reviewloom.schemas import LANDING_OPTIONAL, LANDING_REQUIRED, REVIEW_RAW
from reviewloom.session import materialise
from reviewloom.sources.files import missing_in_records, source_file
from reviewloom.sources.landing import to_review_raw
from reviewloom.sources.warehouse import Warehouse

LANDING_DDL = ", ".join(f"`{c}` STRING" for c in (*LANDING_REQUIRED, *LANDING_OPTIONAL))

# One row when a file's load begins and one when it has ended; missing holds what a rejected file lacks.
LANDING_FILES = "Source_File STRING, State STRING, Missing ARRAY<STRING>"


def landing_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New JSON landing files as a stream; columns are found by name, absent ones are NULL."""
    return (
        spark.readStream.schema(LANDING_DDL)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", str(files_per_batch))
        .json(folder)
        .withColumn("Source_File", source_file())
    )


def load_batch(warehouse: Warehouse, batch: DataFrame) -> None:
    """Append the rows of the batch's files, as the batch job would, each file once.

    ``landing_files`` says which files are done. A file whose load began and did not end, because the run
    died, is looked up among the loaded rows; only then are these read.
    """
    states = warehouse.table("landing_files")
    done = states.where(F.col("State") != "started").select("Source_File")
    rows = materialise(batch.join(done, "Source_File", "left_anti"), "batch")
    files = materialise(missing_in_records(rows, LANDING_REQUIRED), "files")
    if files.isEmpty():
        return
    begun = states.where(F.col("State") == "started").join(files, "Source_File", "left_semi").select("Source_File").distinct()
    good = files.where(F.size("missing") == 0).select("Source_File")
    if not begun.isEmpty():
        loaded = warehouse.table("review_raw").select("Source_File").join(begun, "Source_File", "left_semi").distinct()
        good = materialise(good.join(loaded, "Source_File", "left_anti"), "good")
    warehouse.append("landing_files", files.select("Source_File", F.lit("started").alias("State"), F.col("missing").alias("Missing")))
    warehouse.append("review_raw", to_review_raw(rows.join(good, "Source_File", "left_semi")))
    state = F.when(F.size("missing") == 0, "loaded").otherwise("rejected")
    warehouse.append("landing_files", files.select("Source_File", state.alias("State"), F.col("missing").alias("Missing")))


def rejected_files(warehouse: Warehouse) -> DataFrame:
    """(Source_File, missing) of the files that the stream did not load."""
    rejected = warehouse.table("landing_files").where(F.col("State") == "rejected")
    return rejected.select("Source_File", F.col("Missing").alias("missing")).distinct()


def ingest(
    spark: SparkSession, warehouse: Warehouse, folder: str, checkpoint: str, tagger: Tagger | None = None
) -> StreamingQuery:
    """Process what has arrived, then stop. A repeated micro-batch adds nothing twice."""
    tagger = tagger or Tagger()
    for name, ddl in (("review_raw", REVIEW_RAW), ("landing_files", LANDING_FILES)):
        if not warehouse.exists(name):
            warehouse.create_empty(name, ddl)

    def load(batch: DataFrame, _: int) -> None:
        load_batch(warehouse, batch)
        run_tagging(warehouse, tagger)

    return (
        landing_stream(spark, folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
