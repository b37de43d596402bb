"""Review landing files to the typed raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions import scalars, text
from reviewloom.schemas import LANDING_OPTIONAL, LANDING_REQUIRED
from reviewloom.sources.files import read_by_header


def read_landing(
    spark: SparkSession, folder: str, kind: str = "csv", multiline: bool = False
) -> tuple[DataFrame | None, DataFrame]:
    """Review rows of a landing folder and the files rejected for lack of a required column."""
    return read_by_header(spark, folder, kind, (*LANDING_REQUIRED, *LANDING_OPTIONAL), LANDING_REQUIRED, multiline)


def to_review_raw(rows: DataFrame) -> DataFrame:
    """Keys, cleaned text and types. Duplicate reviews are kept."""
    keyed = rows.withColumns(
        {
            "ASIN": text.asin_from_path(F.col("Source_File")),
            "Review_ID": text.review_id(F.col("URL")),
        }
    )
    return keyed.select(
        text.review_key(F.col("ASIN"), F.col("Review_ID")).alias("Review_Key"),
        "Review_ID",
        "ASIN",
        scalars.whole_number(F.col("Rating")).alias("Rating"),
        "Title",
        "Content",
        text.clean_text(text.title_and_content(F.col("Title"), F.col("Content"))).alias("Clean_Text"),
        "URL",
        scalars.parsed_date(F.col("Date")).alias("Review_Date"),
        F.col("Verified Purchase").alias("Verified"),
        scalars.votes(F.col("Helpful")).alias("Helpful_Votes"),
        "Variant",
        F.col("Vine Voice").alias("Vine"),
        "Images",
        "Videos",
        "Source_File",
        F.current_timestamp().alias("ETL_Time"),
    )


def fractional_ratings(rows: DataFrame) -> DataFrame:
    """Rows per file whose rating is a number but not a whole one; they load with a NULL rating."""
    number = F.col("Rating").try_cast("double")
    return rows.where(number != F.floor(number)).groupBy("Source_File").agg(F.count(F.lit(1)).alias("rows"))
