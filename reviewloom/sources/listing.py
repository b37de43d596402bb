"""Marketplace listing exports to the listing fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions import scalars, text
from reviewloom.operators.lookup import first_match
from reviewloom.schemas import LISTING_COLUMNS
from reviewloom.sources.files import read_by_header

# Defaults of the three lookups and the product whose part is always the same.
NO_CATEGORY = "人类"
NO_PART = "全身"
NO_PATTERN = "其它"
FIXED_PART = ("Cervical", "肩颈部")
PERCENT_COLUMNS = ("main_rank_growth", "monthly_units_growth", "review_rate", "gross_margin")


def read_listing(spark: SparkSession, folder: str, kind: str = "csv") -> DataFrame | None:
    """All export files of a folder under our column names; the product comes from the file name."""
    rows, _ = read_by_header(spark, folder, kind, [source for source, _, _ in LISTING_COLUMNS])
    if rows is None:
        return None
    return rows.select(
        text.product_from_name(F.col("Source_File")).alias("product"),
        *[_typed(source, name, kind) for source, name, kind in LISTING_COLUMNS],
    )


def _typed(source: str, name: str, kind: str) -> Column:
    value = F.col(f"`{source}`")
    if name in PERCENT_COLUMNS:
        return scalars.percent(value).alias(name)
    if kind == "DATE":
        return scalars.parsed_date(value).alias(name)
    if kind == "BIGINT":
        return scalars.whole_number(value).alias(name)
    return value.try_cast(kind).alias(name)


def prepare_listing(raw: DataFrame, category: DataFrame, parts: DataFrame, pattern: DataFrame) -> DataFrame:
    """Rows with known units, plus title_bullets, is_infrared, cat, parts, pattern and price_band.

    The three lookups are ``load_lookup`` frames.
    """
    rows = (
        raw.withColumn("title_bullets", F.lower(text.title_bullets(F.col("title"), F.col("bullets"))))
        .where(F.col("monthly_units").isNotNull())
        .withColumn("title", F.lower("title"))
        .withColumn("is_infrared", text.light_type(F.col("title_bullets")))
    )
    rows = first_match(rows, category, "title", "product", NO_CATEGORY, "cat")
    rows = first_match(rows, parts, "title", "product", NO_PART, "parts")
    product, part = FIXED_PART
    rows = rows.withColumn("parts", F.when(F.col("product") == product, F.lit(part)).otherwise(F.col("parts")))
    rows = first_match(rows, pattern, "title", "product", NO_PATTERN, "pattern")
    return rows.withColumn("price_band", scalars.price_band(F.col("price")))
