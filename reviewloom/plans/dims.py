"""Derived dimensions: reviews, product-review links, products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.keys import any_value, first_by_key, restrict


def dim_review(raw: DataFrame, features: DataFrame) -> DataFrame:
    """One row per review with its keywords. Features are unique by review, so the join adds no rows."""
    columns = {"Clean_Text": "Clean_Text", "Rating": "Rating", "Helpful": "Helpful_Votes", "Review_Date": "Review_Date"}
    return any_value(raw, "Review_ID", columns, "Review_Key").join(
        features.select("Review_ID", "Keywords"), "Review_ID", "left"
    )


def dim_asinreview(raw: DataFrame) -> DataFrame:
    return raw.select("ASIN", "Review_ID", "Review_Key").distinct()


def dim_product(listing: DataFrame, models: DataFrame, links: DataFrame) -> DataFrame:
    """Reviewed products with brand, price, band and model; a product with two models has two rows."""
    products = first_by_key(listing.select("asin", "brand", "price", "price_band"), "asin", ["brand", "price", "price_band"])
    with_model = products.join(models.select("asin", "model"), "asin", "left")
    return restrict(with_model.where(F.col("asin").isNotNull()), links, "asin")


def review_facts(reviews: DataFrame, tagged: DataFrame) -> DataFrame:
    """Dated reviews with a flag whether the tag table holds them, and the month to partition by."""
    flags = tagged.select("review_id").distinct().withColumn("tagged", F.lit(1))
    dated = reviews.where(F.col("review_date").isNotNull()).join(flags, "review_id", "left")
    return dated.withColumn("Year_Month", F.trunc("review_date", "MM"))


def write_by_month(facts: DataFrame, path: str) -> None:
    """One folder per month; a large month gets several files, a small one a single file."""
    facts.hint("rebalance", "Year_Month").write.partitionBy("Year_Month").mode("overwrite").parquet(path)


def months_on_calendar(facts: DataFrame, days: DataFrame) -> DataFrame:
    """Reviews, tagged reviews and mean rating for each month of the chosen calendar days; a month without reviews
    is a row of blanks.

    ``days`` are rows of the calendar, a few hundred a year, and travel to the facts. The join holds the month, so
    only the folders of chosen months are read.
    """
    chosen = days.select("Date", F.col("Year_Month").alias("_month"))
    on = (F.col("review_date") == F.col("Date")) & (F.col("Year_Month") == F.col("_month"))
    counted = facts.join(F.broadcast(chosen), on).groupBy("_month").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("tagged").alias("tagged_reviews"), F.avg("rating").alias("avg_rating")
    )
    months = days.select("Year_Month").distinct()
    return months.join(counted, F.col("Year_Month") == F.col("_month"), "left").drop("_month")
