"""Review, bridge, listing and raw tables derived from the provided order and document tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewloom.functions.scalars import price_band
from reviewloom.plans.model import ReviewModel
from reviewloom.session import materialise, spread


_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A provided table; its schema is looked up once."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def read_spread(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A provided table in front of work on its texts."""
    return spread(read(spark, folder, name), key)


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"),
        F.pmod(F.floor("o_totalprice").cast("bigint"), F.lit(50)).alias("helpful"),
        F.to_date("o_orderdate").alias("review_date"),
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem")


def scene(spark: SparkSession, folder: str) -> DataFrame:
    part = read(spark, folder, "part").select("p_partkey", F.col("p_type").alias("main"), F.col("p_brand").alias("sub"))
    lines = _lines(spark, folder).select(F.col("l_orderkey").alias("review_id"), F.col("l_partkey").alias("p_partkey"))
    return lines.join(part, "p_partkey").select("review_id", "main", "sub").distinct()


def friction(spark: SparkSession, folder: str) -> DataFrame:
    returned = _lines(spark, folder).where(F.col("l_returnflag") == "R")
    return returned.select(
        F.col("l_orderkey").alias("review_id"),
        F.col("l_linestatus").alias("main"),
        F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("sub"),
    ).distinct()


def places(spark: SparkSession, folder: str) -> DataFrame:
    """(supplier, region, nation)."""
    return (
        read(spark, folder, "supplier")
        .join(read(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), "r_name", "n_name")
    )


def _by_supplier(spark: SparkSession, folder: str, condition: Column, **columns: str) -> DataFrame:
    lines = _lines(spark, folder).where(condition).select("l_orderkey", "l_suppkey")
    named = [F.col(source).alias(name) for name, source in columns.items()]
    return lines.join(places(spark, folder), "l_suppkey").select(F.col("l_orderkey").alias("review_id"), *named).distinct()


def motivation(spark: SparkSession, folder: str) -> DataFrame:
    return _by_supplier(spark, folder, F.col("l_discount") >= 0.05, main="r_name", sub="n_name")


def time_of_day(spark: SparkSession, folder: str) -> DataFrame:
    taxed = _lines(spark, folder).where(F.col("l_tax") >= 0.04)
    return taxed.select(
        F.col("l_orderkey").alias("review_id"),
        F.concat(F.lit("Q"), F.quarter("l_shipdate").cast("string")).alias("label"),
    ).distinct()


def location(spark: SparkSession, folder: str) -> DataFrame:
    return _by_supplier(spark, folder, F.col("l_quantity") >= 25, label="r_name")


def product_review(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    return lines.select(F.col("l_partkey").alias("asin"), F.col("l_orderkey").alias("review_id")).distinct()


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part; ages count from the start of 2002 and are unknown for every 11th part."""
    # line figures are summed per part before the join
    sold = (
        _lines(spark, folder)
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("monthly_units"),
            F.floor(F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))).cast("bigint").alias("monthly_revenue"),
            F.to_date(F.min("l_shipdate")).alias("listing_date"),
            F.count(F.lit(1)).alias("rating_count"),
        )
    )
    region = read(spark, folder, "region").select(F.col("r_regionkey").cast("bigint"), F.col("r_name").alias("seller_region"))
    rows = read(spark, folder, "part").join(sold, "p_partkey").join(
        region, F.pmod(F.col("p_partkey"), F.lit(5)) == F.col("r_regionkey")
    )
    price = F.round((F.col("p_retailprice") - 900) * 4, 2)
    return rows.select(
        F.col("p_partkey").alias("asin"),
        F.col("p_brand").alias("brand"),
        F.concat("p_brand", F.lit("-"), F.pmod("p_size", F.lit(7)).cast("string")).alias("parent_asin"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("pattern"),
        F.element_at(F.split("p_name", " "), -1).alias("parts"),
        F.element_at(F.split("p_name", " "), 1).alias("product"),
        "seller_region",
        price.alias("price"),
        price_band(price).alias("price_band"),
        (F.lit(1.0) + F.pmod("p_size", F.lit(9)) * 0.5).alias("rating"),
        "monthly_units",
        "monthly_revenue",
        "listing_date",
        F.when(F.pmod("p_partkey", F.lit(11)) != 0, F.datediff(F.lit("2002-01-01").cast("date"), "listing_date").cast("bigint")).alias("days_listed"),
        "rating_count",
    )


def product(spark: SparkSession, folder: str) -> DataFrame:
    price = F.round((F.col("p_retailprice") - 900) * 4, 2)
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("asin"),
        F.col("p_brand").alias("brand"),
        price.alias("price"),
        price_band(price).alias("price_band"),
        F.col("p_type").alias("model"),
    )


def linked_model(spark: SparkSession, folder: str) -> ReviewModel:
    """The model for queries by product: their several passes read a stored link table."""
    return replace(model(spark, folder), product_review=materialise(product_review(spark, folder), "links"))


def model(spark: SparkSession, folder: str) -> ReviewModel:
    return ReviewModel(
        reviews=reviews(spark, folder),
        scene=scene(spark, folder),
        friction=friction(spark, folder),
        motivation=motivation(spark, folder),
        time=time_of_day(spark, folder),
        location=location(spark, folder),
        product_review=product_review(spark, folder),
        product=product(spark, folder),
    )


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as raw reviews: three copies per review id, every sixth rating missing."""
    stars = F.pmod("n_chars", F.lit(6))
    return read_spread(spark, folder, "documents", "doc_id").select(
        F.concat("source", F.lit("_"), F.col("doc_id").cast("string")).alias("Review_Key"),
        (F.col("doc_id") - F.pmod("doc_id", F.lit(3))).alias("Review_ID"),
        F.col("source").alias("ASIN"),
        F.when(stars > 0, stars).alias("Rating"),
        F.col("text").alias("Clean_Text"),
        F.pmod("n_chars", F.lit(40)).alias("Helpful_Votes"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("n_chars", F.lit(700)).cast("int")).alias("Review_Date"),
    )


def status(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "labels").select(
        F.col("doc_id").alias("Review_ID"),
        F.when(F.col("toxic") == 0, F.lit("v1")).otherwise(F.lit("v0")).alias("Model_Version"),
        F.when(F.col("quality") == 1, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("Processing_Status"),
    )
