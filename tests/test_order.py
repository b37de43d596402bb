import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reviewloom.operators.order import exact_median, with_ranks, with_running_total

SIX = [("b1", 100), ("b2", 90), ("b3", 90), ("b4", 80), ("b5", 70), ("b6", 60)]


@pytest.fixture(scope="module")
def brands(spark):
    """A third of all brands without revenue, many ties, some missing values."""
    rnd = random.Random(3)
    rows = [(f"b{i:05d}", rnd.choice([0, 0, 0, None, 7, 7, rnd.randint(1, 400)])) for i in range(2000)]
    return spark.createDataFrame(rows, "brand string, rev bigint")


@pytest.mark.parametrize("ranges", [1, 4, None])
def test_ranks(spark, ranges):
    df = spark.createDataFrame(SIX, "brand string, rev bigint")
    got = with_ranks(df, "rev", ranges=ranges).orderBy("brand").collect()
    assert [r["rank"] for r in got] == [1, 2, 2, 4, 5, 6]
    assert [r["dense_rank"] for r in got] == [1, 2, 2, 3, 4, 5]


@pytest.mark.parametrize("ranges", [1, 4, None])
def test_running_total(spark, ranges):
    df = spark.createDataFrame(SIX, "brand string, rev bigint")
    order = [F.col("rev").desc(), F.col("brand").asc()]
    got = with_running_total(df, order, "rev", "cum", ranges=ranges).orderBy("brand").collect()
    assert [r["cum"] for r in got] == [100, 190, 280, 360, 430, 490]


@pytest.mark.parametrize("ranges", [1, 3, None])
def test_running_total_is_blank_until_a_value_was_seen(spark, ranges):
    rows = [(i, None if i < 5 else i) for i in range(10)]
    got = with_running_total(spark.createDataFrame(rows, "k int, v bigint"), [F.col("k").asc()], "v", "cum", ranges).orderBy("k").collect()
    assert [r["cum"] for r in got] == [None] * 5 + [5, 11, 18, 26, 35]
    nothing = with_running_total(spark.createDataFrame([(1, None), (2, None)], "k int, v bigint"), [F.col("k").asc()], "v", "cum", ranges)
    assert [r["cum"] for r in nothing.collect()] == [None, None]


def test_ranges_agree_with_one_window(brands):
    value = F.coalesce("rev", F.lit(0)).desc()
    w = Window.orderBy(value)
    one = brands.withColumns({"rank": F.rank().over(w).cast("bigint"), "dense_rank": F.dense_rank().over(w).cast("bigint")})
    assert with_ranks(brands, "rev", ranges=9).orderBy("brand").collect() == one.orderBy("brand").collect()
    order = [value, F.col("brand").asc()]
    one = brands.withColumn("cum", F.sum("rev").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    assert with_running_total(brands, order, "rev", "cum", ranges=9).orderBy("brand").collect() == one.orderBy("brand").collect()


def test_medians_agree_with_sorting(brands):
    rows = brands.withColumns({"g": F.when(F.crc32("brand") % 3 > 0, F.crc32("brand") % 3), "v": (F.crc32("brand") % 997) / 7})
    plain = sorted(map(str, rows.groupBy("g").agg(F.median("v").alias("m")).collect()))
    assert sorted(map(str, exact_median(rows, ["g"], "v", "m").collect())) == plain
    assert sorted(map(str, exact_median(rows, ["g"], "v", "m", ranges=7).collect())) == plain
    whole = rows.agg(F.median("v")).first()[0]
    assert exact_median(rows, [], "v", "m").first()[0] == exact_median(rows, [], "v", "m", ranges=5).first()[0] == whole


def test_median_skips_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None)], "g string, v double")
    assert [tuple(r) for r in exact_median(df, ["g"], "v", "m").collect()] == [("a", 1.5)]


@pytest.mark.parametrize(("ranges", "bracket"), [(4, 4), (64, 50)])
def test_median_closes_in_by_rounds(spark, ranges, bracket):
    """Very unequal groups, ties at the middle, missing keys and outliers."""
    data = [("a", float(i % 700) ** 3) for i in range(4000)] + [(None, float(i)) for i in range(101)]
    data += [("b", 1.0)] * 500 + [("b", 2.0)] * 500 + [("c", 1e300), ("c", -1e300), ("c", 5.0), ("d", -0.5), ("d", None)]
    df = spark.createDataFrame(data, "g string, v double")
    plain = sorted(map(str, df.groupBy("g").agg(F.median("v").alias("m")).collect()))
    assert sorted(map(str, exact_median(df, ["g"], "v", "m", ranges=ranges, bracket=bracket).collect())) == plain
    counted = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(str, exact_median(counted, ["g"], "v", "m", ranges=ranges, weight="n", bracket=bracket).collect())) == plain
    assert exact_median(df.where("false"), [], "v", "m").collect() == [(None,)]
