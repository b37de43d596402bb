import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import dates, scalars


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("given, wanted", [("5", 5), ("5.0", 5), ("4.5", None), ("abc", None), (None, None), ("", None)])
def test_whole_number(spark, given, wanted):
    assert one(spark, scalars.whole_number, given) == wanted


@pytest.mark.parametrize("given, wanted", [("3", 3), ("x", 0), (None, 0)])
def test_votes(spark, given, wanted):
    assert one(spark, scalars.votes, given) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("2024-03-01", dt.date(2024, 3, 1)),
        ("03/01/2024", dt.date(2024, 3, 1)),
        ("March 1, 2024", dt.date(2024, 3, 1)),
        ("n/a", None),
        (None, None),
    ],
)
def test_date(spark, given, wanted):
    assert one(spark, scalars.parsed_date, given) == wanted


@pytest.mark.parametrize(
    "price, band", [(49.99, "a"), (50.0, "b"), (100.0, "c"), (150.0, "d"), (200.0, "e"), (299.99, "f"), (300.0, "g"), (None, None)]
)
def test_price_band(spark, price, band):
    got = one(spark, scalars.price_band, price, "double")
    assert got == band if band is None else got.startswith(band + ".")


def test_ratio_is_blank_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (0, 4), (2, 4)], "a bigint, b bigint")
    assert [r[0] for r in df.select(scalars.ratio(F.col("a"), F.col("b"))).collect()] == [None, None, 0.0, 0.5]


def test_distinct_counts_blank_once(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "x string")
    assert df.agg(scalars.distinct_with_blank(F.col("x"))).first()[0] == 3
    assert df.where("x is not null").agg(scalars.distinct_with_blank(F.col("x"))).first()[0] == 2


def test_signal_rounds_half_to_even(spark):
    assert one(spark, scalars.signal, 0.0625, "double") == 0.062
    assert one(spark, scalars.percent, "12.5%") == 0.125
    assert one(spark, scalars.percent, "0.2") == 0.2


def test_casts(spark):
    row = spark.createDataFrame([("7", "x", "2024-02-30")], "a string, `b c` string, d string").select(
        *scalars.casts({"a": "bigint", "b c": "double", "d": "date"})
    ).first()
    assert row == (7, None, None)


def test_month_window(spark):
    day = dt.date(2024, 3, 15)
    assert one(spark, lambda c: dates.window_start(c, 18), day, "date") == dt.date(2022, 10, 1)
    assert one(spark, dates.end_of_month, day, "date") == dt.date(2024, 3, 31)


def test_calendar_covers_whole_years(spark):
    days = spark.createDataFrame([(dt.date(2023, 5, 1),), (dt.date(2024, 2, 1),)], "d date")
    rows = dates.calendar(days, "d").orderBy("Date").collect()
    assert len(rows) == 365 + 366
    assert rows[0]["Date"] == dt.date(2023, 1, 1) and rows[-1]["Date"] == dt.date(2024, 12, 31)
    quarters = {r["MonthNo"]: r["Quarter"] for r in rows}
    assert [quarters[m] for m in (1, 3, 4, 12)] == ["Qtr 1", "Qtr 1", "Qtr 2", "Qtr 4"]
    assert rows[0]["MY_Order"] == 202301 and rows[0]["Month"] == "January"
