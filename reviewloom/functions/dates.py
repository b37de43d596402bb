"""Calendar table and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_index(day: Column) -> Column:
    """Consecutive month number, so that calendar lags are plain differences."""
    return F.year(day) * 12 + F.month(day)


def end_of_month(day: Column, months: int = 0) -> Column:
    return F.last_day(F.add_months(day, months))


def window_start(day: Column, months: int) -> Column:
    """First day of a window of ``months`` calendar months that ends with the month of ``day``."""
    return F.date_add(end_of_month(day, -months), 1)


def calendar(dates: DataFrame, column: str) -> DataFrame:
    """One row per day over the whole years that ``dates.column`` spans."""
    span = dates.agg(F.min(column).cast("date").alias("lo"), F.max(column).cast("date").alias("hi"))
    days = span.select(
        F.explode(
            F.sequence(F.trunc("lo", "YEAR"), F.date_sub(F.add_months(F.trunc("hi", "YEAR"), 12), 1))
        ).alias("Date")
    )
    return with_date_parts(days)


def with_date_parts(days: DataFrame) -> DataFrame:
    day = F.col("Date")
    quarter = F.floor((F.month(day) + 2) / 3).cast("int")
    return days.select(
        "Date",
        F.year(day).alias("Year"),
        F.month(day).alias("MonthNo"),
        F.date_format(day, "MMMM").alias("Month"),
        quarter.alias("QuarterNo"),
        F.concat(F.lit("Qtr "), quarter.cast("string")).alias("Quarter"),
        F.dayofmonth(day).alias("Day"),
        month_start(day).alias("Year_Month"),
        (F.year(day) * 100 + F.month(day)).alias("MY_Order"),
    )
