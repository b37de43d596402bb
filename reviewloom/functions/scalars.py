"""Casts, blank handling, ratios and price bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "MMMM d, yyyy", "yyyy-MM-dd HH:mm:ss")

# Exclusive upper price bounds and the band labels.
PRICE_BANDS = (
    (50, "a.$50以下"),
    (100, "b.$50-100"),
    (150, "c.$100-150"),
    (200, "d.$150-200"),
    (250, "e.$200-250"),
    (300, "f.$250-300"),
)
TOP_PRICE_BAND = "g.$300以上"


def whole_number(value: Column) -> Column:
    """Nullable integer: unparsable or fractional input gives NULL."""
    number = value.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def votes(value: Column) -> Column:
    return F.coalesce(whole_number(value), F.lit(0).cast("bigint"))


def parsed_date(value: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    return F.to_date(F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in formats]))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Blank, never an error, on a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def blank_if_zero(count: Column) -> Column:
    """A count over nothing is blank."""
    return F.nullif(count, F.lit(0).cast("bigint"))


def distinct_with_blank(col: Column) -> Column:
    """Distinct count in which a missing value is one more value."""
    return F.count_distinct(col) + F.coalesce(F.max(col.isNull().cast("bigint")), F.lit(0).cast("bigint"))


def signal(score: Column) -> Column:
    """Stored score: three digits, ties to even."""
    return F.bround(score, 3)


def percent(text: Column) -> Column:
    """'12.5%' or '0.125' as a double."""
    number = F.regexp_replace(F.trim(text), "%$", "").try_cast("double")
    return F.when(F.endswith(F.trim(text), F.lit("%")), number / 100).otherwise(number)


def price_band(price: Column) -> Column:
    band = F.when(price.isNull(), F.lit(None).cast("string"))
    for bound, label in PRICE_BANDS:
        band = band.when(price < bound, F.lit(label))
    return band.otherwise(F.lit(TOP_PRICE_BAND))


def casts(types: dict[str, str]) -> list[Column]:
    """A typed cast list over named columns; what does not parse becomes NULL."""
    return [F.col(f"`{name}`").try_cast(kind).alias(name) for name, kind in types.items()]
