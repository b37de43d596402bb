"""Operators on keyed tables: one row per key, distinct links, upsert, replace by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this part of the table is handled on its own.
HOT_SHARE = 1 / 200


def any_value(rows: DataFrame, key: str, columns: dict[str, str], order: str) -> DataFrame:
    """One row per key; each output column takes its first non-null value in (order, value) order.

    The choice is repeatable across runs. Rows of one key are combined before the shuffle, so a key
    that holds a large part of the table reaches its reducer as one row per map task.
    """
    picks = [
        F.min(F.when(F.col(source).isNotNull(), F.struct(F.col(order), F.col(source))))
        .getField(source)
        .alias(name)
        for name, source in columns.items()
    ]
    return rows.groupBy(key).agg(*picks)


def first_by_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Distinct by key, keeping the row that sorts first by ``order`` and then by all other columns."""
    rest = [c for c in rows.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return rows.groupBy(key).agg(first).select(key, *[F.col("first")[c].alias(c) for c in rows.columns if c != key])


def upsert(target: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Rows of ``delta`` replace the target row of the same key or are added. ``delta`` is unique by key."""
    kept = target.join(delta.select(key), key, "left_anti")
    return kept.unionByName(delta.select(target.columns))


def replace_by_key(target: DataFrame, rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Drop every target row of the processed keys, then add the new rows."""
    kept = target.join(keys.select(key).distinct(), key, "left_anti")
    return kept.unionByName(rows.select(target.columns))


def restrict(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Keep the rows whose key is in the id set.

    Ids are made distinct first: that merges copies of a frequent id before the shuffle, and the join
    then uses the same partitioning.
    """
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def intersect_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Set intersection of two id columns."""
    return restrict(left.select(key).distinct(), right, key)


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of all rows; there can be no more than 1/share of them."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return [r[0] for r in counts.where(F.col("n") > total * share).select(key).collect()]


def join_split(many: DataFrame, unique: DataFrame, key: str, hot: list) -> DataFrame:
    """Inner join of a table with repeated keys to one that is (nearly) unique by key.

    Rows of the given hot keys meet a broadcast of their few counterparts where they are, all other rows
    are joined as usual. The tests on literal keys reach the scans of both sides.
    """
    if not hot:
        return many.join(unique, key)
    is_hot = F.col(key).isin(hot)
    rest = many.where(~is_hot).join(unique.where(~is_hot), key)
    return rest.unionByName(many.where(is_hot).join(F.broadcast(unique.where(is_hot)), key))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, nulls. One pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.lit(kind).alias("type"), F.col(f"n{i}").alias("nulls"))
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return counts.select("rows", F.inline(lines)).select("column", "type", "rows", "nulls")


def load_profile(df: DataFrame, sample: int = 3, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """What a load reports: types, rows and nulls per column, and the first rows by ``order`` (by all columns, unless told)."""
    return null_profile(df), df.orderBy(*(order or df.columns)).limit(sample)
