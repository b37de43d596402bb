"""Ranks, running totals and exact medians over a whole table.

Spark evaluates a window without PARTITION BY in one task. Here rows are range-partitioned on the ordering, each
range is ranked or summed on its own, and the ranges are tied together by a summary of one row per range.
Medians close in on the middle rank of all groups at once. There is one body for all sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.session import broadcast_if_small, materialise

# Ranges that a group's values are cut into in one round of the median, and the distinct values that end the rounds.
MEDIAN_RANGES = 64
BRACKET_VALUES = 10_000


def _range_count(spark: SparkSession, ranges: int | None) -> int:
    """As many ranges as the session has shuffle partitions, unless told."""
    return ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))


def _ranges(df: DataFrame, order: list, ranges: int) -> DataFrame:
    """``df`` with its range number, stored so that later passes see the same ranges."""
    ranged = df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    return materialise(ranged, "ranges")


def with_ranks(df: DataFrame, value: str, rank: str = "rank", dense: str = "dense_rank", ranges: int | None = None) -> DataFrame:
    """Add rank (ties skip) and dense rank of ``value``, largest first. NULL ranks as zero."""
    ranges = _range_count(df.sparkSession, ranges)
    stored = df.withColumn("_v", F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType)))
    tie_break = [F.col(c) for c in df.columns]
    parts = _ranges(stored, [F.col("_v").desc(), *tie_break], ranges)
    per_value = parts.groupBy("_range", "_v").agg(F.count(F.lit(1)).alias("n"))
    summary = per_value.groupBy("_range").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("values"),
        F.max("_v").alias("head"),
        F.min("_v").alias("tail"),
        F.min_by("n", "_v").alias("tail_rows"),
    )
    # one row per range from here on, so a single-task window is bounded by ``ranges``
    seq = Window.orderBy("_range")
    before = seq.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumns(
        {
            "offset": F.coalesce(F.sum("rows").over(before), F.lit(0)),
            "shared": F.coalesce((F.lag("tail").over(seq) == F.col("head")).cast("bigint"), F.lit(0)),
            "values_before": F.coalesce(F.sum("values").over(before), F.lit(0)),
        }
    ).withColumn("dense_offset", F.col("values_before") - F.sum("shared").over(seq.rowsBetween(Window.unboundedPreceding, 0)))
    # a value that spans ranges starts where it first shows up, as the tail of one or the head of another
    starts = (
        summary.select(F.col("head").alias("head"), (F.col("offset") + 1).alias("at"))
        .unionByName(
            summary.select(F.col("tail").alias("head"), (F.col("offset") + F.col("rows") - F.col("tail_rows") + 1).alias("at"))
        )
        .groupBy("head")
        .agg(F.min("at").alias("head_rank"))
    )
    marks = summary.join(F.broadcast(starts), "head").select("_range", "head", "offset", "dense_offset", "head_rank")
    inside = Window.partitionBy("_range").orderBy(F.col("_v").desc())
    return (
        parts.join(F.broadcast(marks), "_range")
        .withColumns({"_r": F.rank().over(inside), "_d": F.dense_rank().over(inside)})
        .withColumns(
            {
                rank: F.when(F.col("_v") == F.col("head"), F.col("head_rank")).otherwise(F.col("offset") + F.col("_r")),
                dense: F.col("dense_offset") + F.col("_d"),
            }
        )
        .select(*df.columns, rank, dense)
    )


def with_running_total(df: DataFrame, order: list, value: str, out: str, ranges: int | None = None) -> DataFrame:
    """Add the sum of ``value`` over all rows up to this one, NULL while none has a value. ``order`` must be total."""
    parts = _ranges(df, order, _range_count(df.sparkSession, ranges))
    totals = parts.groupBy("_range").agg(F.sum(value).alias("part"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.sum("part").over(before).alias("_offset"))
    inside = F.sum(value).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return (
        parts.join(F.broadcast(offsets), "_range")  # one row per range
        .withColumn("_inside", inside)
        .withColumn(out, F.coalesce(F.col("_offset") + F.col("_inside"), "_inside", "_offset"))
        .select(*df.columns, out)
    )


def exact_median(
    df: DataFrame, by: list[str], value: str, out: str, ranges: int = MEDIAN_RANGES, weight: str | None = None, bracket: int = BRACKET_VALUES
) -> DataFrame:
    """Interpolated median per group, for values without a bounded domain (prices). ``weight`` counts each row that often.

    Rows are counted per distinct value. The middle rank of every group is then closed in by rounds: quantile edges cut
    a group's values into ``ranges``, counts per range name those that hold the middle, and only their values go on.
    When no group holds more than ``bracket`` distinct values, the middle is picked by a window inside each group. No
    value is sorted before that, and small groups need no round at all. The two middle rows may lie in two ranges, so
    that four ranges and four values are the least with which every round gets on.
    """
    if min(ranges, bracket) < 4:
        raise ValueError("ranges and bracket must be at least 4")
    keys = [f"_g{i}" for i in range(len(by))] or ["_g0"]
    given = [F.col(b).alias(k) for b, k in zip(by, keys)] or [F.lit(0).alias("_g0")]
    total = F.sum(weight) if weight else F.count(F.lit(1))
    present = df.where(F.col(value).isNotNull())
    counts = present.groupBy(*given, F.col(value).cast("double").alias("_v")).agg(total.alias("_n"))
    current = materialise(counts, "median")
    group = Window.partitionBy(*keys)
    # the ranks of the two middle rows, counted from the first row that is left
    ranks = None
    while _largest_group(current, keys) > bracket:
        if ranks is None:
            whole = current.groupBy(*keys).agg(F.sum("_n").alias("_rows"))
            ranks = whole.select(*keys, *_middle(F.col("_rows")))
        shares = [i / ranges for i in range(1, ranges)]
        edges = current.groupBy(*keys).agg(F.percentile_approx("_v", shares, 100 * ranges).alias("_edges"))
        ranged = join_null_safe(current, edges, keys).withColumn("_bin", F.size(F.filter("_edges", lambda e: e < F.col("_v"))))
        # at most ``ranges`` rows a group
        per_range = ranged.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_n"))
        per_range = per_range.withColumn("_cum", F.sum("_n").over(group.orderBy("_bin")))
        first = F.col("_cum") - F.col("_n")
        middle = join_null_safe(per_range, ranks, keys).where((first < F.col("_upper")) & (F.col("_cum") >= F.col("_lower")))
        chosen = materialise(
            middle.groupBy(*keys).agg(
                F.min("_bin").alias("_from"),
                F.max("_bin").alias("_to"),
                (F.first("_lower") - F.min(first)).alias("_lower"),
                (F.first("_upper") - F.min(first)).alias("_upper"),
            ),
            "bracket",
        )
        inside = join_null_safe(ranged, chosen.select(*keys, "_from", "_to"), keys).where(F.col("_bin").between(F.col("_from"), F.col("_to")))
        current = materialise(inside.select(*keys, "_v", "_n"), "median")
        ranks = chosen.select(*keys, "_lower", "_upper")
    if ranks is None:
        placed = current.select("*", *_middle(F.sum("_n").over(group)))
    else:
        placed = join_null_safe(current, ranks, keys)
    running = placed.withColumn("_cum", F.sum("_n").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    middle = running.where((F.col("_cum") - F.col("_n") < F.col("_upper")) & (F.col("_cum") >= F.col("_lower")))
    mean_of_two = (F.min("_v") + F.max("_v")) / 2
    if not by:
        # a global aggregate gives a row for no input as well, as the other measures do
        return middle.agg(mean_of_two.alias(out))
    return middle.groupBy(*keys).agg(mean_of_two.alias(out)).select(*[F.col(k).alias(b) for b, k in zip(by, keys)], out)


def _middle(rows: Column) -> list[Column]:
    return [F.floor((rows + 1) / 2).alias("_lower"), F.floor((rows + 2) / 2).alias("_upper")]


def _largest_group(counts: DataFrame, keys: list[str]) -> int:
    return counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def join_null_safe(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys where a missing key matches a missing key; few groups are broadcast, so that the rows of a
    large one stay where they are."""
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"r{k}")) for k in keys])
    renamed = groups.withColumnsRenamed({k: f"r{k}" for k in keys})
    return rows.join(broadcast_if_small(renamed), match).drop(*[f"r{k}" for k in keys])
