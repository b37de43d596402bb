"""Distinct reviews at every label level from exact bitmaps that can be stored and merged.

A bitmap covers a stretch of review numbers; a group has one row per stretch in which it has reviews. Bitmaps of two
batches, or of the groups below a subtotal, merge by OR, so a review counts once at every level however often it was
seen, and no row is copied or made distinct per level. A bitmap takes 4 KB whatever it holds, so the grouping columns
should be labels, of which there are few, and not products or months.

Review ids must be whole numbers, negative ones included. A null id is not counted; null labels are a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_bitmaps(rows: DataFrame, by: list[str], key: str = "review_id") -> DataFrame:
    """(*by, stretch, bitmap) of the distinct ids of each group."""
    known = rows.where(F.col(key).isNotNull())
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bitmap")
    return known.groupBy(*by, F.bitmap_bucket_number(key).alias("stretch")).agg(bits)


def merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """Bitmaps of what either has."""
    by = [c for c in first.columns if c != "bitmap"]
    return first.unionByName(second).groupBy(*by).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def level_counts(bitmaps: DataFrame, levels: dict[int, list[str]], out: str = "reviews") -> DataFrame:
    """(level, labels, out): distinct ids of every group of every level; labels a level does not group by are NULL."""
    by = [c for c in bitmaps.columns if c not in ("stretch", "bitmap")]
    types = {f.name: f.dataType for f in bitmaps.schema}
    copies = [
        F.struct(F.lit(n).alias("level"), *[(F.col(c) if c in level else F.lit(None).cast(types[c])).alias(c) for c in by]) for n, level in levels.items()
    ]
    offered = bitmaps.select("stretch", "bitmap", F.inline(F.array(*copies)))
    whole = offered.groupBy("level", *by, "stretch").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return whole.groupBy("level", *by).agg(F.sum(F.bitmap_count("bitmap")).alias(out))
