"""Named listing measures: units, revenue, brand ranking, Pareto, price bands."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.scalars import blank_if_zero, distinct_with_blank, ratio
from reviewloom.operators.order import exact_median, with_ranks, with_running_total
from reviewloom.session import materialise

# A brand is a top brand by dense rank or by its place among all brands.
TOP_RANK = 5
TOP_PART = 0.05
# Fixed value: earlier listing dates are taken for errors.
FIRST_VALID_LISTING = "2000-01-01"


@dataclass(frozen=True)
class Market:
    """Listing rows and the user's filters, by column, so that a measure can set some of them aside."""

    listing: DataFrame
    filters: dict[str, Column] = field(default_factory=dict)

    def rows(self, ignore: tuple[str, ...] = ()) -> DataFrame:
        out = self.listing
        for column, condition in self.filters.items():
            if column not in ignore:
                out = out.where(condition)
        return out


# Measures built from one value per (group, brand, parent product): a parent's variants repeat its figures.
PER_PARENT = {
    "monthly_units": ("monthly_units", F.max, F.sum),
    "monthly_revenue": ("monthly_revenue", F.max, F.sum),
    "rating_count": ("rating_count", F.max, F.sum),
}
# Plain averages travel through the same two steps as sum and count.
AVERAGES = {"avg_price": "price", "avg_listing_rating": "rating"}
RATIOS = {"avg_revenue_per_brand": ("monthly_revenue", "brand_count")}
MEDIANS = {"median_price": "price", "median_listing_rating": "rating"}
# Shares: (measure, columns left out of the group, filters set aside).
SHARES = {
    "unit_share_all_brands": ("monthly_units", "brand"),
    "revenue_share_all_brands": ("monthly_revenue", "brand"),
}
TOTAL_SHARES = {
    "brand_market_share": "monthly_revenue",
    "band_revenue_share": "monthly_revenue",
    "band_unit_share": "monthly_units",
}
BRAND_MEASURES = (
    "revenue_rank",
    "is_top_brand_units",
    "is_top_brand_revenue",
    "is_top10_brand",
    "cumulative_revenue",
    "pareto_share",
)
TOP_BRAND_TOTALS = ("top_brand_count", "top_brand_unit_share", "top_brand_revenue_share")


def _keys(by: list[str]) -> tuple[list[Column], list[str]]:
    names = [f"_g{i}" for i in range(len(by))]
    return [F.col(c).alias(k) for c, k in zip(by, names)], names


def _join_on(out: DataFrame, other: DataFrame, by: list[str]) -> DataFrame:
    """Left join of group results; a missing key matches a missing key."""
    keys = {c: f"_{c}" for c in by}
    same = F.lit(True)
    for column, key in keys.items():
        same = same & F.col(column).eqNullSafe(F.col(key))
    return out.join(other.withColumnsRenamed(keys), same, "left").drop(*keys.values())


def two_level(rows: DataFrame, by: list[str], weight: str | None = None) -> DataFrame:
    """All two-step measures, averages and the brand count in one pass: a shuffle by (group, brand, parent),
    then one by group. Columns that the caller does not select are not computed. ``weight`` is the number of
    listings that a row stands for."""
    group, keys = _keys(by)
    times = F.col(weight) if weight else F.lit(1)
    inner = rows.groupBy(*group, F.col("brand").alias("_brand"), F.col("parent_asin").alias("_parent")).agg(
        *[each(F.col(source)).alias(name) for name, (source, each, _) in PER_PARENT.items()],
        *[F.sum(F.col(c) * times).alias(f"_sum_{c}") for c in AVERAGES.values()],
        *[F.sum(F.when(F.col(c).isNotNull(), times).otherwise(0)).alias(f"_n_{c}") for c in AVERAGES.values()],
        F.min("listing_date").alias("_listed"),
    )
    # median over parents of the first listing date: days are a small domain, half days round down
    listed = F.when(F.col("_listed") > F.lit(FIRST_VALID_LISTING).cast("date"), F.unix_date("_listed"))
    outer = inner.groupBy(*keys).agg(
        *[total(F.col(name)).alias(name) for name, (_, _, total) in PER_PARENT.items()],
        *[ratio(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}")).alias(name) for name, c in AVERAGES.items()],
        blank_if_zero(distinct_with_blank(F.col("_brand"))).alias("brand_count"),
        F.date_from_unix_date(F.floor(F.median(listed)).cast("int")).alias("median_listing_date"),
    )
    return outer.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], *[c for c in outer.columns if c not in keys])


def median_days_listed(market: Market, by: list[str]) -> DataFrame:
    """Median over parents of the greatest age in days, whatever the light type and product filters."""
    by = [c for c in by if c not in ("is_infrared", "product")]
    group, keys = _keys(by)
    rows = market.rows(ignore=("is_infrared", "product")).where(F.col("days_listed").isNotNull())
    oldest = rows.groupBy(*group, "brand", "parent_asin").agg(F.ceil(F.max("days_listed")).alias("_d"))
    out = oldest.groupBy(*keys).agg(F.median("_d").alias("median_days_listed"))
    return out.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "median_days_listed")


def small_median(rows: DataFrame, by: list[str], value: str, out: str, weight: str | None = None) -> DataFrame:
    """Exact median of a value with few distinct values (star ratings), counted per value first."""
    group, keys = _keys(by)
    total = F.sum(weight) if weight else F.count(F.lit(1))
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("_v")).agg(total.alias("_n"))
    result = counts.groupBy(*keys).agg(F.percentile("_v", F.lit(0.5), F.col("_n")).alias(out))
    return result.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], out)


def brand_table(market: Market) -> DataFrame:
    """One row per brand under the user's filters: totals, ranks, top flags, running revenue."""
    totals = two_level(market.rows(), ["brand"]).select("brand", "monthly_units", "monthly_revenue")
    brands = materialise(totals, "brands")
    by_units = with_ranks(brands, "monthly_units", "_unit_rank", "_unit_place")
    ranked = with_ranks(by_units, "monthly_revenue", "revenue_rank", "_revenue_place")
    counted = brands.agg(F.count(F.lit(1)).alias("n"), F.sum("monthly_revenue").alias("revenue"))
    brands_in_all = counted.select("n").scalar()

    def top(place: str, value: str) -> Column:
        near = (F.col(place) <= TOP_RANK) | (F.col(place) <= brands_in_all * TOP_PART)
        return F.coalesce((F.col(value) > 0) & near, F.lit(False)).cast("int")

    flagged = ranked.select(
        "brand",
        "monthly_units",
        "monthly_revenue",
        "revenue_rank",
        top("_unit_place", "monthly_units").alias("is_top_brand_units"),
        top("_revenue_place", "monthly_revenue").alias("is_top_brand_revenue"),
        (F.col("revenue_rank") <= 10).alias("is_top10_brand"),
    )
    order = [F.coalesce("monthly_revenue", F.lit(0)).desc(), F.col("brand").asc_nulls_first()]
    running = with_running_total(flagged, order, "monthly_revenue", "cumulative_revenue")
    # the brand is part of the inner key, so brand totals add up to the total of the selection
    total = counted.select("revenue").scalar()
    return running.withColumn("pareto_share", ratio(F.col("cumulative_revenue"), total))


def top_brand_totals(brands: DataFrame) -> DataFrame:
    """Top brand count and the share of top brands in units and in revenue."""

    def share(flag: str, value: str) -> Column:
        return ratio(F.sum(F.when(F.col(flag) == 1, F.col(value))), F.sum(value))

    return brands.agg(
        F.sum("is_top_brand_units").alias("top_brand_count"),
        share("is_top_brand_units", "monthly_units").alias("top_brand_unit_share"),
        share("is_top_brand_revenue", "monthly_revenue").alias("top_brand_revenue_share"),
    )


def rank_within(totals: DataFrame, outer: list[str], rank: str) -> DataFrame:
    """Revenue rank of brands (or parts) inside each group of the outer columns; a group holds finished
    totals, one row per member."""
    place = Window.partitionBy(*outer).orderBy(F.coalesce("monthly_revenue", F.lit(0)).desc())
    return totals.withColumn(rank, F.rank().over(place).cast("bigint"))


def top3_in_scope(market: Market, column: str, inner: str | None = None) -> DataFrame:
    """Revenue rank of the members in scope and whether it is 3 or better.

    One row per member of ``column``; with ``inner`` also one per pair, ranked inside its outer member.
    """
    totals = two_level(market.rows(), [column]).select(column, "monthly_revenue")
    ranked = with_ranks(totals, "monthly_revenue", "revenue_rank").drop("dense_rank")
    if inner:
        pairs = two_level(market.rows(), [column, inner]).select(column, inner, "monthly_revenue")
        ranked = ranked.unionByName(rank_within(pairs, [column], "revenue_rank"), allowMissingColumns=True)
        ranked = ranked.select(column, inner, "monthly_revenue", "revenue_rank")
    return ranked.withColumn("is_top3_in_scope", F.col("revenue_rank") <= 3)


def evaluate_market(market: Market, names: list[str], by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The named listing measures, one row per group of ``by``."""
    by = list(by)
    out = two_level(market.rows(), by)
    if "median_days_listed" in names:
        out = _attach(out, median_days_listed(market, by), [c for c in by if c not in ("is_infrared", "product")])
    if "median_price" in names:
        out = _attach(out, exact_median(market.rows(), by, "price", "median_price"), by)
    if "median_listing_rating" in names:
        out = _attach(out, small_median(market.rows(), by, "rating", "median_listing_rating"), by)
    for name, (measure, dropped) in SHARES.items():
        if name in names:
            wider = [c for c in by if c != dropped]
            base = two_level(market.rows(ignore=(dropped,)), wider).select(*wider, F.col(measure).alias("_all"))
            out = _attach(out, base, wider).withColumn(name, ratio(F.col(measure), F.col("_all"))).drop("_all")
    for name, measure in TOTAL_SHARES.items():
        if name in names:
            # the total is computed on its own: a parent in two price bands counts once in it
            total = two_level(market.rows(), []).select(measure).scalar()
            out = out.withColumn(name, ratio(F.col(measure), total))
    for name, (top, bottom) in RATIOS.items():
        if name in names:
            out = out.withColumn(name, ratio(F.col(top), F.col(bottom)))
    if "revenue_rank" in names and by != ["brand"]:
        # a rank needs one brand in scope: inside the other columns, or blank where there is no brand
        if "brand" in by:
            out = rank_within(out, [c for c in by if c != "brand"], "revenue_rank")
        else:
            out = out.withColumn("revenue_rank", F.lit(None).cast("bigint"))
    elif set(names) & set(BRAND_MEASURES):
        if by != ["brand"]:
            raise ValueError("top flags and running totals are defined per brand")
        extra = brand_table(market).select("brand", *[n for n in names if n in BRAND_MEASURES])
        out = _attach(out, extra, by)
    if set(names) & set(TOP_BRAND_TOTALS):
        if by:
            raise ValueError("top brand totals are defined for the whole selection")
        out = _attach(out, top_brand_totals(brand_table(market)), by)
    return out.select(*by, *names)


# Measures whose levels all come from one table of merged listings.
LEVEL_MEASURES = {*PER_PARENT, *AVERAGES, *MEDIANS, *RATIOS, *TOTAL_SHARES, "brand_count", "median_listing_date", "revenue_rank"}


def evaluate_market_levels(market: Market, names: list[str], levels: list[list[str]]) -> DataFrame:
    """Listing measures with subtotals: ``level`` is the place in ``levels``, columns outside a level are NULL.

    Listings are read once and merged to one row per (all columns, brand, parent, price, rating). Greatest values,
    sums and counts of coarser levels follow from it, so every level is a regrouping of that stored table.
    """
    columns = list(dict.fromkeys(c for level in levels for c in level))
    if not set(names) <= LEVEL_MEASURES:
        out = None
        for i, level in enumerate(levels):
            part = evaluate_market(market, names, level).withColumn("level", F.lit(i))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out.select("level", *columns, *names)
    rows = market.rows()
    kept = list(dict.fromkeys([*columns, "brand", "parent_asin", *(MEDIANS[m] for m in MEDIANS if m in names), *(AVERAGES[a] for a in AVERAGES if a in names)]))
    # only what the measures need is read; the rest are typed NULLs
    absent = [c for c in AVERAGES.values() if c not in kept]
    dated = [F.min("listing_date").alias("listing_date")] if "median_listing_date" in names else [F.lit(None).cast("date").alias("listing_date")]
    needed = {*names, *TOTAL_SHARES.values(), *(top for top, _ in RATIOS.values())}
    figures = [each(F.col(source)).alias(source) if name in needed else F.lit(None).cast("bigint").alias(source) for name, (source, each, _) in PER_PARENT.items()]
    merged = rows.groupBy(*kept).agg(*figures, *dated, F.count(F.lit(1)).alias("_n"))
    base = materialise(merged.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else merged, "listings")

    labels = {c: f"_l{i}" for i, c in enumerate(columns)}
    types = {c: base.schema[c].dataType for c in columns}
    each_level = [
        F.struct(F.lit(i).alias("_level"), *[(F.col(c) if c in level else F.lit(None).cast(types[c])).alias(labels[c]) for c in columns])
        for i, level in enumerate(levels)
    ]
    spread = base.select("*", F.inline(F.array(*each_level)))
    by = ["_level", *labels.values()]
    out = two_level(spread, by, "_n")
    if "median_price" in names:
        out = _join_on(out, exact_median(spread, by, "price", "median_price", weight="_n"), by)
    if "median_listing_rating" in names:
        out = _join_on(out, small_median(spread, by, "rating", "median_listing_rating", "_n"), by)
    shares = {name: measure for name, measure in TOTAL_SHARES.items() if name in names}
    if shares:
        # a parent in two groups counts once in the total
        total = two_level(base, [], "_n").select(*set(shares.values())).first()
        out = out.withColumns({name: ratio(F.col(measure), F.lit(total[measure])) for name, measure in shares.items()})
    for name, (top, bottom) in RATIOS.items():
        if name in names:
            out = out.withColumn(name, ratio(F.col(top), F.col(bottom)))
    if "revenue_rank" in names:
        out = _level_ranks(materialise(out, "levels"), levels, labels)
    return out.select(F.col("_level").alias("level"), *[F.col(k).alias(c) for c, k in labels.items()], *names)


def _level_ranks(out: DataFrame, levels: list[list[str]], labels: dict[str, str]) -> DataFrame:
    """Revenue ranks of brands inside the other columns of their level; blank in a level without brands."""
    ranked = None
    for i, level in enumerate(levels):
        part = out.where(F.col("_level") == i)
        if level == ["brand"]:
            part = with_ranks(part, "monthly_revenue", "revenue_rank").drop("dense_rank")
        elif "brand" in level:
            part = rank_within(part, [labels[c] for c in level if c != "brand"], "revenue_rank")
        else:
            part = part.withColumn("revenue_rank", F.lit(None).cast("bigint"))
        ranked = part if ranked is None else ranked.unionByName(part)
    return ranked


def _attach(out: DataFrame, other: DataFrame, by: list[str]) -> DataFrame:
    if by:
        return _join_on(out, other, by)
    return out.withColumns({c: other.select(c).scalar() for c in other.columns})


def top_groups(groups: DataFrame, measure: str, n: int, *tie: str) -> DataFrame:
    """The first ``n`` groups by a measure; rows are taken per task before they meet."""
    return groups.orderBy(F.col(measure).desc(), *tie).limit(n)


MARKET_MEASURES = (
    *PER_PARENT,
    *AVERAGES,
    *MEDIANS,
    *RATIOS,
    *SHARES,
    *TOTAL_SHARES,
    *BRAND_MEASURES,
    *TOP_BRAND_TOTALS,
    "brand_count",
    "median_listing_date",
    "median_days_listed",
    "is_top3_in_scope",
)
