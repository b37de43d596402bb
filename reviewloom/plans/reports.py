"""Report shapes and the catalogue of report queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.plans.market import Market, evaluate_market, evaluate_market_levels, top3_in_scope, top_groups
from reviewloom.plans.measures import evaluate, evaluate_levels, monthly_friction
from reviewloom.plans.model import ReviewModel

KEYWORD_LIMIT = 150


def rank_per_month(model: ReviewModel, measure: str, label: str) -> DataFrame:
    """Place of each label within its month. A month has as many rows as there are labels."""
    counts = evaluate(model, [measure], ["month", label])
    place = F.rank().over(Window.partitionBy("month").orderBy(F.col(measure).desc()))
    return counts.withColumn("place", place.cast("int"))


def flow_edges(model: ReviewModel, path: list[str], measure: str) -> DataFrame:
    """Reviews per edge between neighbouring levels of ``path``."""
    out = None
    for step, (left, right) in enumerate(zip(path, path[1:])):
        edge = evaluate(model, [measure], [left, right]).select(
            F.lit(step).alias("step"),
            F.col(left).cast("string").alias("source"),
            F.col(right).cast("string").alias("target"),
            F.col(measure).alias("reviews"),
        )
        out = edge if out is None else out.unionByName(edge)
    return out


def keyword_frequency(bags: DataFrame, key: str, words: str, limit: int = KEYWORD_LIMIT) -> DataFrame:
    """Most frequent words: reviews that hold the word, and how often it occurs in all.

    Repeats within a review are merged by (word, review) before words meet, so a word that is in a third
    of all reviews is counted by many tasks.
    """
    # an outer explode keeps the word expression from being copied into a filter in front of it
    exploded = bags.select(key, F.explode_outer(words).alias("word")).where(F.col("word").isNotNull())
    per_review = exploded.groupBy("word", key).agg(F.count(F.lit(1)).alias("n"))
    counts = per_review.groupBy("word").agg(F.count(F.lit(1)).alias("reviews"), F.sum("n").alias("terms"))
    return top_groups(counts, "reviews", limit, "word")


@dataclass(frozen=True)
class Report:
    """One report visual: grouping, measures, sort, and how its rows are shaped."""

    page: str
    name: str
    measures: tuple[str, ...]
    by: tuple[str, ...] = ()
    shape: str = "group"
    sort: str | None = None
    limit: int | None = None


def _family(page: str, family: str) -> list[Report]:
    """The visuals that the three tag pages share."""
    main, sub = f"{family}_main", f"{family}_sub"
    reviews, votes, per = f"{family}_reviews", f"{family}_votes", f"{family}_vote_per_review"
    coverage = "scene_review_coverage_pct" if family == "scene" else f"{family}_coverage_pct"
    tree = reviews if family != "motivation" else votes
    spread = (reviews, votes, per, f"{family}_avg_rating", f"{family}_rating_stddev", f"{family}_rating_cv")
    return [
        Report(page, "matrix", spread, (main, sub), "levels", reviews),
        Report(page, "tree", (tree,), (main, sub, "brand", "price", "asin"), "tree"),
        Report(page, "word_cloud", (reviews,), ("keyword",), "group", reviews, KEYWORD_LIMIT),
        Report(page, "coverage_card", (coverage,)),
        Report(page, "reviews_card", (reviews,)),
        Report(page, "month_ribbon", (reviews,), ("month", main), "ranked"),
        Report(page, "votes_pie", (votes,), (main, sub), "group", votes),
        Report(page, "reviews_pie", (reviews,), (main, sub), "group", reviews),
        Report(page, "scatter", (votes, per, reviews), (sub,)),
    ]


REPORTS: list[Report] = [
    # market share page
    Report("market", "brand_count_card", ("brand_count",)),
    Report("market", "revenue_per_brand_card", ("avg_revenue_per_brand",)),
    Report("market", "revenue_card", ("monthly_revenue",)),
    Report("market", "units_card", ("monthly_units",)),
    Report("market", "top_unit_share_card", ("top_brand_unit_share",)),
    Report("market", "top_revenue_share_card", ("top_brand_revenue_share",)),
    Report("market", "parts_brand_bar", ("monthly_revenue",), ("parts", "brand"), "levels", "monthly_revenue"),
    Report("market", "brand_age_scatter", ("monthly_revenue", "median_days_listed"), ("brand",)),
    Report("market", "pattern_revenue_pie", ("avg_price", "monthly_revenue"), ("pattern",), "group", "monthly_revenue"),
    Report("market", "region_pattern_treemap", ("brand_market_share", "monthly_revenue"), ("seller_region", "pattern")),
    Report(
        "market",
        "brand_matrix",
        (
            "monthly_units",
            "monthly_revenue",
            "avg_price",
            "median_price",
            "brand_market_share",
            "median_listing_rating",
            "rating_count",
            "median_listing_date",
            "revenue_rank",
        ),
        ("brand", "asin"),
        "levels",
        "monthly_revenue",
    ),
    Report("market", "brand_header", ("revenue_rank", "is_top10_brand"), ("brand",)),
    Report("market", "pattern_units_pie", ("avg_price", "monthly_units"), ("pattern",), "group", "monthly_units"),
    Report("market", "pareto", ("monthly_revenue", "pareto_share"), ("brand",), "group", "monthly_revenue", 15),
    Report("market", "brand_parts_donut", ("monthly_revenue",), ("brand", "parts"), "group", "monthly_revenue"),
    Report("market", "brand_units_donut", ("monthly_units",), ("brand",), "group", "monthly_units"),
    Report("market", "price_bands", ("brand_count", "band_unit_share", "band_revenue_share"), ("price_band",)),
    Report("market", "band_rating_scatter", ("monthly_revenue", "median_listing_rating"), ("price_band",)),
    Report("market", "brand_price_scatter", ("monthly_revenue", "avg_price", "monthly_units"), ("brand",)),
    Report("market", "parts_brand_top3", ("is_top3_in_scope",), ("parts", "brand"), "top3"),
    # brand details page
    Report("brands", "parts_donut", ("monthly_revenue",), ("parts",), "group", "monthly_revenue"),
    # overview page
    Report("overview", "reviews_card", ("all_reviews",)),
    Report("overview", "scene_coverage_card", ("scene_review_coverage_pct",)),
    Report("overview", "friction_coverage_card", ("friction_coverage_pct",)),
    Report("overview", "motivation_coverage_card", ("motivation_coverage_pct",)),
    Report("overview", "scene_bar", ("scene_reviews",), ("scene_main", "scene_sub"), "group", "scene_reviews"),
    Report("overview", "friction_bar", ("friction_reviews",), ("friction_main", "friction_sub"), "group", "friction_reviews"),
    Report(
        "overview", "motivation_bar", ("motivation_reviews",), ("motivation_main", "motivation_sub"), "group", "motivation_reviews"
    ),
    Report(
        "overview",
        "motivation_friction_matrix",
        ("motivation_friction_reviews",),
        ("motivation_main", "motivation_sub", "friction_main", "friction_sub"),
        "matrix",
    ),
    Report(
        "overview",
        "scene_friction_matrix",
        ("scene_friction_reviews",),
        ("scene_main", "scene_sub", "friction_main", "friction_sub"),
        "matrix",
    ),
    Report(
        "overview", "location_friction_matrix", ("location_friction_reviews",), ("location", "friction_main", "friction_sub"), "matrix"
    ),
    Report("overview", "location_donut", ("location_friction_pct", "location_reviews"), ("location",), "group", "location_reviews"),
    Report("overview", "friction_line", (), ("month",), "monthly"),
    # tag pages
    *_family("scene", "scene"),
    Report("scene", "flow", ("scene_reviews_time_location",), ("scene_main", "scene_sub", "location", "time"), "flow"),
    Report("scene", "heat_map", ("scene_reviews_time_location",), ("scene_main", "scene_sub", "location")),
    *_family("friction", "friction"),
    Report("friction", "flow", ("scene_friction_reviews",), ("scene_main", "scene_sub", "friction_main", "friction_sub"), "flow"),
    Report("friction", "heat_map", ("scene_friction_reviews",), ("scene_main", "scene_sub", "friction_main", "friction_sub")),
    *_family("motivation", "motivation"),
    Report(
        "motivation", "flow", ("motivation_reviews_time_location",), ("motivation_main", "motivation_sub", "location", "time"), "flow"
    ),
    Report(
        "motivation",
        "heat_map",
        ("motivation_friction_reviews",),
        ("motivation_main", "motivation_sub", "friction_main", "friction_sub"),
    ),
]

MARKET_PAGES = ("market", "brands")


def _prefixes(columns: tuple[str, ...]) -> list[list[str]]:
    return [list(columns[:n]) for n in range(len(columns), -1, -1)]


def _matrix_levels(by: tuple[str, ...]) -> list[list[str]]:
    """Rows by columns with every subtotal of both hierarchies."""
    rows = tuple(c for c in by if not c.startswith("friction"))
    columns = tuple(c for c in by if c.startswith("friction"))
    return [r + c for r in _prefixes(rows) for c in _prefixes(columns)]


def run_report(report: Report, model: ReviewModel | None = None, market: Market | None = None) -> DataFrame:
    """The rows of a report visual, under the slicers already applied to ``model`` or ``market``."""
    names, by = list(report.measures), list(report.by)
    on_market = report.page in MARKET_PAGES
    if report.shape == "monthly":
        return monthly_friction(model)
    if report.shape == "flow":
        return flow_edges(model, by, names[0])
    if report.shape == "ranked":
        return rank_per_month(model, names[0], by[1])
    if report.shape == "top3":
        return top3_in_scope(market, *by)
    if report.shape in ("levels", "tree"):
        levels = _prefixes(report.by)
        out = evaluate_market_levels(market, names, levels) if on_market else evaluate_levels(model, names, levels)
    elif report.shape == "matrix":
        out = evaluate_levels(model, names, _matrix_levels(report.by))
    else:
        out = evaluate_market(market, names, by) if on_market else evaluate(model, names, by)
    if report.limit:
        return top_groups(out, report.sort, report.limit, *by)
    return out.orderBy(F.col(report.sort).desc(), *by) if report.sort else out
