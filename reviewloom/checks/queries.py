"""Registered queries. Each takes (spark, folder of the provided tables) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.checks import small_taxonomy as small
from reviewloom.checks import surrogates as s
from reviewloom.functions import dates, keywords, scalars, text
from reviewloom.operators import encode, keys, tagging, vectors
from reviewloom.operators.lookup import PARTS_ORDER, PATTERN_ORDER, first_match, load_lookup
from reviewloom.operators.taxonomy import NO_FALLBACK
from reviewloom.plans import bitmaps, dims, jobs, reports
from reviewloom.plans.market import (
    Market,
    brand_table,
    evaluate_market,
    evaluate_market_levels,
    median_days_listed,
    top3_in_scope,
    top_brand_totals,
    top_groups,
    two_level,
)
from reviewloom.plans.measures import evaluate, evaluate_levels, monthly_friction, totals
from reviewloom.schemas import FEATURE_TABLES, LISTING_COLUMNS
from reviewloom.session import materialise, scratch_path
from reviewloom.sources.landing import read_landing, to_review_raw
from reviewloom.sources.listing import prepare_listing, read_listing
from reviewloom.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTERED[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits: their last bits depend on the order of summation."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- review measures ------------------------------------------------------------------------------


@query
def bitmap_levels(spark, folder):
    """Distinct reviews per scene, main scene and in all, from bitmaps stored for two batches that share reviews."""
    lines = s.read(spark, folder, "lineitem").join(s.read(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    labels = (F.col("l_orderkey").alias("review_id"), F.col("p_type").alias("main"), F.col("p_brand").alias("sub"))
    batches = [materialise(bitmaps.label_bitmaps(lines.where(part).select(*labels), ["main", "sub"]), "bitmaps") for part in (F.col("l_linenumber") <= 2, F.col("l_linenumber") > 2)]
    return bitmaps.level_counts(bitmaps.merged(*batches), {0: ["main", "sub"], 1: ["main"], 2: []})


@query
def friction_rate_monthly(spark, folder):
    return rounded(monthly_friction(s.model(spark, folder)))


@query
def friction_rate_monthly_by_model(spark, folder):
    return rounded(monthly_friction(s.linked_model(spark, folder), ("model",)))


SCENE_MEASURES = [
    "scene_reviews",
    "scene_votes",
    "scene_vote_per_review",
    "scene_avg_rating",
    "scene_rating_stddev",
    "scene_rating_cv",
    "scene_review_coverage_pct",
]


@query
def scene_measures_main(spark, folder):
    return rounded(evaluate(s.model(spark, folder), SCENE_MEASURES, ["scene_main"]))


@query
def scene_measures_sub(spark, folder):
    return rounded(evaluate(s.model(spark, folder), SCENE_MEASURES, ["scene_main", "scene_sub"]))


@query
def scene_measures_total(spark, folder):
    return rounded(evaluate(s.model(spark, folder), SCENE_MEASURES))


@query
def friction_matrix_levels(spark, folder):
    names = [n.replace("scene", "friction") for n in SCENE_MEASURES[:-1]]
    return rounded(evaluate_levels(s.model(spark, folder), names, [["friction_main", "friction_sub"], ["friction_main"], []]))


@query
def motivation_matrix_levels(spark, folder):
    names = [n.replace("scene", "motivation") for n in SCENE_MEASURES[:-1]] + ["motivation_coverage_pct"]
    levels = [["motivation_main", "motivation_sub"], ["motivation_main"], []]
    return rounded(evaluate_levels(s.model(spark, folder), names, levels))


@query
def scene_friction_matrix(spark, folder):
    return evaluate_levels(
        s.model(spark, folder),
        ["scene_friction_reviews"],
        [["scene_main", "friction_main"], ["scene_main"], ["friction_main"], []],
    )


@query
def motivation_friction_matrix(spark, folder):
    by = ["motivation_main", "motivation_sub", "friction_main", "friction_sub"]
    return evaluate(s.model(spark, folder), ["motivation_friction_reviews"], by)


@query
def location_friction_matrix(spark, folder):
    return evaluate(s.model(spark, folder), ["location_friction_reviews"], ["location", "friction_main"])


@query
def scene_time_location(spark, folder):
    by = ["scene_main", "location", "time"]
    return evaluate(s.model(spark, folder), ["scene_reviews_time_location"], by)


@query
def motivation_time_location(spark, folder):
    return evaluate(s.model(spark, folder), ["motivation_reviews_time_location"], ["motivation_main", "time"])


@query
def friction_in_time(spark, folder):
    return evaluate(s.model(spark, folder), ["friction_reviews_time", "friction_reviews"], ["friction_sub"])


@query
def location_friction_share(spark, folder):
    names = ["location_reviews", "location_friction_reviews", "location_friction_pct"]
    return rounded(evaluate(s.model(spark, folder), names, ["location"]))


@query
def brand_reviews_m2m(spark, folder):
    names = ["all_reviews", "all_rating", "all_votes", "friction_reviews", "friction_coverage_pct", "mrating"]
    return rounded(evaluate_levels(s.linked_model(spark, folder), names, [["brand"], []]))


@query
def product_tree(spark, folder):
    levels = [[], ["friction_main"], ["friction_main", "friction_sub"], ["friction_main", "friction_sub", "brand"]]
    return evaluate_levels(s.linked_model(spark, folder), ["friction_reviews", "friction_votes"], levels)


@query
def product_slicer(spark, folder):
    """Reviews of two brands of one model, in a price range and a date range."""
    chosen = (
        F.struct("brand", "model").isin(F.struct(F.lit("Brand#1"), F.lit("ECONOMY")), F.struct(F.lit("Brand#2"), F.lit("PROMO")))
        & F.col("price").between(50, 300)
    )
    model = s.linked_model(spark, folder).filtered(
        reviews=F.col("review_date").between("1996-01-01", "1999-12-31"), products=chosen
    )
    return rounded(evaluate(model, ["all_reviews", "friction_reviews", "friction_rate_pct"], ["brand"]))


@query
def flow_edges(spark, folder):
    return reports.flow_edges(
        s.model(spark, folder), ["scene_main", "friction_main", "friction_sub"], "scene_friction_reviews"
    )


@query
def category_rank_by_month(spark, folder):
    return reports.rank_per_month(s.model(spark, folder), "scene_reviews", "scene_main")


@query
def kpi_cards(spark, folder):
    names = ["all_reviews", "scene_review_coverage_pct", "friction_coverage_pct", "motivation_coverage_pct"]
    return rounded(evaluate(s.model(spark, folder), names))


@query
def rating_stats(spark, folder):
    return rounded(totals(s.reviews(spark, folder)))


@query
def two_level_bars(spark, folder):
    by = ["motivation_main", "motivation_sub"]
    return evaluate(s.model(spark, folder), ["motivation_reviews"], by).orderBy(F.col("motivation_reviews").desc(), *by)


@query
def scatter_by_tag(spark, folder):
    return rounded(
        evaluate(s.model(spark, folder), ["scene_reviews", "scene_votes", "scene_vote_per_review"], ["scene_sub"])
    )


@query
def monthly_line(spark, folder):
    line = monthly_friction(s.model(spark, folder))
    return rounded(line.select(F.date_format("month", "yyyy-MM").alias("month"), "friction_rate_pct", "friction_pct_rolling18m"))


@query
def calendar_gaps(spark, folder):
    """Rare one-star reviews by month in the first halves of 1994 to 1997, from a table partitioned by month."""
    model = s.model(spark, folder)
    path = scratch_path(spark, "facts")
    dims.write_by_month(dims.review_facts(model.reviews, model.friction), path)
    days = dates.calendar(model.reviews, "review_date").where(F.col("Year").between(1994, 1997) & (F.col("QuarterNo") <= 2))
    rare = spark.read.parquet(path).where((F.col("rating") == 1) & (F.col("helpful") == 7))
    return rounded(dims.months_on_calendar(rare, days))


@query
def review_drillthrough(spark, folder):
    """Reviews behind one cell: scene ECONOMY and friction O, in a date range."""
    model = s.model(spark, folder)
    ids = keys.intersect_ids(
        model.scene.where(F.col("main") == "ECONOMY"), model.friction.where(F.col("main") == "O"), "review_id"
    )
    dated = model.reviews.where(F.col("review_date").between("1997-01-01", "1998-12-31"))
    return keys.restrict(dated, ids, "review_id")


@query
def calendar(spark, folder):
    return dates.calendar(s.reviews(spark, folder), "review_date")


@query
def month_windows(spark, folder):
    months = s.reviews(spark, folder).select(dates.month_start(F.col("review_date")).alias("month")).distinct()
    return months.select(
        "month",
        dates.window_start(F.col("month"), 18).alias("window_start"),
        dates.end_of_month(F.col("month")).alias("window_end"),
        F.add_months("month", -1).alias("month_before"),
        F.add_months("month", -12).alias("year_before"),
    )


# --- listing measures -----------------------------------------------------------------------------


def market(spark: SparkSession, folder: str, **filters: Column) -> Market:
    """The listing table is stored once, as an import would; measures pass over it several times."""
    return Market(materialise(s.listing(spark, folder), "listing"), filters)


@query
def brand_market(spark, folder):
    names = ["monthly_units", "monthly_revenue", "rating_count", "revenue_rank", "is_top10_brand"]
    return evaluate_market(market(spark, folder), names, ["brand"])


@query
def pareto_top15(spark, folder):
    brands = brand_table(market(spark, folder)).select("brand", "monthly_revenue", "cumulative_revenue", "pareto_share")
    return rounded(top_groups(brands, "monthly_revenue", 15, "brand"))


@query
def pareto_combo(spark, folder):
    """Top brands of one price range only."""
    chosen = market(spark, folder, price=F.col("price").between(100, 250))
    brands = brand_table(chosen).select("brand", "monthly_revenue", "pareto_share")
    return rounded(top_groups(brands, "monthly_revenue", 15, "brand"))


@query
def top15_brand_listings(spark, folder):
    """All listings of the 15 brands with the greatest revenue."""
    listed = market(spark, folder)
    brands = two_level(listed.rows(), ["brand"]).select("brand", "monthly_revenue")
    top = top_groups(brands, "monthly_revenue", 15, "brand")
    return keys.restrict(listed.rows(), top, "brand").select("asin", "brand", "price_band")


@query
def top_brand_flags(spark, folder):
    names = ["is_top_brand_units", "is_top_brand_revenue", "revenue_rank"]
    return evaluate_market(market(spark, folder), names, ["brand"])


@query
def top_brand_share(spark, folder):
    return rounded(top_brand_totals(brand_table(market(spark, folder))))


@query
def top3_parts(spark, folder):
    return top3_in_scope(market(spark, folder), "parts", "brand")


@query
def price_band_profile(spark, folder):
    names = ["brand_count", "band_unit_share", "band_revenue_share"]
    return rounded(evaluate_market(market(spark, folder), names, ["price_band"]).orderBy("price_band"))


@query
def share_ignoring_brand(spark, folder):
    chosen = market(spark, folder, brand=F.col("brand").isin("Brand#1", "Brand#2", "Brand#3"))
    names = ["monthly_units", "unit_share_all_brands", "revenue_share_all_brands"]
    return rounded(evaluate_market(chosen, names, ["pattern", "brand"]))


@query
def share_selected(spark, folder):
    chosen = market(spark, folder, price=F.col("price") < 200)
    return rounded(evaluate_market(chosen, ["monthly_revenue", "brand_market_share"], ["seller_region", "pattern"]))


@query
def listing_age_median(spark, folder):
    rows = s.listing(spark, folder)
    return two_level(rows, ["brand"]).select("brand", "median_listing_date")


@query
def days_listed_median(spark, folder):
    """The product filter is set aside, the price filter is not."""
    chosen = market(spark, folder, product=F.col("product") == "red", price=F.col("price") < 200)
    return rounded(median_days_listed(chosen, ["brand", "product"]))


@query
def brand_price_stats(spark, folder):
    names = ["avg_price", "median_price", "avg_listing_rating", "median_listing_rating"]
    return rounded(evaluate_market(market(spark, folder), names, ["brand"]))


@query
def market_kpis(spark, folder):
    names = ["monthly_units", "monthly_revenue", "brand_count", "avg_revenue_per_brand", "rating_count", "median_price"]
    return rounded(evaluate_market(market(spark, folder), names))


MATRIX_MEASURES = [
    "monthly_units",
    "monthly_revenue",
    "avg_price",
    "median_price",
    "brand_market_share",
    "median_listing_rating",
    "rating_count",
    "median_listing_date",
    "revenue_rank",
]


@query
def brand_asin_matrix(spark, folder):
    return rounded(evaluate_market_levels(market(spark, folder), MATRIX_MEASURES, [["brand", "asin"], ["brand"], []]))


@query
def region_pattern(spark, folder):
    names = ["monthly_revenue", "brand_market_share"]
    return rounded(evaluate_market(market(spark, folder), names, ["seller_region", "pattern"]))


# --- text -----------------------------------------------------------------------------------------


@query
def clean_html_text(spark, folder):
    return s.read_spread(spark, folder, "pages", "page_id").select("page_id", text.clean_text(F.col("html")).alias("clean_text"))


@query
def extract_ids(spark, folder):
    """Product id, review id and product name parsed from paths and links built from page and document keys."""
    page = s.read(spark, folder, "pages")
    link = F.concat(F.col("url"), F.lit("/customer-reviews/R"), F.col("page_id").cast("string"), F.lit("/ref=x"))
    url = F.when(F.pmod("page_id", F.lit(4)) > 0, link)
    path = F.concat(F.lit("reviews/B0"), F.col("page_id").cast("string"), F.lit("-US(Mask)-Reviews.csv"))
    return page.select(
        "page_id",
        text.review_id(url).alias("review_id"),
        text.review_id(F.col("url")).alias("no_id"),
        text.asin_from_path(path).alias("asin"),
        text.product_from_name(path).alias("product"),
        text.review_key(text.asin_from_path(path), text.review_id(url)).alias("review_key"),
    )


@query
def coerce_types(spark, folder):
    """The event payload as rating, votes and date text, with broken values in between."""
    broken = F.pmod("event_id", F.lit(7))
    number = F.regexp_extract("props", "([0-9]+)", 1)
    raw = F.when(broken == 0, F.lit("abc")).when(broken == 1, F.lit(None)).when(broken == 2, F.concat(number, F.lit(".5"))).otherwise(number)
    day = F.when(broken == 3, F.lit("n/a")).when(broken == 4, F.date_format("ts", "MM/dd/yyyy")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return s.read(spark, folder, "events").select(
        "event_id",
        scalars.whole_number(raw).alias("rating"),
        scalars.votes(raw).alias("votes"),
        scalars.parsed_date(day).alias("day"),
    )


@query
def null_profile(spark, folder):
    return keys.null_profile(s.raw_documents(spark, folder))


@query
def load_sample(spark, folder):
    """The rows that a load shows: three, by their key."""
    return keys.load_profile(s.raw_documents(spark, folder), order=["Review_Key"])[1]


@query
def title_normalise(spark, folder):
    """Every fourth part has no bullets."""
    bullets = F.when(F.pmod("p_partkey", F.lit(4)) > 0, F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")))
    both = F.lower(text.title_bullets(F.col("p_name"), F.trim(bullets)))
    return s.read(spark, folder, "part").select(
        "p_partkey",
        both.alias("title_bullets"),
        F.contains(both, F.lit("red")).alias("has_red"),
        F.contains(both, F.lit("RED")).alias("has_upper_red"),
    )


@query
def try_casts(spark, folder):
    source = s.read(spark, folder, "events").select(
        "event_id",
        F.concat("event_type", F.lit("x")).alias("word"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("number"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("whole"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    types = {"event_id": "bigint", "word": "bigint", "number": "double", "whole": "bigint", "day": "date"}
    return source.select(*scalars.casts(types))


@query
def ordered_label(spark, folder):
    rules = (("Red", ("red", "scarlet")), ("Small", ("small",)), ("Widget", ("widget",)))
    return s.read(spark, folder, "part").select(
        "p_partkey", text.ordered_label(F.lower("p_name"), rules, "Other").alias("label")
    )


def lookup_table(spark: SparkSession, folder: str, order) -> DataFrame:
    """Lookup entries taken from the part names: last words at a low priority, first words at a high one."""
    names = s.read(spark, folder, "part").select(F.split("p_name", " ").alias("w"), "p_type")
    last = names.select(F.col("p_type").alias("Product"), F.upper(F.element_at("w", -1)).alias("Term"), F.lit(2).alias("Priority"))
    first = names.select(F.col("p_type").alias("Product"), F.element_at("w", 1).alias("Term"), F.lit(1).alias("Priority"))
    rows = last.unionByName(first).where(F.length("Term") > 3).distinct()
    named = rows.withColumn("Type", F.concat_ws(":", F.lower("Term"), F.col("Priority").cast("string")))
    return load_lookup(named.withColumn("Priority", F.col("Priority").cast("string")), order)


@query
def first_match_lookup(spark, folder):
    rows = s.read(spark, folder, "part").select("p_partkey", "p_name", F.col("p_type").alias("product"))
    by_priority = first_match(rows, lookup_table(spark, folder, PATTERN_ORDER), "p_name", "product", "none", "by_priority")
    both = first_match(by_priority, lookup_table(spark, folder, PARTS_ORDER), "p_name", "product", "none", "by_term")
    fixed = F.when(F.col("product") == "ECONOMY", F.lit("fixed")).otherwise(F.col("by_term"))
    return both.select("p_partkey", "by_priority", fixed.alias("by_term"))


@query
def listing_prep(spark, folder):
    """Parts written as listing exports under the source headers, read back and prepared."""
    headers = {name: source for source, name, _ in LISTING_COLUMNS}
    part = s.read(spark, folder, "part")
    export = part.select(
        F.col("p_partkey").cast("string").alias(headers["asin"]),
        F.col("p_brand").alias(headers["brand"]),
        F.upper("p_name").alias(headers["title"]),
        F.when(F.pmod("p_partkey", F.lit(3)) == 0, F.lit("Far Infrared")).when(F.pmod("p_partkey", F.lit(3)) == 1, F.lit("Red-Light, soft")).alias(headers["bullets"]),
        F.when(F.pmod("p_partkey", F.lit(10)) > 0, F.col("p_size").cast("string")).alias(headers["monthly_units"]),
        F.round((F.col("p_retailprice") - 900) * 4, 2).cast("string").alias(headers["price"]),
        F.concat(F.col("p_size").cast("string"), F.lit("%")).alias(headers["review_rate"]),
        F.lit("N/A").alias(headers["sub_rank"]),
    )
    path = scratch_path(spark, "listing")
    export.write.option("header", "true").option("escape", '"').csv(path)
    lookup = lookup_table(spark, folder, PATTERN_ORDER).withColumn("product", F.lit("")).distinct()
    rows = prepare_listing(read_listing(spark, path), lookup, lookup, lookup)
    kept = ("asin", "title_bullets", "is_infrared", "cat", "parts", "pattern", "price_band", "review_rate", "sub_rank", "monthly_units")
    return rounded(rows.select(*kept))


@query
def keyword_bag(spark, folder):
    return s.read_spread(spark, folder, "documents", "doc_id").select("doc_id", keywords.keyword_bag(F.col("text"), forms={"lytion": "ly"}).alias("keywords"))


@query
def keyword_forms(spark, folder):
    """Keywords of all documents under a table of base forms made of their own words."""
    docs = s.read_spread(spark, folder, "documents", "doc_id").select("doc_id", "text")
    words = docs.select(F.explode(keywords.content_words(F.col("text"), ())).alias("form")).distinct()
    table = words.where(F.col("form").endswith("ion") & (F.length("form") >= 7)).withColumn("base", F.expr("left(form, length(form) - 3)"))
    return keywords.with_keywords(docs, "doc_id", "text", table).select("doc_id", "keywords")


@query
def keyword_top150(spark, folder):
    bags = s.raw_documents(spark, folder).select("Review_ID", keywords.keyword_list(F.col("Clean_Text"), forms={}).alias("words"))
    return reports.keyword_frequency(bags, "Review_ID", "words", 150)


# --- tagging --------------------------------------------------------------------------------------


def tagged_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = s.read_spread(spark, folder, "documents", "doc_id")
    stars = F.pmod("n_chars", F.lit(6))
    rated = docs.select(F.col("doc_id").alias("Review_ID"), F.col("text").alias("Clean_Text"), F.when(stars > 0, stars).alias("Rating"))
    return tagging.tag_reviews(rated, small.RULES, withdraw=small.withdraw)


@query
def regex_tag_bridge(spark, folder):
    return tagging.bridges(tagged_documents(spark, folder))["scene_bridge"]


@query
def suppressed_tags(spark, folder):
    bridge = tagging.bridges(tagged_documents(spark, folder))["friction_bridge"]
    return bridge.select("Review_ID", "Friction_Main", "Friction_Sub", "Friction_Source")


@query
def time_location_tags(spark, folder):
    tables = tagging.bridges(tagged_documents(spark, folder))
    times = tables["time_bridge"].select("Review_ID", F.lit("time").alias("family"), F.col("Time_of_Day").alias("label"))
    spots = tables["location_bridge"].select("Review_ID", F.lit("location").alias("family"), F.col("Location").alias("label"))
    return times.unionByName(spots)


@query
def tag_coverage(spark, folder):
    tagged = tagged_documents(spark, folder)
    rows = tagged.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(F.size("scenes") > 0).alias("with_scene"),
        F.count_if(F.size("frictions") > 0).alias("with_friction"),
    )
    return rounded(
        rows.select(
            "*",
            scalars.ratio(scalars.blank_if_zero(F.col("with_scene")), F.col("reviews")).alias("scene_pct"),
            scalars.ratio(scalars.blank_if_zero(F.col("with_friction")), F.col("reviews")).alias("friction_pct"),
        )
    )


@query
def run_summary(spark, folder):
    return tagging.run_summary(tagged_documents(spark, folder))


def label_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Mean vector of every label."""
    return vectors.centroids(s.read(spark, folder, "embeddings"), ["label"], "embedding")


@query
def centroids(spark, folder):
    means = label_centroids(spark, folder).select("label", F.posexplode("vec").alias("pos", "value"))
    return rounded(means)


@query
def nearest_centroid(spark, folder):
    labels = vectors.load_centroids(label_centroids(spark, folder), "label")
    scored = s.read(spark, folder, "embeddings").select("vec_id", vectors.nearest(F.col("embedding"), labels).alias("b"))
    return rounded(scored.select("vec_id", F.col("b.label").alias("best"), F.col("b.score").alias("score"), F.col("b.margin").alias("margin")))


@query
def cosine_pairs(spark, folder):
    """Similarity of each vector with the centroid of its own label."""
    own = s.read(spark, folder, "embeddings").join(label_centroids(spark, folder), "label")
    return rounded(own.select("vec_id", vectors.cosine(F.col("embedding"), F.col("vec")).alias("similarity")))


@query
def centroid_fallback(spark, folder):
    """Label, score and margin where the decision is clear; label 3 is vetoed on every fifth vector."""
    labels = vectors.load_centroids(label_centroids(spark, folder), "label")
    scored = s.read(spark, folder, "embeddings").select("vec_id", vectors.nearest(F.col("embedding"), labels).alias("b"))
    veto = (F.pmod("vec_id", F.lit(5)) == 0) & (F.col("b.label") == "3")
    kept = scored.where(vectors.decide(F.col("b"), 0.2, 0.03) & ~veto)
    return kept.select(
        "vec_id",
        F.col("b.label").alias("sub"),
        F.lit("Embedding").alias("source"),
        scalars.signal(F.col("b.score")).alias("score"),
        scalars.signal(F.col("b.margin")).alias("margin"),
    )


@query
def rules_then_centroids(spark, folder):
    """All documents: a scene by rule, else by centroid where there is a vector."""
    labels = vectors.load_centroids(label_centroids(spark, folder), "label")
    docs = s.read_spread(spark, folder, "documents", "doc_id").select(F.col("doc_id").alias("Review_ID"), F.col("text").alias("Clean_Text"), F.lit(None).cast("bigint").alias("Rating"))
    vecs = s.read(spark, folder, "embeddings").select(F.col("vec_id").alias("Review_ID"), "embedding")
    rules = [r for r in small.RULES if r.family == "scene"]
    tagged = tagging.tag_reviews(docs.join(vecs, "Review_ID", "left"), rules, {"scene": labels}, vector="embedding")
    return tagging.bridges(tagged)["scene_bridge"].select("Review_ID", "Sub_Scene")


def with_vectors(spark: SparkSession, folder: str, vector: Column) -> DataFrame:
    """All documents without ratings, beside their vectors."""
    docs = s.read_spread(spark, folder, "documents", "doc_id").select(F.col("doc_id").alias("Review_ID"), F.col("text").alias("Clean_Text"), F.lit(None).cast("bigint").alias("Rating"))
    vecs = s.read(spark, folder, "embeddings").select(F.col("vec_id").alias("Review_ID"), vector.alias("embedding"))
    return docs.join(vecs, "Review_ID", "left")


@query
def tag_failures(spark, folder):
    """Every seventh vector is cut short: a review that needs it fails with the reason and has no tags, the others go on."""
    labels = vectors.load_centroids(label_centroids(spark, folder), "label")
    cut = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))
    rules = [r for r in small.RULES if r.family == "scene"]
    tagged = tagging.tag_reviews(with_vectors(spark, folder, cut), rules, {"scene": labels}, vector="embedding")
    return tagged.select("Review_ID", "status", "error", F.size("scenes").alias("scenes"))


@query
def fallback_exclusion(spark, folder):
    """Label 3 goes by a name that the fallback may not choose, so its vectors fall to the next label."""
    named = label_centroids(spark, folder).withColumn("label", F.when(F.col("label") == 3, F.lit(NO_FALLBACK[0])).otherwise(F.col("label").cast("string")))
    labels = vectors.load_centroids(named, "label")
    rules = [r for r in small.RULES if r.family == "motivation"]
    tagged = tagging.tag_reviews(with_vectors(spark, folder, F.col("embedding")), rules, {"motivation": labels}, vector="embedding")
    return tagging.bridges(tagged)["motivation_bridge"].select("Review_ID", "Motivation_Sub", "Motivation_Source")


@query
def text_vectors(spark, folder):
    """TF-IDF of all documents under a projection to 384 numbers; frequencies are merged from two batches."""
    counts = encode.word_counts(s.read_spread(spark, folder, "documents", "doc_id").select("doc_id", "text"), "doc_id", "text")
    odd = F.pmod("doc_id", F.lit(2)) == 1
    frequencies = encode.merged_frequencies(*[encode.document_frequencies(counts.where(part)) for part in (odd, ~odd)])
    texts = s.read(spark, folder, "documents").count()
    projected = encode.projected_vectors(counts, "doc_id", frequencies, texts)
    flat = projected.select("doc_id", F.posexplode("embedding").alias("pos", "value"))
    return flat.select("doc_id", "pos", F.round(F.col("value").cast("double"), 3).alias("value"))


# --- incremental and dimensions -------------------------------------------------------------------


@query
def unprocessed_anti(spark, folder):
    return jobs.unprocessed(s.raw_documents(spark, folder), s.status(spark, folder), "v1")


def delta(spark: SparkSession, folder: str) -> DataFrame:
    todo = jobs.unprocessed(s.raw_documents(spark, folder), s.status(spark, folder), "v1")
    done = F.when(F.length("Clean_Text") > 300, F.lit("SUCCESS")).otherwise(F.lit("FAILED"))
    return todo.select("Review_ID", F.lit("v1").alias("Model_Version"), done.alias("Processing_Status"))


@query
def upsert_status(spark, folder):
    return keys.upsert(s.status(spark, folder), delta(spark, folder), "Review_ID")


@query
def replace_bridge(spark, folder):
    """Old tags of all labelled documents; processed ids lose theirs and successful ones get a new tag."""
    old = s.read(spark, folder, "labels").select(F.col("doc_id").alias("Review_ID"), F.concat(F.lit("old"), F.col("quality").cast("string")).alias("Tag"))
    processed = materialise(delta(spark, folder), "delta")
    new = processed.where(F.col("Processing_Status") == "SUCCESS").select("Review_ID", F.lit("new").alias("Tag"))
    return keys.replace_by_key(old, new, processed, "Review_ID")


def replaced(spark: SparkSession, name: str, old: DataFrame, new: DataFrame, processed: DataFrame) -> DataFrame:
    """A feature table with the old rows after the processed ids got their new ones, bucket by bucket."""
    house = new_warehouse(spark)
    house.overwrite(name, old, FEATURE_TABLES[name])
    house.replace_keys(name, new, processed)
    return house.table(name)


@query
def retag_some(spark, folder):
    """About one review in a hundred, by its length, is tagged again; every second of these has no scene any more."""
    docs = s.read(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("Review_ID"), "source", "lang", "n_chars")
    chosen = docs.where(F.pmod("n_chars", F.lit(97)) == 0)
    old = docs.select("Review_ID", F.col("source").alias("Main_Scene"), F.lit("old").alias("Sub_Scene"))
    new = chosen.where(F.pmod("n_chars", F.lit(2)) == 0).select("Review_ID", F.col("lang").alias("Main_Scene"), F.lit("new").alias("Sub_Scene"))
    return replaced(spark, "scene_bridge", old, new, chosen)


@query
def keyword_upsert(spark, folder):
    """Keywords of all documents; processed reviews get new ones, failed reviews an empty list."""
    docs = s.read(spark, folder, "documents")
    old = docs.select(F.col("doc_id").cast("string").alias("Review_ID"), F.concat_ws(";", "lang", "source").alias("Keywords"))
    processed = materialise(delta(spark, folder), "delta")
    words = F.when(F.col("Processing_Status") == "SUCCESS", F.concat(F.lit("new;"), "Model_Version")).otherwise(F.lit(""))
    new = processed.select(F.col("Review_ID").cast("string").alias("Review_ID"), words.alias("Keywords"))
    return replaced(spark, "review_features", old, new, new)


@query
def dim_review(spark, folder):
    raw = s.raw_documents(spark, folder)
    features = s.read(spark, folder, "labels").select(F.col("doc_id").alias("Review_ID"), F.concat(F.lit("k"), F.col("quality").cast("string")).alias("Keywords"))
    return dims.dim_review(raw, features)


@query
def dim_asinreview(spark, folder):
    raw = s.raw_documents(spark, folder)
    return dims.dim_asinreview(raw.unionByName(raw))


@query
def product_dim(spark, folder):
    """Listings with a second row per part, two models for every 50th part, links from all lines."""
    listing = s.product(spark, folder).select("asin", "brand", "price", "price_band")
    twice = listing.unionByName(listing.withColumn("brand", F.concat(F.lit("A"), F.col("brand"))))
    part = s.read(spark, folder, "part")
    models = part.select(F.col("p_partkey").alias("asin"), F.col("p_type").alias("model"))
    more = models.where(F.pmod("asin", F.lit(50)) == 0).withColumn("model", F.lit("SECOND"))
    links = s.read(spark, folder, "lineitem").select(F.col("l_partkey").alias("asin"))
    return dims.dim_product(twice, models.unionByName(more), links)


@query
def blank_scope_tests(spark, folder):
    """Scope of a grouped report over nation and region: subtotal rows, single-brand test, blank test."""
    rows = s.read(spark, folder, "customer").join(s.read(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    grouped = rows.rollup("c_mktsegment", "n_name").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.when(F.col("c_acctbal") < 0, 1)).cast("bigint").alias("negative"),
        (F.count_distinct("c_nationkey") == 1).alias("has_one_nation"),
        F.grouping_id().cast("bigint").alias("scope"),
    )
    return rounded(
        grouped.select(
            "c_mktsegment",
            "n_name",
            "scope",
            "customers",
            "has_one_nation",
            F.when(F.col("negative").isNotNull(), scalars.ratio(F.col("negative"), F.col("customers"))).alias("negative_rate"),
        )
    )


@query
def safe_ratios(spark, folder):
    return s.read(spark, folder, "documents").select(
        "doc_id",
        F.bround(scalars.ratio(F.col("n_chars"), F.pmod("n_chars", F.lit(3))), 6).alias("ratio"),
        F.bround(F.col("n_chars") / F.lit(16.0), 3).alias("signal"),
        F.length(text.blank_to_space(F.col("text"))).alias("encoder_length"),
    )


# --- sources and sinks ----------------------------------------------------------------------------


def write_landing(spark: SparkSession, folder: str, path: str) -> None:
    """Documents as landing files: full ones, ones without the optional columns, ones without a link."""
    docs = s.read_spread(spark, folder, "documents", "doc_id")
    link = F.concat(F.lit("https://h/customer-reviews/R"), F.col("doc_id").cast("string"), F.lit("/ref=cm"))
    base = [F.col("source").alias("Title"), F.col("text").alias("Content"), link.alias("URL"), F.pmod("n_chars", F.lit(7)).cast("string").alias("Rating")]
    extra = [
        F.when(F.pmod("doc_id", F.lit(5)) == 0, F.lit("n/a")).otherwise(F.lit("2024-03-01")).alias("Date"),
        F.pmod("n_chars", F.lit(11)).cast("string").alias("Helpful"),
        F.lit("Yes").alias("Verified Purchase"),
    ]
    part = F.pmod("doc_id", F.lit(10))
    docs.where(part < 5).select(*base, *extra).write.json(f"{path}/full")
    docs.where(part.between(5, 8)).select(*base).write.json(f"{path}/short")
    docs.where(part == 9).select(*base[:2], base[3]).write.json(f"{path}/broken")


@query
def landing_roundtrip(spark, folder):
    path = scratch_path(spark, "landing")
    write_landing(spark, folder, path)
    rows, _ = read_landing(spark, path, "json")
    stored = materialise(to_review_raw(rows), "review_raw")
    kept = ("Review_ID", "ASIN", "Rating", "Clean_Text", "Review_Date", "Helpful_Votes", "Verified", "Variant")
    return stored.select(*kept)


@query
def landing_provenance(spark, folder):
    """Rows by folder of their source file, and whether all rows of the load carry one time stamp."""
    path = scratch_path(spark, "landing")
    write_landing(spark, folder, path)
    stored = materialise(to_review_raw(read_landing(spark, path, "json")[0]), "review_raw")
    place = F.regexp_extract("Source_File", "([a-z]+)/[^/]+$", 1).alias("place")
    stamps = stored.agg(F.count_distinct("ETL_Time")).first()[0]
    return stored.groupBy(place).agg(F.count(F.lit(1)).alias("rows"), F.lit(stamps == 1).alias("one_stamp"))


@query
def landing_rejects(spark, folder):
    path = scratch_path(spark, "landing")
    write_landing(spark, folder, path)
    _, rejects = read_landing(spark, path, "json")
    return rejects.select(F.explode("missing").alias("missing")).distinct()


@query
def feature_tables(spark, folder):
    """Create the feature tables, load the status and append to it; rows per table."""
    house = new_warehouse(spark)
    house.create_feature_tables()
    seen = s.status(spark, folder).select(
        F.col("Review_ID").cast("string").alias("Review_ID"),
        "Model_Version",
        F.lit("2024-01-01").cast("timestamp").alias("Processed_Time"),
        "Processing_Status",
        F.lit(None).cast("string").alias("Error_Message"),
    )
    house.overwrite("review_processing", seen.where(F.col("Model_Version") == "v0"), FEATURE_TABLES["review_processing"])
    house.append("review_processing", seen.where(F.col("Model_Version") == "v1"))
    out = None
    for name in FEATURE_TABLES:
        rows = house.table(name).groupBy().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def new_warehouse(spark: SparkSession) -> Warehouse:
    name = f"reviewloom_{uuid.uuid4().hex[:12]}"
    return Warehouse(spark, name, scratch_path(spark, name))


def raw_with_text_ids(spark: SparkSession, folder: str) -> DataFrame:
    raw = s.raw_documents(spark, folder)
    return raw.withColumn("Review_ID", F.col("Review_ID").cast("string"))


@query
def tag_status(spark, folder):
    """Two tagging runs over the documents: rules alone, then a second version. Status and tag rows."""
    house = new_warehouse(spark)
    house.create_feature_tables()
    house.overwrite("review_raw", raw_with_text_ids(spark, folder))
    jobs.run_tagging(house, jobs.Tagger("v1", small.RULES))
    jobs.run_tagging(house, jobs.Tagger("v2", small.RULES))
    jobs.run_tagging(house, jobs.Tagger("v2", small.RULES))
    tags = house.table("scene_bridge").groupBy("Review_ID").agg(F.count(F.lit(1)).alias("scenes"))
    state = house.table("review_processing").select("Review_ID", "Model_Version", "Processing_Status")
    return state.join(tags, "Review_ID", "left").withColumn("scenes", F.coalesce("scenes", F.lit(0).cast("bigint")))


@query
def stream_ingest_tag(spark, folder):
    """Landing files picked up as a stream, tagged, with one status row per review."""
    from reviewloom.streaming.ingest import ingest

    path = scratch_path(spark, "stream")
    write_landing(spark, folder, f"{path}/in")
    house = new_warehouse(spark)
    house.create_feature_tables()
    stream = ingest(spark, house, f"{path}/in/*", f"{path}/state", jobs.Tagger("v1", small.RULES))
    stream.awaitTermination()
    return house.table("review_processing").select("Review_ID", "Model_Version", "Processing_Status")
