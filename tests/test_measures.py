import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewloom.plans import market as mk
from reviewloom.plans import measures as ms
from reviewloom.plans.model import ReviewModel
from reviewloom.plans.reports import REPORTS, run_report

D = dt.date


@pytest.fixture(scope="module")
def model(spark):
    def table(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    reviews = [
        ("x", 1, 4, D(2024, 1, 5), "a;b;a"),
        ("y", 5, 0, D(2024, 1, 9), "b"),
        ("z", 3, 2, D(2024, 3, 1), ""),
        ("w", None, 1, D(2024, 3, 2), None),
    ]
    return ReviewModel(
        reviews=table(reviews, "review_id string, rating int, helpful bigint, review_date date, keywords string"),
        scene=table([("x", "M", "a"), ("x", "M", "b"), ("x", "M", "c"), ("y", "M", "a"), ("z", "N", "d"), ("gone", "M", "a")], "review_id string, main string, sub string"),
        friction=table([("x", "P", "f"), ("y", "P", "f"), ("y", "P", "g"), ("z", "Q", "h")], "review_id string, main string, sub string"),
        motivation=table([("x", "H", "m")], "review_id string, main string, sub string"),
        time=table([("x", "Night"), ("y", "Night"), ("z", "Morning")], "review_id string, label string"),
        location=table([("x", "Home"), ("z", "Home"), ("w", "Office")], "review_id string, label string"),
        product_review=table([("A1", "x"), ("A2", "x"), ("A3", "y"), ("A3", "z"), ("A9", "w")], "asin string, review_id string"),
        product=table([("A1", "B1", 10.0, "a", "M1"), ("A2", "B1", 20.0, "a", "M2"), ("A3", "B2", 60.0, "b", "M1"), ("A9", None, None, None, None)], "asin string, brand string, price double, price_band string, model string"),
    )


def rows(df):
    return {tuple(r)[:-1] if len(r) > 2 else r[0]: r[-1] for r in df.collect()}


def test_a_review_counts_once_per_level(model):
    mean = ms.evaluate(model, ["scene_avg_rating"], ["scene_main"])
    assert rows(mean) == {"M": 3.0, "N": 3.0}
    assert rows(ms.evaluate(model, ["scene_reviews"], ["scene_main"])) == {"M": 2, "N": 1}
    levels = ms.evaluate_levels(model, ["scene_reviews"], [["scene_main", "scene_sub"], ["scene_main"], []])
    assert {(r["level"], r["scene_main"], r["scene_sub"]): r["scene_reviews"] for r in levels.collect()} == {
        (0, "M", "a"): 2, (0, "M", "b"): 1, (0, "M", "c"): 1, (0, "N", "d"): 1, (1, "M", None): 2, (1, "N", None): 1, (2, None, None): 3,
    }


def test_ids_without_a_review_do_not_count(model):
    assert ms.evaluate(model, ["scene_reviews", "all_reviews"]).first() == (3, 4)


def test_pairs_and_restrictions(model):
    assert rows(ms.evaluate(model, ["scene_friction_reviews"], ["scene_main", "friction_main"])) == {("M", "P"): 2, ("N", "Q"): 1}
    assert rows(ms.evaluate(model, ["scene_reviews_time_location"], ["scene_main"])) == {"M": 1, "N": 1}
    assert rows(ms.evaluate(model, ["friction_reviews_time"], ["time"])) == {"Night": 2, "Morning": 1}
    assert rows(ms.evaluate(model, ["location_friction_pct"], ["location"])) == {"Home": 1.0, "Office": None}


def test_scene_groups_leave_other_measures_alone(model):
    got = ms.evaluate(model, ["scene_reviews", "all_reviews", "scene_review_coverage_pct"], ["scene_main"]).orderBy("scene_main").collect()
    assert [tuple(r) for r in got] == [("M", 2, 4, 0.5), ("N", 1, 4, 0.25)]
    by_month = ms.evaluate(model, ["scene_reviews", "all_reviews"], ["scene_main", "month"]).orderBy("scene_main").collect()
    assert [tuple(r) for r in by_month] == [("M", D(2024, 1, 1), 2, 2), ("N", D(2024, 3, 1), 1, 2)]


def test_many_to_many_products(model):
    got = rows(ms.evaluate(model, ["all_reviews"], ["brand"]))
    assert got == {"B1": 1, "B2": 2, None: 1}
    assert rows(ms.evaluate(model, ["all_reviews"], ["asin"])) == {"A1": 1, "A2": 1, "A3": 2, "A9": 1}
    chosen = model.filtered(products=F.col("model") == "M1")
    assert ms.evaluate(chosen, ["all_reviews"]).first()[0] == 3
    assert rows(ms.evaluate(chosen, ["all_reviews"], ["asin"])) == {"A1": 1, "A3": 2}


def test_missing_group_keys_meet(model):
    got = ms.evaluate(model, ["all_reviews", "friction_reviews"], ["brand"]).collect()
    assert {r["brand"]: (r["all_reviews"], r["friction_reviews"]) for r in got} == {"B1": (1, 1), "B2": (2, 2), None: (1, None)}


def test_many_links_of_one_review(spark, model):
    """Half of all links on one review id: brand counts are those of a plain join."""
    many = model.product_review.unionByName(spark.range(400).select(F.concat(F.lit("S"), "id").alias("asin"), F.lit("z").alias("review_id")))
    products = model.product.unionByName(
        spark.range(400).select(F.concat(F.lit("S"), "id").alias("asin"), F.concat(F.lit("SB"), F.col("id") % 7).alias("brand"), F.lit(1.0).alias("price"), F.lit("a").alias("price_band"), F.lit("M").alias("model"))
    )
    from dataclasses import replace

    wide = replace(model, product_review=many, product=products, _hot={})
    assert wide.hot("review_id") == ["z"]
    got = rows(ms.evaluate(wide, ["all_reviews"], ["brand"]))
    assert got == {"B1": 1, "B2": 2, None: 1, **{f"SB{i}": 1 for i in range(7)}}


def test_keywords(model):
    assert rows(ms.evaluate(model, ["scene_reviews"], ["keyword"])) == {"a": 1, "b": 2}


def test_counts_over_nothing_are_blank(model):
    none = model.filtered(friction=F.lit(False))
    assert ms.evaluate(none, ["friction_reviews", "friction_rate_pct"]).first() == (None, None)
    assert ms.evaluate(none, ["friction_reviews"], ["friction_main"]).count() == 0


def test_total_statistics(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 2), (None, None, 1)], "review_id string, rating int, helpful bigint")
    assert ms.totals(df).first() == (2, 1.5, 0.5, 5, 1.5)


def month_model(spark, model, counts):
    """counts: month -> (reviews, with friction)."""
    reviews, tagged = [], []
    for (year, month), (n, f) in counts.items():
        for i in range(n):
            rid = f"{year}-{month}-{i}"
            reviews.append((rid, 3, 0, D(year, month, 1 + i % 28), ""))
            if i < f:
                tagged.append((rid, "P", "f"))
    from dataclasses import replace

    return replace(
        model,
        reviews=spark.createDataFrame(reviews, model.reviews.schema),
        friction=spark.createDataFrame(tagged, model.friction.schema),
        _hot={},
    )


def test_months_follow_the_calendar(spark, model):
    m = month_model(spark, model, {(2022, 9): (4, 4), (2022, 10): (2, 1), (2023, 3): (4, 1), (2024, 1): (4, 2), (2024, 3): (4, 3), (2024, 4): (2, 0)})
    got = {r["month"]: r for r in ms.monthly_friction(m).collect()}
    march = got[D(2024, 3, 1)]
    # February has no reviews, so there is no month-over-month change; last March counts for the year
    assert march["friction_mom_pct"] is None
    assert march["friction_yoy_pct"] == (0.75 - 0.25) / 0.25
    # 18 months up to March 2024 start with October 2022
    assert march["friction_pct_rolling18m"] == (1 + 1 + 2 + 3) / (2 + 4 + 4 + 4)
    april = got[D(2024, 4, 1)]
    assert april["friction_rate_pct"] is None and april["friction_mom_pct"] is None
    first = got[D(2022, 9, 1)]
    assert first["friction_pct_rolling18m"] == first["friction_rate_pct"] == 1.0


@pytest.fixture(scope="module")
def listing(spark):
    # brand, parent, asin, units, revenue, price, product, listing date, days
    data = [
        ("B1", "p1", "a1", 60, 600, 40.0, "Mask", D(2020, 1, 1), 10),
        ("B1", "p1", "a2", 100, 500, 60.0, "Mask", D(2019, 1, 1), 30),
        ("B1", "p2", "a3", 5, 50, 40.0, "Belt", D(1999, 1, 1), None),
        ("B2", "p3", "a4", 90, 900, 120.0, "Mask", D(2020, 1, 4), 7),
        ("B3", None, "a5", 0, 0, None, "Mask", None, 1),
        (None, None, "a6", 10, 10, 310.0, "Mask", D(2020, 1, 2), 2),
    ]
    ddl = "brand string, parent_asin string, asin string, monthly_units bigint, monthly_revenue bigint, price double, product string, listing_date date, days_listed bigint"
    from reviewloom.functions.scalars import price_band

    return spark.createDataFrame(data, ddl).withColumns(
        {
            "rating": F.lit(4.5),
            "rating_count": F.col("monthly_units") * 2,
            "parts": F.lit("x"),
            "pattern": F.lit("p"),
            "seller_region": F.lit("US"),
            "is_infrared": F.lit("RLT"),
            "price_band": price_band(F.col("price")),
        }
    )


def test_two_step_measures(listing):
    m = mk.Market(listing)
    got = mk.evaluate_market(m, ["monthly_units", "monthly_revenue", "brand_count", "avg_price", "median_price", "median_listing_date"], []).first()
    assert tuple(got)[:3] == (100 + 5 + 90 + 0 + 10, 600 + 50 + 900 + 0 + 10, 4)
    assert got["avg_price"] == (40 + 60 + 40 + 120 + 310) / 5 and got["median_price"] == 60.0
    # first dates of the parents after 2000: 2019-01-01, 2020-01-04, 2020-01-02
    assert got["median_listing_date"] == D(2020, 1, 2)
    brand = rows(mk.evaluate_market(m, ["monthly_units"], ["brand"]))
    assert brand == {"B1": 105, "B2": 90, "B3": 0, None: 10}


def test_band_shares_use_a_total_of_their_own(listing):
    got = rows(mk.evaluate_market(mk.Market(listing), ["band_unit_share"], ["price_band"]))
    shares = {k and k[0]: v for k, v in got.items()}
    # parent p1 stands in bands a and b with 60 and 100 units, but once (100) in the total of 205
    assert shares == {"a": 65 / 205, "b": 100 / 205, "c": 90 / 205, "g": 10 / 205, None: 0.0}


def test_brand_filter_is_set_aside(listing):
    m = mk.Market(listing, {"brand": F.col("brand") == "B2"})
    got = mk.evaluate_market(m, ["unit_share_all_brands", "brand_market_share"], ["brand"]).first()
    assert got["unit_share_all_brands"] == 90 / 205 and got["brand_market_share"] == 1.0


def test_days_ignore_product_filter(listing):
    m = mk.Market(listing, {"product": F.col("product") == "Belt", "brand": F.col("brand") == "B1"})
    got = mk.evaluate_market(m, ["median_days_listed", "monthly_units"], ["brand", "product"]).collect()
    assert [tuple(r) for r in got] == [("B1", "Belt", 30.0, 5)]


def test_top_brand_flags(spark, listing):
    def flags(units):
        data = [(f"B{i:03d}", f"p{i}", u, u) for i, u in enumerate(units)]
        df = spark.createDataFrame(data, "brand string, parent_asin string, monthly_units bigint, monthly_revenue bigint")
        df = df.withColumns({"rating_count": F.lit(1), "price": F.lit(1.0), "rating": F.lit(1.0), "listing_date": F.lit("2020-01-01").cast("date")})
        return mk.brand_table(mk.Market(df)).orderBy("brand").collect()

    six = flags([100, 90, 90, 80, 70, 60])
    assert [r["is_top_brand_units"] for r in six] == [1] * 6
    assert [r["revenue_rank"] for r in six] == [1, 2, 2, 4, 5, 6]
    assert [r["cumulative_revenue"] for r in six] == [100, 190, 280, 360, 430, 490]
    many = flags([1000 - i for i in range(199)] + [0])
    assert [r["is_top_brand_units"] for r in many] == [1] * 10 + [0] * 190
    assert [r["is_top_brand_units"] for r in flags([5, 0, None])] == [1, 0, 0]


def test_all_measures_of_the_catalogue():
    listing = {m for m in mk.MARKET_MEASURES}
    review = set(ms.MEASURES) | set(ms.MONTHLY)
    assert len(review) == 38 and len(listing) == 26
    assert len(review | listing) == 64


@pytest.mark.parametrize("report", REPORTS, ids=lambda r: f"{r.page}.{r.name}")
def test_every_report_runs(model, listing, report):
    df = run_report(report, model, mk.Market(listing))
    assert df.count() >= 1
    assert len(set(df.columns)) == len(df.columns)


def test_bitmaps_count_each_review_once(spark):
    from reviewloom.plans.bitmaps import label_bitmaps, level_counts, merged

    ids = [0, 1, -1, -32768, 32767, 32768, 32769, 10**12, 10**12 + 40_000, None]
    data = [(i, m, s) for k, i in enumerate(ids) for m, s in (("a", "x"), ("a", "y"), (None, "x"))[: 1 + k % 3]]
    rows = spark.createDataFrame(data * 2, "review_id bigint, main string, sub string")
    first, second = rows.where("sub = 'x'"), rows.where("sub = 'y' OR review_id > 5")
    maps = merged(*[label_bitmaps(part, ["main", "sub"]) for part in (first, second)])
    got = {tuple(r) for r in level_counts(maps, {0: ["main", "sub"], 1: ["main"], 2: []}).collect()}
    known = {d for d in data if d[0] is not None}
    want = {(0, m, s, len({i for i, a, b in known if (a, b) == (m, s)})) for _, m, s in known}
    want |= {(1, m, None, len({i for i, a, _ in known if a == m})) for _, m, _ in known}
    assert got == want | {(2, None, None, len({i for i, _, _ in known}))}
