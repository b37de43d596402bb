import pytest
from pyspark.sql import functions as F

from reviewloom.operators import tagging, taxonomy
from reviewloom.operators.vectors import centroids, cosine, decide, load_centroids, nearest

# (id, rating, text, kept frictions, scenes, motivations, times, locations)
GOLDEN = [
    ("G1", 4, "Too bright and hurts my eyes, but it helps my knee pain after surgery.", "Adverse_Reaction Sensory_Overload", "chronic_pain joint_recovery surgery_recovery", "", "", ""),
    ("G2", 5, "My old mask stopped working so I got this one.", "", "", "", "", ""),
    ("G2b", 2, "It stopped working after a week.", "Reliability_Issue", "", "", "", ""),
    ("G3", 5, "Not flimsy, excellent quality and well made.", "", "", "", "", ""),
    ("G3b", 2, "Poor quality plastic.", "Build_Quality", "", "", "", ""),
    ("G4", 4, "It is not too heavy to hold.", "", "", "", "", ""),
    ("G4b", 3, "It is heavy and hard to carry.", "Device_Handling", "", "", "", ""),
    ("G5", 1, "It did not work, arrived defective.", "Reliability_Issue", "", "", "", ""),
    ("G5b", 2, "It did not work on my wrinkles.", "Efficacy_Ambiguity", "", "", "", ""),
    ("G6", 4, "I have neck pain after long flights.", "", "", "", "", ""),
    ("G6b", 3, "This makes my neck sore.", "Posture_Burden", "", "", "", ""),
    ("G6c", 3, "My neck sore from using it.", "Posture_Burden", "", "", "", ""),
    ("G7", 5, "Great battery life on this unit.", "", "", "", "", ""),
    ("G7b", 2, "Battery life is poor.", "Battery_Life", "", "", "", ""),
    ("G8", 5, "A little too expensive but worth the money.", "", "", "", "", ""),
    ("G8b", 3, "A little too expensive but worth the money.", "Price_Shock", "", "", "", ""),
    ("G8c", None, "A little too expensive but worth the money.", "Price_Shock", "", "", "", ""),
    ("G9", 5, "Comfortable temperature, never too hot.", "", "", "", "", ""),
    ("G9b", 2, "The mask gets too hot.", "Thermal_Discomfort", "", "", "", ""),
    ("G10", 5, "I was disappointed at first but love it.", "", "", "", "", ""),
    ("G10b", 4, "I was disappointed at first but love it.", "Disappointment", "", "", "", ""),
    ("G11", 5, "I use it at home before bed and in the morning.", "", "", "", "Morning Before_Bed", "Home"),
    ("G12", 5, "Bought this for my back pain, recommended by my doctor.", "", "back_recovery", "Back_Pain Professional_Recommendation", "", ""),
    ("G13", 5, "Works great in my office; using it for my skin.", "", "wfh", "Skin_Health", "", "Office"),
    ("G14", 3, "Blue rectangle.", "", "", "", "", ""),
]
# Rule hits before any withdrawal, where they differ from what is kept.
HITS = {
    "G2": "Reliability_Issue", "G3": "Build_Quality", "G4": "Device_Handling", "G5": "Efficacy_Ambiguity Reliability_Issue",
    "G6": "Posture_Burden", "G7": "Battery_Life", "G8": "Price_Shock", "G9": "Thermal_Discomfort", "G10": "Disappointment",
}


def reviews(spark, rows=GOLDEN):
    data = [(r[0], r[2], r[1]) for r in rows]
    return spark.createDataFrame(data, "Review_ID string, Clean_Text string, Rating bigint")


def subs(tags):
    return " ".join(t["sub"] for t in tags)


@pytest.fixture(scope="module")
def tagged(spark):
    return {r["Review_ID"]: r for r in tagging.tag_reviews(reviews(spark)).collect()}


@pytest.mark.parametrize("case", GOLDEN, ids=lambda c: c[0])
def test_golden_rows(tagged, case):
    row = tagged[case[0]]
    got = (subs(row["frictions"]), subs(row["scenes"]), subs(row["motivations"]), " ".join(row["times"]), " ".join(row["locations"]))
    assert got == case[3:]
    assert row["status"] == "SUCCESS"
    assert all(t["source"] == "Regex" and t["score"] is None for t in row["frictions"])


def test_hits_before_withdrawal(spark):
    labels = tagging.label_patterns(taxonomy.starter_rules(), "friction")
    text = F.col("Clean_Text")
    rows = reviews(spark).select("Review_ID", tagging.rule_hits(text, tagging.folded(text), labels).alias("h")).collect()
    for case in GOLDEN:
        found = next(subs(r["h"]) for r in rows if r["Review_ID"] == case[0])
        assert found == HITS.get(case[0], case[3])


def test_label_inventory():
    rules = taxonomy.starter_rules()
    assert [len(tagging.label_patterns(rules, f)) for f in taxonomy.FAMILIES] == [41, 54, 20, 5, 6]


def test_blank_and_missing_text(spark):
    df = spark.createDataFrame([("a", "  ", 1, [1.0, 0.0]), ("b", None, 1, [1.0, 0.0])], "Review_ID string, Clean_Text string, Rating bigint, v array<float>")
    got = tagging.tag_reviews(df, centroids={"scene": [("yoga", [1.0, 0.0]), ("nap", [0.0, 1.0])]}, vector="v").collect()
    for row in got:
        assert row["status"] == "SUCCESS" and row["keywords"] == ""
        assert not (row["scenes"] or row["frictions"] or row["motivations"] or row["times"] or row["locations"])


def test_hints_never_hide_a_match(spark):
    """Every rule gives the same hits with and without its hints, also for unusual letters."""
    rules = taxonomy.starter_rules()
    bare = [r._replace(hints=()) for r in rules]
    extra = [(f"x{i}", None, t, *[""] * 5) for i, t in enumerate(
        ["DİSAPPOİNTED", "diſappointed", "the Åx baK", "OVERPRICED!", "Skin  Care", "SELFCARE and self care", "insomnıa", "after my workouts", "hurting me"]
    )]
    text = F.col("Clean_Text")
    df = reviews(spark, GOLDEN + extra)
    for family in taxonomy.FAMILIES:
        with_hints = tagging.rule_hits(text, tagging.folded(text), tagging.label_patterns(rules, family))
        without = tagging.rule_hits(text, tagging.folded(text), tagging.label_patterns(bare, family))
        assert df.where(~with_hints.eqNullSafe(without)).count() == 0


def test_rules_from_a_table(spark):
    table = spark.createDataFrame(
        [("scene", "M", "b", 1, "blue", None), ("scene", "M", "a", 0, "rect", ["rect"])],
        "family string, main string, sub string, ord int, pattern string, hints array<string>",
    )
    rules = taxonomy.load_rules(table)
    assert rules == [taxonomy.Rule("scene", "M", "a", 0, "rect", ("rect",)), taxonomy.Rule("scene", "M", "b", 1, "blue")]
    got = tagging.tag_reviews(reviews(spark, [GOLDEN[-1]]), rules).first()
    assert subs(got["scenes"]) == "a b" and got["times"] == []
    plain = taxonomy.load_rules(table.drop("hints"))
    assert all(r.hints == () for r in plain)


# Two labels on orthogonal axes of their own: a vector (a, b, rest) scores a on the first and b on the second.
AXES = [("Adverse_Reaction", [1.0, 0.0, 0.0]), ("Battery_Life", [0.0, 1.0, 0.0])]


def scored(a, b):
    return [a, b, (1 - a * a - b * b) ** 0.5]


@pytest.mark.parametrize(
    "first, second, rating, labels, wanted",
    [
        (0.70, 0.60, 3, AXES, ("Adverse_Reaction", 0.7, 0.1)),
        (0.70, 0.66, 3, AXES, None),
        (0.54, 0.10, 3, AXES, None),
        (0.70, 0.60, 5, AXES, None),
        (0.60, 0.70, 5, AXES, ("Battery_Life", 0.7, 0.1)),
        (0.70, 0.60, None, AXES, ("Adverse_Reaction", 0.7, 0.1)),
        (0.60, 0.10, 3, AXES[:1], ("Adverse_Reaction", 0.6, 1.0)),
    ],
)
def test_friction_fallback(spark, first, second, rating, labels, wanted):
    df = spark.createDataFrame([("r", "Blue rectangle.", rating, scored(first, second))], "Review_ID string, Clean_Text string, Rating bigint, v array<double>")
    tags = tagging.tag_reviews(df, centroids={"friction": labels}, vector="v").first()["frictions"]
    if wanted is None:
        assert tags == []
    else:
        assert [(t["sub"], t["score"], t["margin"], t["source"]) for t in tags] == [(*wanted, "Embedding")]
        assert tags[0]["main"] in ("Physical", "Lifecycle")


def test_fallback_only_without_rule_labels_and_after_withdrawal(spark):
    rows = [("kept", "Battery life is poor.", 2), ("withdrawn", "Great battery life on this unit.", 5), ("late", "I was disappointed at first but love it.", 5)]
    df = spark.createDataFrame([(*r, scored(0.1, 0.9)) for r in rows], "Review_ID string, Clean_Text string, Rating bigint, v array<double>")
    labels = [("Fit_Issue", [1.0, 0.0, 0.0]), ("Charging_Issue", [0.0, 1.0, 0.0])]
    got = {r["Review_ID"]: subs(r["frictions"]) for r in tagging.tag_reviews(df, centroids={"friction": labels}, vector="v").collect()}
    assert got == {"kept": "Battery_Life", "withdrawn": "Charging_Issue", "late": ""}


def test_recommendation_labels_have_no_fallback(spark):
    df = spark.createDataFrame([("r", "Blue rectangle.", 3, scored(0.9, 0.1))], "Review_ID string, Clean_Text string, Rating bigint, v array<double>")
    labels = [("Online_Reviews", [1.0, 0.0, 0.0]), ("Gift_Purchase", [0.0, 1.0, 0.0])]
    assert tagging.tag_reviews(df, centroids={"motivation": labels}, vector="v").first()["motivations"] == []
    alone = tagging.tag_reviews(df.withColumn("v", F.array(F.lit(0.1), F.lit(0.9), F.lit(0.4))), centroids={"motivation": labels}, vector="v").first()
    # the excluded label does not count for the margin either
    assert [(t["sub"], t["margin"]) for t in alone["motivations"]] == [("Gift_Purchase", 1.0)]


def test_bad_vector_fails_its_review_only(spark):
    df = spark.createDataFrame(
        [("ok", "Blue rectangle at home.", 3, scored(0.9, 0.1)), ("short", "Blue rectangle at home.", 3, [1.0]), ("zero", "Blue rectangle.", 3, [0.0] * 3), ("none", "Blue.", 3, None)],
        "Review_ID string, Clean_Text string, Rating bigint, v array<double>",
    )
    tagged = tagging.tag_reviews(df, centroids={"friction": AXES}, vector="v")
    rows = {r["Review_ID"]: r for r in tagged.collect()}
    assert [rows[k]["status"] for k in ("ok", "short", "zero", "none")] == ["SUCCESS", "FAILED", "FAILED", "SUCCESS"]
    assert rows["short"]["error"] and rows["short"]["keywords"] == "" and rows["short"]["locations"] == []
    places = tagging.bridges(tagged)["location_bridge"].collect()
    assert [r["Review_ID"] for r in places] == ["ok"]
    assert tagging.run_summary(tagged).first().asDict() == {
        "reviews": 4, "success": 2, "failed": 2, "scenes_rows": 0, "frictions_rows": 1, "motivations_rows": 0, "times_rows": 0, "locations_rows": 1,
    }


def test_centroid_is_the_plain_mean(spark):
    seeds = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("b", [3.0, 4.0])], "sub string, v array<double>")
    assert {r["sub"]: r["vec"] for r in centroids(seeds, ["sub"], "v").collect()} == {"a": [0.5, 0.5], "b": [3.0, 4.0]}
    assert load_centroids(centroids(seeds, ["sub"], "v"), "sub") == [("a", [0.5, 0.5]), ("b", [3.0, 4.0])]


def test_nearest_takes_the_first_label_on_a_tie(spark):
    df = spark.createDataFrame([([1.0, 1.0],)], "v array<double>")
    best = df.select(nearest(F.col("v"), [("b", [1.0, 0.0]), ("a", [0.0, 1.0])]).alias("n")).first()["n"]
    assert best["label"] == "b" and abs(best["margin"]) < 1e-12


def test_cosine_and_decision(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert abs(got[0] - 0.96) < 1e-12 and got[1] is None
    rows = spark.createDataFrame([(0.55, 0.05), (0.549, 0.3), (None, None)], "score double, margin double")
    assert [r[0] for r in rows.select(decide(F.struct("score", "margin"), 0.55, 0.05)).collect()] == [True, False, False]


def test_withdrawals_from_a_table(spark):
    table = spark.createDataFrame([("not_hot", "barely lukewarm"), ("not_hot", "stone cold"), ("overall_praise", "five stars")], "name string, pattern string")
    patterns = taxonomy.load_withdrawals(table)
    assert patterns["battery_praise"] == taxonomy.WITHDRAWALS["battery_praise"]
    rows = [("a", 2, "The mask gets too hot, then stone cold.", *[""] * 5), ("b", 2, "Gets too hot, never too hot.", *[""] * 5)]
    got = {r["Review_ID"]: subs(r["frictions"]) for r in tagging.tag_reviews(reviews(spark, rows), withdrawals=patterns).collect()}
    assert got == {"a": "", "b": "Thermal_Discomfort"}
    with pytest.raises(ValueError):
        taxonomy.load_withdrawals(table.selectExpr("'other' AS name", "pattern"))
