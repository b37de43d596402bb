import pytest
from pyspark.sql import functions as F

from reviewloom.functions import keywords, text


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("<p>Good</p><br/>it", "Good it"),
        ("A&nbsp;B &amp; C", "A B & C"),
        ("&amp;lt;x&amp;gt;", "<x>"),
        ("&lt;b&gt;hi&lt;/b&gt;", "<b>hi</b>"),
        ("It’s “great”", "It's \"great\""),
        ("don´t `x`", "don't 'x'"),
        (" a\n\t  b\x1c ", "a b"),
        ("&quot;q&#39;&apos;", "\"q''"),
        (None, ""),
    ],
)
def test_clean_text(spark, given, wanted):
    assert one(spark, text.clean_text, given) == wanted


@pytest.mark.parametrize(
    "url, wanted",
    [
        ("https://h/gp/customer-reviews/R1AB/ref=cm", "R1AB"),
        ("https://h/gp/customer-reviews/R1AB", ""),
        (None, ""),
    ],
)
def test_review_id(spark, url, wanted):
    assert one(spark, text.review_id, url) == wanted


def test_names(spark):
    assert one(spark, text.asin_from_path, "reviews/B0X1-US-Reviews.csv") == "B0X1"
    assert one(spark, text.asin_from_path, "reviews/B0X1.csv") == "B0X1.csv"
    assert one(spark, text.product_from_name, "a(b)/US(Cervical)-x.csv") == "Cervical"
    assert one(spark, text.product_from_name, "plain.csv") == ""


@pytest.mark.parametrize(
    "title, wanted",
    [
        ("far-infrared red light pad", "FIR"),
        ("red light infrared", "RLT"),
        ("infrared", "Infrared_Only"),
        ("pad", "Other"),
    ],
)
def test_light_type(spark, title, wanted):
    assert one(spark, text.light_type, title) == wanted


def test_title_bullets_and_blank(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("a", "b"), (None, None)], "t string, b string")
    got = [r[0] for r in df.select(text.title_bullets(F.col("t"), F.col("b"))).collect()]
    assert got == ["a", "b", "a;b", ""]
    assert one(spark, text.blank_to_space, "  ") == " "
    assert one(spark, text.blank_to_space, None) == " "
    assert one(spark, text.blank_to_space, " x ") == "x"


def test_keywords_keep_repeats_and_short_domain_words(spark):
    given = "The LED mask, the masks and 12 UV lights are ok; the mask helped two knees"
    assert one(spark, keywords.keyword_bag, given) == "led;mask;mask;uv;light;mask;help;knee"
    assert one(spark, keywords.keyword_bag, None) == ""


def test_large_base_form_table_gives_the_same_words(spark):
    forms = {**keywords.BASE_FORMS, **{f"form{i}": "base" for i in range(keywords.MAX_LITERAL_FORMS)}}
    given = "knees form7 lights helped"
    small = one(spark, lambda c: keywords.keyword_bag(c, forms={"knees": "knee", "lights": "light", "helped": "help", "form7": "base"}), given)
    assert one(spark, lambda c: keywords.keyword_bag(c, forms=forms), given) == small == "knee;base;light;help"


def test_base_forms_of_any_number_give_the_same_words(spark):
    table = spark.range(100_000).select(F.concat(F.lit("Form"), "id").alias("form"), F.concat(F.lit("base"), F.col("id") % 7).alias("base"))
    table = table.unionByName(spark.createDataFrame([("knees", "knee"), ("knees", "leg"), (None, "x"), ("the", "no")], "form string, base string"))
    docs = spark.createDataFrame([(1, "Knees form7 form99999 lights form7"), (2, None), (3, "the 12 form8"), (4, "UV")], "id int, text string")
    want = {1: "knee;base0;base4;lights;base0", 2: "", 3: "base1", 4: "uv"}
    for shared in (1_000, 0):
        got = keywords.with_keywords(docs, "id", "text", table, shared=shared)
        assert {r["id"]: r["keywords"] for r in got.collect()} == want
    assert len(keywords.load_forms(table)) == 100_002
