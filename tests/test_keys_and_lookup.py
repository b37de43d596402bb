from pyspark.sql import functions as F

from reviewloom.operators import keys
from reviewloom.operators.lookup import CATEGORY_ORDER, PARTS_ORDER, PATTERN_ORDER, first_match, load_lookup

RAW = "Review_ID string, Review_Key string, Rating bigint"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_any_value_skips_missing_and_is_repeatable(spark):
    df = spark.createDataFrame([("r", "B_r", 2), ("r", "A_r", None), ("r", "C_r", 5), ("s", "A_s", None)], RAW)
    for parts in (1, 8):
        got = keys.any_value(df.repartition(parts), "Review_ID", {"Rating": "Rating"}, "Review_Key")
        assert rows(got, "Review_ID") == [("r", 2), ("s", None)]


def test_first_by_key(spark):
    df = spark.createDataFrame([("a", "z", 1.0), ("a", "b", 9.0), ("b", None, 2.0), ("b", "c", 1.0)], "asin string, brand string, price double")
    assert rows(keys.first_by_key(df, "asin", ["brand"]), "asin") == [("a", "b", 9.0), ("b", None, 2.0)]


def test_upsert_and_replace(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    delta = spark.createDataFrame([(2, "b"), (2, "c")], "v int, k string")
    assert rows(keys.upsert(target, delta, "k")) == [("a", 1), ("b", 2), ("c", 2)]
    bridge = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", 3)], "k string, v int")
    new = spark.createDataFrame([("b", 9)], "k string, v int")
    processed = spark.createDataFrame([("b",), ("b",), ("c",)], "k string")
    assert rows(keys.replace_by_key(bridge, new, processed, "k")) == [("a", 1), ("b", 9)]


def test_set_operators(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1)], "k string, v int")
    b = spark.createDataFrame([("x",), ("x",), ("z",)], "k string")
    assert rows(keys.intersect_ids(a, b, "k")) == [("x",)]
    assert rows(keys.restrict(a, b, "k")) == [("x", 1), ("x", 2)]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a bigint, `b c` string")
    assert rows(keys.null_profile(df)) == [("a", "bigint", 2, 1), ("b c", "string", 2, 2)]


def test_hot_keys_are_split_without_loss(spark):
    """A third of all links on one id: same rows as a plain join, and the id is found."""
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    unique = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = keys.hot_keys(many, "k")
    assert hot == [0]
    split = keys.join_split(many, unique, "k", hot)
    assert rows(split) == rows(many.join(unique, "k"))
    assert split.count() == 3000
    assert keys.hot_keys(unique, "k") == []


def lookup(spark, order):
    table = [("P", "Red", "red-2", "2"), ("P", "Red Light", "light-1", "1"), ("P", "lamp", "lamp-10", "10"), ("Q", "red", "q", "1")]
    return load_lookup(spark.createDataFrame(table, "Product string, Term string, Type string, Priority string"), order)


def titles(spark):
    data = [(1, " red light lamp ", " P "), (2, "a lamp", "P"), (3, "red", "Q"), (4, "red", "R"), (5, None, "P"), (6, "Red", "P"), (7, "red light lamp", None)]
    return spark.createDataFrame(data, "id int, title string, product string")


def test_first_match_orders(spark):
    got = {}
    for name, order in (("pattern", PATTERN_ORDER), ("parts", PARTS_ORDER), ("category", CATEGORY_ORDER)):
        df = first_match(titles(spark), lookup(spark, order), "title", "product", "none", "t")
        got[name] = [r["t"] for r in df.orderBy("id").collect()]
    # the test is case-sensitive on the title; the term is lower-cased at load
    assert got["pattern"] == ["light-1", "lamp-10", "q", "none", "none", "none", "none"]
    assert got["parts"] == ["lamp-10", "lamp-10", "q", "none", "none", "none", "none"]
    assert got["category"] == got["parts"]


def test_text_priority_sorts_as_text(spark):
    table = spark.createDataFrame([("P", "x", "two", "2"), ("P", "x", "ten", "10")], "Product string, Term string, Type string, Priority string")
    df = spark.createDataFrame([("x", "P")], "title string, product string")
    got = [first_match(df, load_lookup(table, o), "title", "product", "none", "t").first()["t"] for o in (CATEGORY_ORDER, PARTS_ORDER)]
    assert got == ["ten", "two"]


def test_large_lookup_path_agrees(spark):
    for order in (PATTERN_ORDER, PARTS_ORDER):
        small = first_match(titles(spark), lookup(spark, order), "title", "product", "none", "t")
        large = first_match(titles(spark), lookup(spark, order), "title", "product", "none", "t", limit=0)
        assert rows(small, "id") == rows(large, "id")


def test_automaton_path_agrees(spark):
    for order in (PATTERN_ORDER, PARTS_ORDER):
        scanned = first_match(titles(spark), lookup(spark, order), "title", "product", "none", "t")
        found = first_match(titles(spark), lookup(spark, order), "title", "product", "none", "t", scanned=0)
        assert rows(scanned, "id") == rows(found, "id")


def test_automaton_handles_empty_and_missing_terms(spark):
    table = spark.createDataFrame(
        [("P", "", "anything", "9"), ("P", "lamp", "lamp", "1"), ("P", None, "never", "0"), ("P", "untyped", None, "0"), (None, "lamp", "no product", "0")],
        "Product string, Term string, Type string, Priority string",
    )
    df = spark.createDataFrame([(1, "a lamp", "P"), (2, "other", " P "), (3, None, "P"), (4, "untyped lamp", "P"), (5, "lamp", None), (6, "lamp", "Q")], "id int, title string, product string")
    kinds = {}
    for scanned in (0, 50):
        got = first_match(df, load_lookup(table, PATTERN_ORDER), "title", "product", "none", "t", scanned=scanned)
        kinds[scanned] = [r["t"] for r in got.orderBy("id").collect()]
    assert kinds[0] == kinds[50] == ["lamp", "anything", "anything", "none", "none", "none"]


def test_lookup_of_many_terms(spark):
    terms = spark.range(200_000).select(F.lit("P").alias("Product"), F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("Term"), F.col("id").cast("string").alias("Type"), F.lit("1").alias("Priority"))
    df = spark.range(2000).select("id", F.concat(F.lit("x t"), F.lpad((F.col("id") * 97).cast("string"), 6, "0"), F.lit("t199999 z")).alias("title"), F.lit("P").alias("product"))
    got = first_match(df, load_lookup(terms, PATTERN_ORDER), "title", "product", "none", "t")
    assert got.where(F.col("t") != (F.col("id") * 97).cast("string")).count() == 0
    assert len(got._jdf.queryExecution().toString()) < 20_000
