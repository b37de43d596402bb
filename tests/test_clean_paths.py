from pyspark.sql import functions as F

from reviewloom.functions.text import clean_text


def test_plain_texts_pass_by_the_search_for_tags_and_entities(spark):
    texts = [
        (None, ""), ("", ""), ("plain  text\n here ", "plain text here"), ("back `quoted` text", "back 'quoted' text"), ("a &amp;lt; b", "a < b"),
        ("one <b>two</b>", "one two"), ("3 < 4", "3 < 4"), ("café ‘x’ “y” `z´", "café 'x' \"y\" 'z'"), ("a b\x1cc", "a b c"),
    ]
    df = spark.createDataFrame(texts, "text string, wanted string").select("wanted", clean_text(F.col("text")).alias("got"))
    assert [(r.wanted, r.got) for r in df.collect() if r.wanted != r.got] == []
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN") < plan.index("translate(")
