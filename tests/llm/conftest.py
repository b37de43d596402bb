import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parent.parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """Whole texts of the smallest scale, and rows for every defined case."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
    rows += [
        (100_001, None),
        (100_002, ""),
        (100_003, " \t\n"),
        (100_004, "one"),
        (100_005, "one two three four"),
        (100_006, "one two three four"),
        (100_007, long),
        (100_008, long + " and a little more"),
        (100_009, "aaaa " * 400),
        (100_010, "漢字とかな" * 60),
        (100_011, "漢字とかな" * 60 + "。"),
    ]
    return rows


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def odd(spark, rows):
    """The rows with columns whose names operators use themselves, in several partitions."""
    wide = [(i, t, "x", 1.5, "y", 7, None) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id bigint, text string, node string, score double, class_id string, `key` int, lang string").repartition(3)
