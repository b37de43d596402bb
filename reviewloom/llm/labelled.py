"""Bounded, repeatable samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import materialise, narrowed


def labelled_ids(labels: DataFrame, label: str, train: Column) -> DataFrame:
    """(doc_id, y) of all labelled ids inside the training fold.

    Rows without id or label are left out; where an id has several labels, the largest counts.
    """
    wanted = narrowed(labels, "doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & train)
    return wanted.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, *extra, y) of at most ``bound`` labelled documents inside the training fold.

    The documents are those whose ids hash lowest, so the sample does not depend on how files are split.
    """
    chosen = labelled_ids(labels, label, train)
    chosen = materialise(chosen.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(bound), "labelled")
    # at most ``bound`` ids, so the broadcast is bounded by the parameter
    return narrowed(docs, "doc_id", "text", *extra).join(F.broadcast(chosen), "doc_id")
