"""A training corpus from raw documents: quality, near copies, repeated passages, mixture, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame with the
columns of ``documents``; the last returns the packed pieces. ``run`` stores each stage's result as Parquet in
the shared folder and reads it back as the next one's input, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import bagminhash, mixing, packing, quality_fm, repeats
from reviewloom.llm.common import materialise, read
from reviewloom.llm.queries import DOMAIN_TARGETS, labelled_domains, tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject.

    A null text counts as empty, repeated ids are judged row by row, and all columns stay as they are.
    """
    model = quality_fm.quality_model(docs, read(spark, sf_dir, "labels"), F.lit(True))
    score = "_quality"
    while score in (c.lower() for c in docs.columns):
        score += "_"
    return quality_fm.with_quality(docs, model, score).where(F.col(score) >= 0.5).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return bagminhash.deduplicated(docs).select(*docs.columns)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has; ``n_chars`` is that of what is left."""
    beside = F.struct(*[c for c in docs.columns if c != "text"])
    cut = repeats.without_repeats(docs, keep_text=True, beside=beside)
    kept = {c: F.col(f"beside.{c}") for c in docs.columns if c != "text"}
    kept |= {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")}
    return cut.select(*[kept[c].alias(c) for c in docs.columns])


def mixed_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mixture asks for."""
    labelled = labelled_domains(read(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labelled, DOMAIN_TARGETS, "clean")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.packed(docs, tokenizer_path(), as_loaded=True)


STAGES = [
    ("quality classifier", good_quality),
    ("near-duplicate removal", without_near_copies),
    ("repeated-passage removal", without_repeated_passages),
    ("source mixing", mixed_domains),
    ("sequence packing", packed_sequences),
]

# Signatures, models and packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
