"""Registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import bagminhash, covering, licences, lm, merkle, mixing, neighbours, packing, quality_fm, repeats, sketch, spelling, toxicity
from reviewloom.llm.common import read


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file, which must be the same on every machine."""
    return importlib.import_module("public_tokenizers").path(name)


def op1_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept", "weight")


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(read(spark, sf_dir, "documents"))


def op5_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.held_out_scores(read(spark, sf_dir, "documents"))


def op6_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"), tokenizer_path(), as_loaded=True)


# Shares of the mix by domain; clean documents keep their own tokens and set its size.
DOMAIN_TARGETS = {"clean": 0.97, "low": 0.01, "toxic": 0.02}


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents."""
    domain = F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") <= 0, "low").when(F.col("quality") > 0, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labelled_domains(read(spark, sf_dir, "labels"))
    return mixing.mixing_rates(read(spark, sf_dir, "documents"), labelled, DOMAIN_TARGETS, "clean")


def op8_licence_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(list(licences.TEMPLATES), "template string, text string")
    return licences.found_licences(read(spark, sf_dir, "documents"), templates)


def op9_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_fingerprints(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_letter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_covering_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering.near_duplicates(read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bagminhash,
        op2_learned_partitions,
        op3_quality,
        op4_suffix_array,
        op5_log_bilinear,
        op6_pattern_packing,
        op7_soft_mixing,
        op8_licence_bands,
        op9_bottom_k,
        op10_toxicity,
        op11_letter_counts,
        op12_covering_lsh,
        op13_merkle_manifest,
    )
}
