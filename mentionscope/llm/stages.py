"""Stages of the corpus pipeline: each calls one operator over ``documents`` rows.

Every stage takes (spark, docs, sf_dir) and keeps the columns of documents; the
last one adds what the mix says. Rows are judged by their text (and language),
so null or repeated doc_ids, extra columns and empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam, jaccard, mixing, pii, quality
from .common import bound_batches, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    bound_batches(spark)
    return quality.classify(docs, table(spark, sf_dir, "labels")).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    bound_batches(spark)
    return jaccard.representatives(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    bound_batches(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; n_chars is counted again."""
    return pii.pseudonymise(docs, pii.key_of(spark)).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, numbered in ``copy``."""
    return mixing.repeated(mixing.mix(docs))


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("pii", pseudonyms), ("mix", source_mix)]
