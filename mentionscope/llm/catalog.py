"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cover_tree, decontam, html_text, jaccard, licenses, lm, merkle, mixing, phrases, pii, quality, suffix_dedup, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn
    return deco


@query(mixing.ORACLE_SQL)
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document by the mix of all sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and unigram scores of every document."""
    return lm.score(table(spark, sf_dir, "documents"))


@query()
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and its place."""
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels and phrase places of each document."""
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("places")


@query(jaccard.ORACLE_SQL)
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and component of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from each document and the digest of what remains."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept")


@query(cover_tree.ORACLE_SQL)
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity, threshold and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "lang", "n_tokens", "perplexity", "threshold", "kept")


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced by pseudonyms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = F.transform("pii", lambda p: p["kind"])
    return pii.pseudonymise(docs, pii.key_of(spark)).select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"),
                                         F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias("kinds"))


@query(merkle.ORACLE_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, proof and check of every document in the dataset's Merkle manifest."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query(phrases.ORACLE_SQL)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of every language."""
    return phrases.top_collocations(table(spark, sf_dir, "documents"))


@query(warc.ORACLE_SQL)
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, written to WARC archives and read back."""
    return warc.archived(table(spark, sf_dir, "pages"))
