"""Compaction of a streamed folder (K3, ST10): many small files -> few large ones.

A streaming file sink adds one file per partition and micro-batch. ``compact``
copies the files its log has committed and no earlier run has copied into one
run of large files, and then writes the run's ledger (which files it holds).
``read`` takes the runs that have a ledger and the files that are in none, so
each committed file is read once, whatever ended when: a run without its ledger
does not count and is written again, files of an epoch that did not commit are
in neither. The stream's own folder and checkpoint stay as they are, so its
readers and restarts are not touched; how long the sink's log lists a file is
the sink's own ``retention`` option, which should be longer than the time
between two runs. One compaction runs at a time.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from .board import _fs

LEDGER_SCHEMA = "file string"


def _runs(spark: SparkSession, target: str) -> list[str]:
    """The names of the runs whose ledger is complete."""
    fs, path = _fs(spark, os.path.join(target, "ledger"))
    if not fs.exists(path):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n for n in found if fs.exists(_fs(spark, os.path.join(target, "ledger", n, "_SUCCESS"))[1]))


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """``file``: what the runs so far hold."""
    paths = [os.path.join(target, "ledger", n) for n in _runs(spark, target)]
    return spark.read.schema(LEDGER_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], LEDGER_SCHEMA)


def pending(spark: SparkSession, folder: str, schema, target: str) -> list[str]:
    """The committed files of the folder that no run holds (file names only, as Spark's own listing)."""
    held = {r["file"] for r in ledger(spark, target).toLocalIterator()}
    return sorted({unquote(f) for f in spark.read.schema(schema).parquet(folder).inputFiles()} - held)


def _files(spark: SparkSession, folder: str, schema, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], spark.read.schema(schema).parquet(folder).schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(*files)


def compact(spark: SparkSession, folder: str, schema, target: str) -> int:
    """Copy what is pending into a run of its own; returns the number of files copied."""
    files = pending(spark, folder, schema, target)
    if files:
        run = f"run-{len(_runs(spark, target)):08d}"
        # Files of about the advisory partition size, whatever number of small ones they come from.
        (_files(spark, folder, schema, files).hint("rebalance")
         .write.mode("overwrite").parquet(os.path.join(target, "data", run)))
        (spark.createDataFrame([(f,) for f in files], LEDGER_SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(os.path.join(target, "ledger", run)))
    return len(files)


def read(spark: SparkSession, folder: str, schema, target: str) -> DataFrame:
    """All committed rows of the folder: the runs, and the files in none of them."""
    rows = _files(spark, folder, schema, pending(spark, folder, schema, target))
    runs = [os.path.join(target, "data", n) for n in _runs(spark, target)]
    return rows.unionByName(spark.read.schema(rows.schema).parquet(*runs)) if runs else rows
