"""The streaming job, end to end (entry C of the survey).

Query 1: record stream -> names (stream rule) -> per (name, time bucket) the
changes of closed buckets and their totals, and the rejected mentions -> ``local``.
Query 2: ``local`` -> each bucket's offset from the totals -> exact rolling
one-hour changelog -> ``changelog``.
Query 3: ``changelog`` -> leaderboard and feed (``foreachBatch``).
Query 4: ``feed/changes`` -> the last published value per name (what a new
subscriber receives), kept as keyed state.

Records are ``key, value, event_ts`` (the record frame written by the replay
producer, or a topic read with the event time taken from the record). All
queries checkpoint under ``base``; restarting with the same ``base`` resumes.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import articles
from ..streaming import board as sboard
from ..streaming import compaction
from ..streaming import rolling as srl

CHANGELOG_SCHEMA = "name string, id long, t timestamp, delta int, count long"


def record_mentions(records: DataFrame) -> DataFrame:
    """ST1 + P6: keyed records -> ``id, ts, name`` (one row per mention).

    The record key ``stamp-seq`` is hashed to a stable long id (mentions of
    one record share it; equal rows are interchangeable in the changelog).
    """
    m = articles.explode_names(
        articles.parse_articles(records, "stream", keep=("event_ts",)), "stream", keep=("key", "event_ts"))
    return m.select(F.xxhash64("key").alias("id"), F.col("event_ts").alias("ts"), "name")


def start_local(spark: SparkSession, records: DataFrame, base: str, delay: str = "15 minutes",
                trigger: dict | None = None, bucket_us: int = 60_000_000):
    """Query 1: records -> closed buckets' changes and totals, and rejects, in ``base/local``.

    ``bucket_us`` is the width of a name's time buckets (see :mod:`mentionscope.streaming.rolling`):
    short for live streams with hot names, an hour for replaying a sparse archive.
    """
    srl.use_rocksdb_state(spark)
    mentions = srl.mention_stream(record_mentions(records), delay=delay)
    return (srl.local_changes(mentions, bucket_us=bucket_us).writeStream.format("parquet")
            .option("path", os.path.join(base, "local"))
            .option("checkpointLocation", os.path.join(base, "ck-local")).partitionBy("kind")
            .outputMode("append").trigger(**(trigger or {"processingTime": "1 second"})).start())


def start_changelog(spark: SparkSession, base: str, trigger: dict | None = None):
    """Query 2: ``base/local`` -> exact rolling changelog in ``base/changelog``."""
    srl.use_rocksdb_state(spark)
    local = spark.readStream.schema(srl.LOCAL_SCHEMA).parquet(os.path.join(base, "local"))
    return (srl.with_offsets(local).writeStream.format("parquet")
            .option("path", os.path.join(base, "changelog"))
            .option("checkpointLocation", os.path.join(base, "ck-changelog"))
            .outputMode("append").trigger(**(trigger or {"processingTime": "1 second"})).start())


def compact_changelog(spark: SparkSession, base: str) -> int:
    """Copy the changelog's small files since the last run into large ones; the streams go on meanwhile."""
    return compaction.compact(spark, os.path.join(base, "changelog"), CHANGELOG_SCHEMA, os.path.join(base, "changelog-runs"))


def changelog(spark: SparkSession, base: str) -> DataFrame:
    """The whole changelog so far, from the large files where there are some."""
    return compaction.read(spark, os.path.join(base, "changelog"), CHANGELOG_SCHEMA, os.path.join(base, "changelog-runs"))


def rejected(spark: SparkSession, base: str) -> DataFrame:
    """ST6: mentions that were late or had no time so far -> ``name, id, ts, reason``."""
    return srl.rejects(spark.read.schema(srl.LOCAL_SCHEMA).parquet(os.path.join(base, "local")))


def start_board(spark: SparkSession, base: str, n: int = 100, trigger: dict | None = None,
                max_files_per_trigger: int | None = None):
    """Query 2: changelog folder -> leaderboard, feed messages and snapshot."""
    reader = spark.readStream.schema(CHANGELOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    changes = reader.parquet(os.path.join(base, "changelog"))
    return sboard.start_leaderboard(changes, os.path.join(base, "state"), os.path.join(base, "feed"),
                                    os.path.join(base, "ck-board"), n=n,
                                    trigger=trigger or {"processingTime": "1 second"})


def start_snapshot(spark: SparkSession, base: str, trigger: dict | None = None):
    """Query 4: published changes -> the last value of every name."""
    return sboard.start_snapshot(spark, os.path.join(base, "feed"), os.path.join(base, "ck-snapshot"),
                                 trigger=trigger or {"processingTime": "1 second"})


def start(spark: SparkSession, records: DataFrame, base: str, delay: str = "15 minutes",
          n: int = 100, trigger: dict | None = None, bucket_us: int = 60_000_000) -> list:
    """Start all queries, in the order of the data."""
    for folder in ("local", "changelog", "feed/changes"):     # file sources need their folders to exist
        fs, path = sboard._fs(spark, os.path.join(base, folder))
        fs.mkdirs(path)
    return [start_local(spark, records, base, delay, trigger, bucket_us), start_changelog(spark, base, trigger),
            start_board(spark, base, n, trigger), start_snapshot(spark, base, trigger)]


def run_available(spark: SparkSession, records: DataFrame, base: str, delay: str = "15 minutes",
                  n: int = 100, bucket_us: int = 60_000_000) -> None:
    """Process what is there, one query after the other, then stop."""
    now = {"availableNow": True}
    for begin in (lambda: start_local(spark, records, base, delay, now, bucket_us), lambda: start_changelog(spark, base, now),
                  lambda: start_board(spark, base, n, now), lambda: start_snapshot(spark, base, now)):
        begin().awaitTermination()
