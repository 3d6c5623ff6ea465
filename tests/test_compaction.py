"""Compaction of a streamed folder: the same rows from fewer files, over restarts and ended runs."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from mentionscope.plans import stream_job
from mentionscope.streaming import compaction

SF = "/root/testdata/sf0.001"
SCHEMA = stream_job.CHANGELOG_SCHEMA


@pytest.fixture()
def changes(spark):
    """Changelog rows from the events table, null names and times among them."""
    e = spark.read.parquet(f"{SF}/events.parquet")
    cols = e.columns
    return e.select(F.when(F.xxhash64(cols[0]) % 10 != 0, F.concat(F.lit("n"), F.pmod(F.xxhash64(cols[0]), F.lit(50)))).alias("name"),
                    F.xxhash64(*cols[:2]).alias("id"), F.timestamp_millis(F.pmod(F.xxhash64(cols[0]), F.lit(10 ** 12))).alias("t"),
                    F.lit(1).alias("delta"), F.pmod(F.xxhash64(cols[0]), F.lit(9)).alias("count"))


def stream(spark, source, base):
    """Every file of ``source`` a micro-batch of its own, into ``base/changelog``."""
    (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
     .writeStream.format("parquet").option("path", f"{base}/changelog").option("checkpointLocation", f"{base}/ck")
     .trigger(availableNow=True).start().awaitTermination())


def rows(df):
    return sorted(map(repr, df.select("name", "id", "t", "delta", "count").collect()))


def test_compacted_changelog_equals_the_folder(spark, changes, scratch):
    source, base = f"{scratch}/in", f"{scratch}/base"
    half = F.pmod("id", F.lit(2)) == 0
    changes.where(half).repartition(6).write.parquet(source)
    stream(spark, source, base)
    assert rows(stream_job.changelog(spark, base)) == rows(changes.where(half))
    assert stream_job.compact_changelog(spark, base) >= 6 and stream_job.compact_changelog(spark, base) == 0
    # All rows come from the run now, which has fewer files.
    read = stream_job.changelog(spark, base)
    assert rows(read) == rows(changes.where(half)) and len(read.inputFiles()) < 6
    assert all("changelog-runs" in f for f in read.inputFiles())
    # The stream goes on from its checkpoint; new files are read beside the run.
    changes.where(~half).repartition(4).write.mode("append").parquet(source)
    stream(spark, source, base)
    assert rows(stream_job.changelog(spark, base)) == rows(changes)
    # A run that ended before its ledger does not count, and is written again.
    shutil.copytree(f"{base}/changelog-runs/data/run-00000000", f"{base}/changelog-runs/data/run-00000001")
    os.makedirs(f"{base}/changelog-runs/ledger/run-00000001")
    assert rows(stream_job.changelog(spark, base)) == rows(changes)
    # A file of an epoch that did not commit is not copied.
    shutil.copy(glob.glob(f"{base}/changelog/*.parquet")[0], f"{base}/changelog/part-99999-stray.parquet")
    assert stream_job.compact_changelog(spark, base) >= 4
    assert rows(stream_job.changelog(spark, base)) == rows(changes)
    assert compaction.ledger(spark, f"{base}/changelog-runs").where("file LIKE '%stray%'").count() == 0


def test_partitioned_and_empty_folders(spark, changes, scratch):
    folder, target = f"{scratch}/p", f"{scratch}/runs"
    os.makedirs(folder)
    schema = SCHEMA + ", kind string"
    assert compaction.compact(spark, folder, schema, target) == 0
    assert compaction.read(spark, folder, schema, target).count() == 0
    kinds = changes.withColumn("kind", F.when(F.col("count") < 4, "a b").when(F.col("count") < 8, "c:d"))
    kinds.write.mode("overwrite").partitionBy("kind").parquet(folder)
    assert compaction.compact(spark, folder, schema, target) > 0
    got, want = (sorted((r["kind"] or "", r["n"]) for r in df.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect())
                 for df in (compaction.read(spark, folder, schema, target), kinds))
    assert got == want
