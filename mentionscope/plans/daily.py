"""The daily top-names job, end to end (entries A and B of the survey).

    read segments (text) -> parse (rdd | ds rules) -> explode names
    -> count per (day, name) -> top-k per day -> write, partitioned by day

The result is written by the executors (K1): no driver collect. With
``lists=True`` each day's entries are also folded into one ordered list
(A3), after the top-k cut.

:func:`run` reads everything. :func:`update` keeps tables under a folder and
reads only segments it has not seen (S7):

* ``items/kind=mention/day=../file=..`` - mentions per name and segment, and
  ``items/kind=reject`` - the lines that the reading rule rejected. A segment
  replaces its own partitions, so one that is read again after a failure
  counts once.
* ``seen`` - the segments read, written after their items.
* ``top/day=..`` - the ranks, with the number of segments that each day's ranks
  were made of. A day is ranked again when its items hold another number, so
  a run that ended between the two writes is made good by the next; days that
  no new segment touches keep their files.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import articles, topk
from ..sources.segments import new_segments
from ..sources.text import read_lines

ITEMS_SCHEMA = "item string, n long, kind string, day date, file string"
TOP_SCHEMA = "name string, mentions long, rank int, segments long, day date"


def daily_top(lines: DataFrame, k: int = 10, mode: str = "rdd") -> DataFrame:
    """T1 over article lines under a reading rule."""
    return topk.daily_top_names(articles.mentions(lines, mode), k=k)


def run(spark: SparkSession, input_glob: str, output: str, k: int = 10, mode: str = "rdd",
        lists: bool = False, rejects_output: str | None = None) -> None:
    """``rejects_output`` receives the counted mentions and rejected lines of the same pass
    (``kind=mention`` and ``kind=reject``); the ranks are then made of the former."""
    lines = read_lines(spark, input_glob)
    if rejects_output:
        items = articles.mentions_and_rejects(lines, mode).groupBy("kind", "day", "item").agg(F.count(F.lit(1)).alias("n"))
        items.write.mode("overwrite").partitionBy("kind").parquet(rejects_output)
        counts = spark.read.parquet(rejects_output).where("kind = 'mention'")
        counts = counts.select("day", F.col("item").alias("name"), F.col("n").alias("mentions"))
        top = topk.top_k_per_group(counts, "day", k)
    else:
        top = daily_top(lines, k, mode)
    if lists:
        top = topk.top_lists(top)
    # One write: each day's rows are small (k), the partition folder is the day.
    top.write.mode("overwrite").partitionBy("day").parquet(output)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def _replace(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``df`` has rows for, leave the others as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def ingest(spark: SparkSession, lines: DataFrame, base: str, mode: str = "rdd") -> None:
    """Counts of whole segments (``file, value``) into the day tables under ``base``."""
    items = articles.mentions_and_rejects(lines, mode, keep=("file",))
    items = items.groupBy("kind", "day", "file", "item").agg(F.count(F.lit(1)).alias("n"))
    # A day's segment is one file; its rows meet in the task that writes it, already counted.
    _replace(items.repartition("kind", "day", "file"), f"{base}/items", "kind", "day", "file")


def rank_days(spark: SparkSession, base: str, k: int = 10) -> None:
    """Rank the days whose items changed since they were ranked."""
    items = _read(spark, f"{base}/items", ITEMS_SCHEMA).where("kind = 'mention'")
    have = items.groupBy("day").agg(F.count_distinct("file").alias("segments"))
    made = _read(spark, f"{base}/top", TOP_SCHEMA).groupBy(F.col("day").alias("__day")).agg(F.max("segments").alias("__made"))
    stale = have.join(made, F.col("day").eqNullSafe(F.col("__day")), "left").where(~F.col("segments").eqNullSafe(F.col("__made")))
    days = [r["day"] for r in stale.select("day").collect()]      # the days that this run touches: partitions to read
    if not days:
        return
    touched = items.where(F.col("day").isin(days)).groupBy("day", F.col("item").alias("name")).agg(F.sum("n").alias("mentions"))
    top = topk.top_k_per_group(touched, "day", k).join(have, "day")
    _replace(top.select("name", "mentions", "rank", "segments", "day"), f"{base}/top", "day")


def update(spark: SparkSession, input_glob: str, base: str, k: int = 10, mode: str = "rdd") -> int:
    """Take the segments under ``input_glob`` that were not seen before into the tables under
    ``base`` and rank the days they touch; returns their number."""
    listed = (spark.read.format("binaryFile").load(input_glob)      # the listing: contents are not read
              .select(F.col("path"), F.element_at(F.split("path", "/"), -1).alias("file_name")))
    seen = _read(spark, f"{base}/seen", "file_name string")
    new = new_segments(listed, seen).collect()                      # paths to read, as the reader's own listing holds them
    if new:
        lines = read_lines(spark, [r["path"] for r in new], with_file=True).select("file", "value")
        ingest(spark, lines, base, mode)
        (spark.createDataFrame([(r["file_name"],) for r in new], "file_name string").coalesce(1)
              .write.mode("append").parquet(f"{base}/seen"))
    rank_days(spark, base, k)
    return len(new)


def top_table(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, f"{base}/top", TOP_SCHEMA).select("day", "name", "mentions", "rank")


def rejected(spark: SparkSession, base: str) -> DataFrame:
    """Rejected lines -> ``file, line, n`` (how often the line stands in its segment)."""
    return (_read(spark, f"{base}/items", ITEMS_SCHEMA).where("kind = 'reject'")
            .select("file", F.col("item").alias("line"), "n"))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Top-k most-mentioned names per day")
    ap.add_argument("input", help="glob of TAB separated segment files")
    ap.add_argument("output", help="output folder (parquet, partitioned by day); with --update the tables' folder")
    ap.add_argument("--k", type=int, default=10)
    ap.add_argument("--mode", choices=["rdd", "ds", "stream"], default="rdd")
    ap.add_argument("--lists", action="store_true")
    ap.add_argument("--rejects", default=None)
    ap.add_argument("--update", action="store_true", help="only segments not seen before")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("mentionscope-daily").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if a.update:
        update(spark, a.input, a.output, a.k, a.mode)
    else:
        run(spark, a.input, a.output, a.k, a.mode, a.lists, a.rejects)


if __name__ == "__main__":
    main()
