"""Segment discovery.

Segments are 15-minute files ``yyyyMMddHHmm00.gkg.csv``. Discovery is table
work: a manifest is a text table, the wanted list is a ``sequence`` of
quarter-hours, and "new files" is an anti-join against the files already
ingested (every seen file is remembered, not only the newest name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import DEFAULT_LAST_KEY
from ..functions.timefuncs import segment_name, segment_window
from .text import numbered_lines

# ---- fixed values ------------------------------------------------------------
MANIFEST_PATH_PATTERN = r"/v2/gkg/[0-9]*\.gkg\.csv"
MANIFEST_NAME_PATTERN = r"[0-9]*\.gkg\.csv"
# ---- end of fixed values -----------------------------------------------------


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest text file as ``pos, line`` (pos = number of the line in the file, from 1)."""
    return numbered_lines(spark, path).select(F.col("line_no").alias("pos"), F.col("value").alias("line"))


def manifest_head(manifest: DataFrame, n: int, pos: str = "pos", line: str = "line") -> DataFrame:
    """The first ``n`` manifest lines -> ``pos, bucket_path, file_name``.

    ``orderBy(pos).limit(n)`` is a distributed top-n; the extraction runs on
    those ``n`` rows only.
    """
    head = manifest.orderBy(pos).limit(n)
    return head.select(pos,
                       F.regexp_extract(line, MANIFEST_PATH_PATTERN, 0).alias("bucket_path"),
                       F.regexp_extract(line, MANIFEST_NAME_PATTERN, 0).alias("file_name"))


def wanted_segments(now_df: DataFrame, now: str = "now", window_minutes: int = 60) -> DataFrame:
    """For each ``now``, the segment names covering the last ``window_minutes``."""
    return (now_df.select("*", F.explode(segment_window(F.col(now), window_minutes)).alias("segment_start"))
                  .withColumn("file_name", segment_name(F.col("segment_start"))))


def new_segments(listed: DataFrame, seen: DataFrame, file: str = "file_name") -> DataFrame:
    """S7 (batch form): listed files that were never ingested.

    An anti-join on the file name: unlike a high-water mark on names, a late
    file older than the newest seen one is still picked up.
    """
    return listed.join(seen.select(file).distinct(), on=file, how="left_anti")


def after_high_water_mark(listed: DataFrame, last_file: str, file: str = "file_name") -> DataFrame:
    """S7 (the feed's original rule, F12): only names after the newest file seen.

    Kept for comparison: a segment that arrives after a newer one was already
    taken is skipped here, while :func:`new_segments` still reports it.
    """
    return listed.where(F.col(file) > F.lit(last_file))


def after_marks(listed: DataFrame, marks: DataFrame, feed: str = "feed", file: str = "file_name",
                mark: str = "mark") -> DataFrame:
    """F12 for several feeds: per feed, the listed names after its own newest seen one
    (``marks``: one row per feed). A feed without a mark has seen nothing, so all is new."""
    m = marks.select(F.col(feed).alias("__feed"), mark)
    new = listed.join(m, F.col(feed).eqNullSafe(F.col("__feed")), "left").where(F.col(mark).isNull() | (F.col(file) > F.col(mark)))
    return new.drop("__feed", mark)


def last_key(log: DataFrame, key: str = "key", offset: str = "offset",
             default: str = DEFAULT_LAST_KEY) -> DataFrame:
    """Key of the last record of a log, or the default when it is empty."""
    return log.agg(F.coalesce(F.max_by(key, offset), F.lit(default)).alias("last_key"))


def last_keys(log: DataFrame, topics: DataFrame, topic: str = "topic", key: str = "key", offset: str = "offset",
              default: str = DEFAULT_LAST_KEY) -> DataFrame:
    """S11/F14 for many logs: per row of ``topics`` the key of its log's last record, or the
    default for a log without records -> ``topic, last_key``."""
    last = log.groupBy(F.col(topic).alias("__topic")).agg(F.max_by(key, offset).alias("last_key"))
    d = topics.select(topic).join(last, F.col(topic).eqNullSafe(F.col("__topic")), "left")
    return d.select(topic, F.coalesce("last_key", F.lit(default)).alias("last_key"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union of several inputs with the same columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
