"""The replay job: text segments -> keyed records with event times.

Each segment file is read as text, malformed UTF-8 dropped, its lines spread
over 15 minutes from the first line's stamp, and written as record files
(``key, value, event_ts``) that :mod:`mentionscope.plans.stream_job` streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import eventtime
from ..sources.text import read_lines, repair_utf8
from ..streaming.sources import record_frame


def replay_records(spark: SparkSession, paths) -> DataFrame:
    """``key, value, partition, event_ts, headers`` of every line of the segments.

    Lines are numbered per file in the order (input split, position), by many tasks
    (one bucket per split). Lines of a file without any stamp get no event time.
    """
    lines = read_lines(spark, paths, with_file=True)
    lines = lines.select(repair_utf8("value").alias("value"), "file", "split", F.struct("split", "pos").alias("at"))
    return record_frame(eventtime.replay_times(lines, "file", "at", F.col("split")))


def write_records(records: DataFrame, out: str, files: int | None = None) -> None:
    """Record files cut by event time (``files`` ranges; default: the session's
    shuffle partitions). Records without an event time cannot be replayed; they go
    to ``out/../<name>-untimed`` in the same layout, so none is lost."""
    timed = records.select("key", "value", "event_ts").where("event_ts IS NOT NULL")
    parts = files or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    timed.repartitionByRange(parts, "event_ts").sortWithinPartitions("event_ts").write.mode("append").parquet(out)
    records.select("key", "value", "event_ts").where("event_ts IS NULL").write.mode("append").parquet(out.rstrip("/") + "-untimed")
