"""Streaming sources and sinks.

* File segments (S7, stream form): Spark's file source remembers every file
  it has read in the checkpoint, so a late-arriving older segment is still
  picked up (no high-water mark on names). ``maxFilesPerTrigger`` paces the
  replay one or more segments per micro-batch.
* Topics (S8, S9, K2, K3): thin builders over Spark's Kafka source/sink. The
  Kafka connector is not bundled with PySpark; add the
  ``spark-sql-kafka-0-10`` package to the cluster to use them. The record
  frame contract (``key``, ``value``, ``partition`` and the event time) is
  built by :func:`record_frame` and tested without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import record_key


def file_segment_stream(spark: SparkSession, path: str, schema=None, fmt: str = "parquet",
                        max_files_per_trigger: int = 1) -> DataFrame:
    """Stream new segment files from a folder (every file read once)."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        return (reader.text(path)
                .select("value", F.col("_metadata.file_name").alias("file")))
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    return reader.schema(schema).format(fmt).load(path)


def record_frame(lines: DataFrame, value: str = "value", event_ts: str = "event_ts",
                 partition: int = 0) -> DataFrame:
    """K2: the keyed record of a topic: key = first field, value = whole line.

    Spark's Kafka sink takes no timestamp column, so the event time travels as
    a record header (``headers``) as well as a column for file-based replays.
    """
    ts_ms = F.unix_millis(F.col(event_ts).cast("timestamp"))
    return lines.select(
        record_key(value).alias("key"), F.col(value).alias("value"),
        F.lit(partition).alias("partition"), F.col(event_ts).alias("event_ts"),
        F.array(F.struct(F.lit("event_ts_ms").alias("key"),
                         F.encode(ts_ms.cast("string"), "UTF-8").alias("value"))).alias("headers"))


def kafka_record_stream(spark: SparkSession, servers: str, topic: str,
                        starting_offsets: str = "earliest") -> DataFrame:
    """``key, value, event_ts`` from a topic (S9 uses ``starting_offsets="latest"``).

    The event time is the ``event_ts_ms`` header written by :func:`record_frame`
    when present, else the record's own timestamp - the same contract the
    streaming job reads from file replays.
    """
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
           .option("startingOffsets", starting_offsets).option("includeHeaders", "true").load())
    return decode_records(raw)


def decode_records(raw: DataFrame) -> DataFrame:
    """Kafka source rows (binary key/value, ``timestamp``, ``headers``) ->
    ``key, value, event_ts``."""
    hdr = F.filter("headers", lambda h: h["key"] == "event_ts_ms")
    from_header = F.timestamp_millis(F.get(hdr, 0)["value"].cast("string").try_cast("long"))
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                      F.coalesce(from_header, F.col("timestamp")).alias("event_ts"))


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append"):
    """K2/K3: write ``key``/``value`` (strings) and optional ``headers``/``partition``."""
    cols = [c for c in ("key", "value", "headers", "partition") if c in df.columns]
    return (df.select(*[F.col(c) for c in cols]).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).outputMode(mode))


def changelog_value(df: DataFrame, name: str = "name", count: str = "count") -> DataFrame:
    """K3: a ``(name, count)`` change as a topic record (key = name)."""
    return df.select(F.col(name).alias("key"), F.col(count).cast("string").alias("value"))
