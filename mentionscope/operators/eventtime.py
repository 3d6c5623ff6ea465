"""Event-time assignment for replayed segments.

A segment holds the lines of 15 minutes. Replaying it, line ``i`` of ``n``
(0-based, file order) gets the time ``start + i * (interval_ms div n)``.
The line index comes from a bucketed row number (input split, or a position
range, as bucket), so a huge segment is numbered by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import record_key
from ..functions.timefuncs import stamp_minute
from .prefix import bucketed_row_number

SEGMENT_MS = 900_000


def _spread(df: DataFrame, segment: str, pos: str, start: Column, interval_ms: int, bucket: Column | None,
            out: str, per_row: bool) -> DataFrame:
    if bucket is None:
        bucket = F.shiftright(F.col(pos), 16)
    start_ms = F.unix_millis(start.cast("timestamp"))
    firsts = {} if per_row else {"__start_ms": start_ms}
    d = df.withColumn("__start_ms", start_ms) if per_row else df
    d = bucketed_row_number(d, [segment], bucket, [F.col(pos)], "__rn", key_total="n_lines", firsts=firsts)
    step = F.expr(f"{int(interval_ms)} div n_lines")
    return (d.withColumn("line_no", F.col("__rn") - 1)
             .withColumn(out, F.timestamp_millis(F.col("__start_ms") + F.col("line_no") * step))
             .drop("__rn", "__start_ms"))


def spread_event_times(df: DataFrame, segment: str, pos: str, start: Column,
                       interval_ms: int = SEGMENT_MS, bucket: Column | None = None,
                       out: str = "event_ts") -> DataFrame:
    """Index rows within their segment and spread them over the interval.

    Adds ``line_no`` (0-based), ``n_lines`` and ``out`` (timestamp, ms precision).
    ``bucket`` must be non-decreasing in ``pos`` within a segment; by default
    ``pos >> 16`` (blocks of 65,536 positions).
    """
    return _spread(df, segment, pos, start, interval_ms, bucket, out, True)


def replay_times(lines: DataFrame, segment: str, pos: str, bucket: Column | None = None,
                 value: str = "value", interval_ms: int = SEGMENT_MS) -> DataFrame:
    """E1 as the replay does it: :func:`spread_event_times` from the minute that the segment's
    first line with a stamp is stamped with (the head of the record key).

    The start is a value of the same pass that numbers the lines, so the lines are read
    once. A segment without any stamp has no start: its lines get no event time. ``pos`` may be a struct.
    """
    return _spread(lines, segment, pos, stamp_minute(record_key(value)), interval_ms, bucket, "event_ts", False)


def segment_rates(df: DataFrame, segment: str, interval_s: int = SEGMENT_MS // 1000) -> DataFrame:
    """E5: rows per segment, the send rate that drains it within one interval
    (``n div seconds``) and the spacing between replayed rows in ms."""
    return (df.groupBy(segment)
              .agg(F.count(F.lit(1)).alias("n_lines"))
              .withColumn("per_second", F.expr(f"n_lines div {int(interval_s)}"))
              .withColumn("step_ms", F.expr(f"{int(interval_s) * 1000} div n_lines")))
