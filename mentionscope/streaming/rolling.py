"""Streaming rolling one-hour counts (ST1-ST6, ST10, ST11).

The streaming twin of the batch changelog
(:func:`mentionscope.operators.rolling.rolling_changelog`): per name, every
mention gives ``+1`` at its event time and ``-1`` one hour later, and each
change is emitted with the running count, ordered per name by
``(t, delta, id)``.

A name is never one key. Its time is cut into buckets, and two stages make
the counts:

* :func:`local_changes` - keyed by (name, bucket). A bucket's changes wait in a
  ``ListState`` that is only appended to, in entries of at most ``chunk``
  changes; no entry is read before the bucket closes. When the watermark has
  passed the bucket's end, nothing can arrive for it any more: its changes are
  sorted, numbered with the running sum *within the bucket* and given out with
  one row for the bucket's total, and the state is cleared. So the changes of a
  hot name are spread over its buckets, by as many tasks as it has buckets open.
* :func:`with_offsets` - keyed by name, but on the totals only (a row per bucket,
  not per mention): a single running number per name gives each bucket its
  offset, which is joined to the bucket's changes on (name, bucket, bucket end).

The bucket width is a parameter: the changes of one name within one bucket are
what one task sorts. A row older than the watermark, or without a time, is not
dropped in silence: the processor sees it (the event-time column is not in its
input, so the engine's own filter passes it on) and gives it out as a reject
with the reason. Kept and rejected rows add up to the input.

``sliding_counts_stream`` (ST4) needs no custom state: a watermark plus a
sliding ``window`` aggregate.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues,
)

from ..operators.rolling import LATE, NO_TIME

# Ship the processor classes with the query plan (pickled by value), so Python
# workers do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOUR_US = 3_600_000_000
SECOND_US = 1_000_000

# kind: "change" (a change with its sum within the bucket), "total" (of a closed
# bucket, in ``n``) or the reason of a reject. ``bucket_end`` carries the event time on.
LOCAL_SCHEMA = "kind string, name string, bucket long, id long, t_us long, delta int, n long, bucket_end timestamp"
OFFSET_SCHEMA = "name string, bucket long, start long, bucket_end timestamp"


class BucketProcessor(StatefulProcessor):
    """Stage 1, per (name, bucket); see the module docstring."""

    def __init__(self, bucket_us: int, chunk: int):
        self.bucket_us = bucket_us
        self.chunk = chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.changes = handle.getListState("changes", "t array<long>, delta array<int>, id array<long>")

    def _rows(self, kind, key, ids, t, delta, n=None) -> pd.DataFrame:
        name, bucket = key
        size = len(ids)
        end = pd.NaT if n is None else pd.Timestamp((bucket + 1) * self.bucket_us, unit="us")
        return pd.DataFrame({"kind": kind, "name": pd.Series([name] * size, dtype=object), "bucket": bucket, "id": pd.array(ids, "Int64"),
                             "t_us": pd.array(t, "Int64"), "delta": pd.array(delta, "Int32"), "n": pd.array([None] * size if n is None else n, "Int64"),
                             "bucket_end": pd.Series([end] * size, dtype="datetime64[us]")})

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        opened = self.changes.exists()
        for pdf in rows:
            ids = pdf["id"].to_numpy(dtype=np.int64)
            if pdf["at_us"].isna().any():           # rows without a time have buckets of their own
                yield self._rows(NO_TIME, key, ids, [None] * len(ids), [None] * len(ids))
                continue
            at = pdf["at_us"].to_numpy(dtype=np.int64)
            t = pdf["t_us"].to_numpy(dtype=np.int64)
            delta = pdf["delta"].to_numpy(dtype=np.int32)
            # Both halves of a mention are judged by the mention's own time.
            late = at < watermark
            told = late & (delta > 0)
            if told.any():
                yield self._rows(LATE, key, ids[told], t[told], delta[told])
            t, delta, ids = t[~late], delta[~late], ids[~late]
            for a in range(0, len(t), self.chunk):
                b = a + self.chunk
                self.changes.appendValue((t[a:b].tolist(), delta[a:b].tolist(), ids[a:b].tolist()))
            if len(t) and not opened:
                self.handle.registerTimer((key[1] + 1) * (self.bucket_us // 1000))
                opened = True

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        parts = list(self.changes.get())
        self.changes.clear()
        if not parts:
            return
        t, delta, ids = (np.concatenate([np.asarray(p[j], dtype=kind) for p in parts])
                         for j, kind in enumerate((np.int64, np.int32, np.int64)))
        order = np.lexsort((ids, delta, t))
        sums = np.cumsum(delta[order].astype(np.int64))
        yield self._rows("change", key, ids[order], t[order], delta[order], sums)
        yield self._rows("total", key, [None], [None], [None], sums[-1:])

    def close(self) -> None:
        pass


class OffsetProcessor(StatefulProcessor):
    """Stage 2, per name: the sum of all closed buckets' totals before each bucket.

    Buckets close in the order of time, so a micro-batch holds only buckets
    behind those of the batches before it.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.running = handle.getValueState("running", "count long")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        totals = pd.concat(list(rows), ignore_index=True).sort_values("bucket", ignore_index=True)
        before = self.running.get()
        sums = (before[0] if before else 0) + totals["n"].to_numpy(dtype=np.int64).cumsum()
        if sums[-1]:
            self.running.update((int(sums[-1]),))
        else:
            self.running.clear()
        yield pd.DataFrame({"name": pd.Series([key[0]] * len(totals), dtype=object), "bucket": totals["bucket"],
                            "start": sums - totals["n"].to_numpy(dtype=np.int64), "bucket_end": totals["bucket_end"]})

    def close(self) -> None:
        pass


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark) -> None:
    """The stateful processor needs the RocksDB state store (several state
    variables per key); set it when the session still has the default store.
    Must run before the query starts; a restarted query keeps its provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if not current or "HDFSBackedStateStoreProvider" in current:
        spark.conf.set(key, ROCKSDB_PROVIDER)


def mention_stream(stream: DataFrame, ts: str = "ts", name: str = "name", id_col: str = "id",
                   delay: str = "0 seconds") -> DataFrame:
    """ST5/ST6: event-time column (``timestamp``) + watermark, and the time as microseconds."""
    return (stream.select(F.col(name).cast("string").alias("name"), F.col(id_col).cast("long").alias("id"),
                          F.col(ts).cast("timestamp").alias("ts"))
                  .withWatermark("ts", delay)
                  .withColumn("t_us", F.unix_micros("ts")))


def local_changes(mentions: DataFrame, span_us: int = HOUR_US, bucket_us: int = HOUR_US, chunk: int = 4096) -> DataFrame:
    """ST2/ST3, stage 1: closed buckets' changes and totals, and rejects (``LOCAL_SCHEMA``; append mode).

    ``mentions`` must come from :func:`mention_stream` (watermarked); ``bucket_us`` is a
    whole number of milliseconds. A live stream wants buckets as short as the rows of the
    hottest name need to spread; a replay of a sparse archive runs faster with an hour.
    """
    if bucket_us % 1000:
        raise ValueError("bucket_us must be a whole number of milliseconds")
    at = F.col("t_us")
    halves = F.array(F.struct(at.alias("t_us"), F.lit(1).alias("delta")),
                     F.struct((at + F.lit(span_us)).alias("t_us"), F.lit(-1).alias("delta")))
    # A row without a time is given out once, from one of many buckets that no time falls into.
    none = F.array(F.struct(at.alias("t_us"), F.lit(1).alias("delta")))
    changes = (mentions.select("name", "id", at.alias("at_us"), F.explode(F.when(at.isNull(), none).otherwise(halves)).alias("c"))
                       .select("name", "id", "at_us", "c.t_us", "c.delta"))
    astray = F.lit(-(1 << 40)) - F.pmod(F.xxhash64("id"), F.lit(1024))
    width = int(bucket_us)
    bucket = F.coalesce(F.expr(f"(t_us - pmod(t_us, {width}L)) div {width}L"), astray)
    return (changes.withColumn("bucket", bucket).groupBy("name", "bucket")
                   .transformWithStateInPandas(BucketProcessor(bucket_us, chunk), LOCAL_SCHEMA, "append", "EventTime"))


def with_offsets(local: DataFrame) -> DataFrame:
    """ST2/ST3, stage 2: the changelog ``name, id, t, delta, count`` from a stream of
    :func:`local_changes` rows (append mode)."""
    timed = local.withWatermark("bucket_end", "0 seconds")
    totals = timed.where("kind = 'total'").select("name", "bucket", "n", "bucket_end")
    starts = (totals.groupBy("name")
                    .transformWithStateInPandas(OffsetProcessor(), OFFSET_SCHEMA, "append", "EventTime",
                                                eventTimeColumnName="bucket_end"))
    changes = timed.where("kind = 'change'").alias("c")
    s = starts.alias("s")
    same = (F.col("c.name").eqNullSafe(F.col("s.name")) & (F.col("c.bucket") == F.col("s.bucket"))
            & (F.col("c.bucket_end") == F.col("s.bucket_end")))
    return changes.join(s, same, "inner").select(
        "c.name", "c.id", F.timestamp_micros("c.t_us").alias("t"), "c.delta", (F.col("s.start") + F.col("c.n")).alias("count"))


def rejects(local: DataFrame) -> DataFrame:
    """ST6: the mentions that :func:`local_changes` did not count -> ``name, id, ts, reason``."""
    return (local.where(F.col("kind").isin(LATE, NO_TIME))
                 .select("name", "id", F.timestamp_micros("t_us").alias("ts"), F.col("kind").alias("reason")))


def sliding_counts_stream(mentions: DataFrame, size: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    """ST4: per-name counts in sliding windows; needs a watermarked ``ts``."""
    w = F.window("ts", size, slide)
    return (mentions.groupBy(w.alias("w"), "name").agg(F.count(F.lit(1)).alias("count"))
                    .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                            "name", "count"))
