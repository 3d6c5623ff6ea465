"""Rolling one-hour mention counts in batch (E3, E4) and sliding windows (ST4).

Semantics (decided once, tested):

* E4 changelog: every mention gives ``+1`` at its time ``t`` and ``-1`` at
  ``t + span``; rows are ordered per name by ``(t, delta, id)`` - at equal
  time the expiry (-1) comes first - and each row carries the running count.
  The count never goes below 0 and ends at 0.
* E3 rolling count read at each mention: mentions of the same name with time
  in ``[ts - span, ts]`` (closed start, peers at equal time included), the
  ``RANGE BETWEEN span PRECEDING AND CURRENT ROW`` window.
* A mention without a time has no place in either; :func:`untimed` returns
  these with the reason, so kept and rejected rows add up to the input.

A name is split into buckets of one ``span``. A mention of one bucket expires
in the next, so the mentions live at the start of a bucket are exactly those
that expire within it: each (name, bucket) finds its own starting count among
its rows. One scan, one shuffle, one window pass, no join.

A name that is hot *within* a span is split further at equi-depth points of
its time (``splits``, from :func:`hot_splits`), and the sub-buckets' offsets
come from :func:`~mentionscope.operators.prefix.bucketed_running_sum`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import bucketed_running_sum, split_bucket, split_points

HOUR_US = 3_600_000_000

# Why a mention has no place in the counts.
LATE, NO_TIME = "late", "no time"


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def untimed(df: DataFrame, ts: str = "ts", key: str = "name", id_col: str = "id") -> DataFrame:
    """The mentions that E3 and E4 cannot place -> ``key, id, ts, reason``."""
    return df.where(F.col(ts).isNull()).select(key, id_col, ts, F.lit(NO_TIME).alias("reason"))


def late(df: DataFrame, batch: str, ts: str = "ts", delay_us: int = 0) -> DataFrame:
    """ST6 (batch twin): adds ``late``, whether a row is older than the watermark that its
    micro-batch meets: the largest time in the batches before it less ``delay_us``.

    ``batch`` numbers the micro-batches. One row per batch is numbered in one window; null times are not late.
    """
    t = _micros(ts)
    tops = df.groupBy(batch).agg(F.max(t).alias("__top"))
    before = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    marks = tops.select(F.col(batch).alias("__batch"), (F.max("__top").over(before) - F.lit(delay_us)).alias("__mark"))
    d = df.join(marks, F.col(batch).eqNullSafe(F.col("__batch")), "left")
    return d.withColumn("late", F.coalesce(t < F.col("__mark"), F.lit(False))).drop("__batch", "__mark")


def _changes(df: DataFrame, ts: str, key: str, id_col: str, span_us: int) -> DataFrame:
    """The +1 / -1 change rows of every mention that has a time, generated from one scan,
    each with the number of its ``span``."""
    t = _micros(ts)
    pair = F.array(F.struct(t.alias("t"), F.lit(1).alias("d")),
                   F.struct((t + F.lit(span_us)).alias("t"), F.lit(-1).alias("d")))
    c = (df.where(F.col(ts).isNotNull())
           .select(F.col(key).alias(key), F.col(id_col).alias(id_col), F.explode(pair).alias("__c"))
           .select(key, id_col, F.col("__c.t").alias("__t"), F.col("__c.d").alias("delta")))
    return c.withColumn("__span", F.expr(f"(__t - pmod(__t, {int(span_us)}L)) div {int(span_us)}L"))


def hot_splits(df: DataFrame, rows: int, ts: str = "ts", key: str = "name", id_col: str = "id",
               span_us: int = HOUR_US) -> DataFrame:
    """Cut points for names with more than ``rows`` changes within one span -> ``key, __span, edges``."""
    return split_points(_changes(df, ts, key, id_col, span_us), [key, "__span"], "__t", rows)


def _running(ch: DataFrame, key: str, order: list[Column], peers: bool, splits: DataFrame | None) -> DataFrame:
    """Adds ``count``, the running sum of ``delta`` per key in ``order``."""
    if splits is not None:
        cut = split_bucket(ch, [key, "__span"], "__t", splits, "__sub")
        return bucketed_running_sum(cut, [key], F.struct("__span", "__sub"), order, "delta", "count", peers=peers)
    w = Window.partitionBy(key, "__span").orderBy(*order)
    first, last, here = Window.unboundedPreceding, Window.unboundedFollowing, Window.currentRow
    so_far = w.rangeBetween(first, here) if peers else w.rowsBetween(first, here)
    live = F.sum(F.when(F.col("delta") < 0, 1).otherwise(0)).over(w.rowsBetween(first, last))
    return ch.withColumn("count", (live + F.sum("delta").over(so_far)).cast("bigint"))


def rolling_changelog(df: DataFrame, ts: str = "ts", key: str = "name", id_col: str = "id",
                      span_us: int = HOUR_US, splits: DataFrame | None = None) -> DataFrame:
    """The full rolling changelog -> ``key, id, t, delta, count``."""
    ch = _changes(df, ts, key, id_col, span_us)
    out = _running(ch, key, [F.col("__t"), F.col("delta"), F.col(id_col)], False, splits)
    return out.select(key, id_col, F.timestamp_micros(F.col("__t")).alias("t"),
                      F.col("delta").cast("int").alias("delta"), "count")


def rolling_counts(df: DataFrame, ts: str = "ts", key: str = "name", id_col: str = "id",
                   span_us: int = HOUR_US, closed_start: bool = True, splits: DataFrame | None = None) -> DataFrame:
    """Per mention, the number of mentions of its name in the hour up to it.

    ``closed_start=True``: ``[ts - span, ts]`` (the RANGE ... PRECEDING window);
    ``False``: ``(ts - span, ts]``, the changelog's rule (an expiry at ``ts``
    applies before the mentions at ``ts``). Peers at equal time are included.

    Running sum of the +1/-1 changes with RANGE peers: at a mention's time
    ``t`` that is ``#(ts' <= t) - #(ts' + span < t)`` (closed; the additions
    sort first at equal time) or ``- #(ts' + span <= t)`` (half-open).
    """
    ch = _changes(df, ts, key, id_col, span_us)
    order = [F.col("__t"), F.col("delta").desc()] if closed_start else [F.col("__t")]
    out = _running(ch, key, order, True, splits)
    return (out.where(F.col("delta") == 1)
               .select(key, id_col, F.timestamp_micros(F.col("__t")).alias(ts), "count"))


def sliding_counts(df: DataFrame, ts: str = "ts", key: str = "name",
                   size: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    """ST4 (batch twin): counts per name in hour windows sliding every 15 minutes.

    Each row is expanded into ``size/slide`` windows and counted with a
    partial/final aggregate; no per-key state.
    """
    w = F.window(F.col(ts).cast("timestamp"), size, slide)
    return (df.groupBy(w.alias("w"), F.col(key))
              .agg(F.count(F.lit(1)).alias("count"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      key, "count"))
