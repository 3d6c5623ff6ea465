"""Bounded leaderboard over a count changelog (T6, ST7, ST8, A5).

Two forms:

* exact (:func:`boards`): per board time bucket, the latest value of every
  name changed in the bucket, cut to the best ``n`` (count desc, name asc).
  A grouped aggregate then a per-bucket top-n (WindowGroupLimit), so it scales
  with the number of buckets and never holds a bucket's names in one task.
* incremental (:func:`board_step`): the micro-batch form used by the
  streaming leaderboard. The old board (at most ``n`` rows) and the latest
  values of the batch are merged; incumbents win ties for the last seat (a
  newcomer must be strictly greater than the minimum), and among incumbents
  tied at the minimum the first in name order leaves - the per-record rule,
  which one record per batch reproduces exactly. Names that leave get a 0
  tombstone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .topk import top_k_per_group


def latest_in_bucket(changelog: DataFrame, bucket: str = "1 hour", t: str = "t",
                     key: str = "name", value: str = "count",
                     seq: tuple[str, ...] = ("t", "delta", "id")) -> DataFrame:
    """A6 per board bucket: ``bucket, name, count`` = the last change of the name in it."""
    b = F.date_trunc(_unit(bucket), F.col(t)).alias("bucket")
    order = F.struct(*[F.col(s) for s in seq])
    return changelog.groupBy(b, F.col(key)).agg(F.max_by(value, order).alias(value))


def _unit(bucket: str) -> str:
    """Buckets at least as long as the rolling hour: in a shorter one a name can be
    live without a change, and the last change in the bucket would miss it."""
    units = {"1 hour": "hour", "1 day": "day"}
    if bucket not in units:
        raise ValueError(f"board bucket must be one of {sorted(units)}, not {bucket!r}")
    return units[bucket]


def boards(latest: DataFrame, n: int = 100, bucket: str = "bucket", key: str = "name",
           value: str = "count") -> DataFrame:
    """T6 exact: the best ``n`` names per bucket -> ``bucket, name, count, rank``."""
    return top_k_per_group(latest, bucket, n, value, key, "rank").select(bucket, key, value, "rank")


def _published(board: DataFrame, step: str, bucket: str, key: str, value: str) -> DataFrame:
    """Each seat as its own row and as the 0 that its next bucket publishes unless
    the name is on that board too (``here`` tells them apart)."""
    seats = F.array(F.struct(F.col(bucket).alias("b"), F.col(value).cast("bigint").alias("v"), F.lit(True).alias("here")),
                    F.struct((F.col(bucket) + F.expr(f"INTERVAL {step}")).alias("b"), F.lit(0).cast("bigint").alias("v"),
                             F.lit(False).alias("here")))
    return (board.select(F.col(key), F.explode(seats).alias("s"))
                 .select(key, F.col("s.b").alias(bucket), F.col("s.v").alias(value), F.col("s.here").alias("here")))


def published(board: DataFrame, step: str = "1 hour", bucket: str = "bucket",
              key: str = "name", value: str = "count") -> DataFrame:
    """What the boards publish: every seat, and a 0 for each name that lost its seat
    since the board before -> ``bucket, name, count`` (one row per bucket and name)."""
    p = _published(board, step, bucket, key, value)
    return p.groupBy(bucket, key).agg(F.max_by(value, "here").alias(value))


def tombstones(board: DataFrame, step: str = "1 hour", bucket: str = "bucket",
               key: str = "name", value: str = "count") -> DataFrame:
    """ST8: names on the board of one bucket and not on the next -> count 0.

    One pass over the boards (at most ``n`` rows per bucket) and one aggregate.
    """
    p = _published(board, step, bucket, key, value)
    return (p.groupBy(bucket, key).agg(F.max("here").alias("here"))
             .where(~F.col("here")).select(bucket, key, F.lit(0).cast("bigint").alias(value)))


def board_snapshot(board: DataFrame, step: str = "1 hour", bucket: str = "bucket",
                   key: str = "name", value: str = "count") -> DataFrame:
    """K6: the last published value of every name (zeros kept) and its bucket, one aggregate."""
    p = _published(board, step, bucket, key, value)
    return p.groupBy(key).agg(F.max_by(value, F.struct(bucket, "here")).alias(value), F.max(bucket).alias(bucket))


def board_minimum(board: DataFrame, bucket: str = "bucket", key: str = "name",
                  value: str = "count") -> DataFrame:
    """A5 per bucket: the entry a newcomer would have to beat (smallest count, then name)."""
    pick = F.min_by(F.col(key), F.struct(F.col(value), F.col(key)))
    return board.groupBy(bucket).agg(pick.alias(key), F.min(value).alias(value))


def board_step(old: DataFrame, batch_latest: DataFrame, n: int = 100,
               key: str = "name", value: str = "count") -> tuple[DataFrame, DataFrame]:
    """One incremental leaderboard step -> (new board, changes to publish).

    ``old``: current board (``name, count``, at most ``n`` rows).
    ``batch_latest``: latest value per name in this micro-batch (any size).
    Only the batch's own best ``n`` (TakeOrderedAndProject, distributed) can
    reach the board, so the final ranking sees at most ``2n`` rows.
    Changes = every name of the batch that holds a seat on the new board
    (update or admission) plus a 0 for every incumbent that lost its seat
    (``tombstone`` marks the latter).
    """
    inc = old.select(key, F.col(value).alias("__old"))
    flagged = (batch_latest.select(key, F.col(value).alias(value))
               .join(inc, on=key, how="left")
               .withColumn("__incumbent", F.col("__old").isNotNull())
               .withColumn("__in_batch", F.lit(True)))
    # Seats go by count; at equal count incumbents stay ahead of newcomers (a
    # newcomer must be strictly greater). Among incumbents tied at the bottom,
    # the first name in name order is the one that leaves (names descending);
    # newcomers tied with each other are taken in name order.
    order = [F.desc(value), F.desc("__incumbent"),
             F.when(F.col("__incumbent"), F.col(key)).desc_nulls_last(),
             F.when(~F.col("__incumbent"), F.col(key)).asc_nulls_last()]
    cand = flagged.orderBy(*order).limit(n).drop("__old")
    rest = (old.join(batch_latest.select(key), on=key, how="left_anti")
               .select(key, value, F.lit(True).alias("__incumbent"), F.lit(False).alias("__in_batch")))
    merged = cand.unionByName(rest)
    # At most 2n rows: a single ordered window is bounded here.
    ranked = merged.withColumn("__r", F.row_number().over(Window.orderBy(*order)))
    new_board = ranked.where(F.col("__r") <= n).select(key, value)
    return new_board, board_changes(old, new_board, batch_latest, key, value)


def board_changes(old: DataFrame, new_board: DataFrame, batch_latest: DataFrame,
                  key: str = "name", value: str = "count") -> DataFrame:
    """What one board step publishes: the batch's names that hold a seat on the
    new board, and a 0 tombstone for each incumbent that lost its seat.
    """
    changed = (new_board.join(batch_latest.select(key), on=key, how="left_semi")
                 .select(key, value, F.lit(False).alias("tombstone")))
    evicted = (old.select(key).join(new_board.select(key), on=key, how="left_anti")
                  .select(key, F.lit(0).cast("bigint").alias(value), F.lit(True).alias("tombstone")))
    return changed.unionByName(evicted)
