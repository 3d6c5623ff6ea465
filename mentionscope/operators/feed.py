"""Update messages for subscribers.

* K4 :func:`json_messages` - a set of ``(name, count)`` entries folded into
  one JSON array text ``[{"name":..,"count":..},..]`` per group, in a given
  order. With ``max_entries`` every group is cut by position into chunks of so
  many entries, for groups without a bound of their own.
* K5 :func:`conflated_feed` - per flush interval (1 s), only the last value
  of each name, in first-seen order.
* K6 :func:`snapshot` - the last value of every name ever touched (zeros
  included): what a new subscriber receives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import bucketed_row_number


def json_entry(name: Column, count: Column) -> Column:
    """one ``{"name": .., "count": ..}`` object."""
    return F.to_json(F.struct(name.alias("name"), count.alias("count")))


def json_messages(entries: DataFrame, group: Sequence[str], order: Sequence[str],
                  name: str = "name", value: str = "count", max_entries: int | None = None,
                  bucket: Column | None = None, out: str = "message", bounded: bool = False) -> DataFrame:
    """K4: ``*group, chunk, n_entries, message`` with entries in ``order``.

    Without ``max_entries`` a group is one message (chunk 0), for groups of a
    known bound such as a board of ``n`` rows: one aggregate. With it, a
    bucketed row number over every group (``bucket`` non-decreasing in
    ``order``, required) gives ``chunk = (pos - 1) div max_entries``; groups of a
    known bound (``bounded``) are numbered by one window each.
    """
    group = list(group)
    if max_entries is None:
        allrows = entries.withColumn("chunk", F.lit(0))
    else:
        if bounded:
            allrows = entries.withColumn("__pos", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        elif bucket is None:
            raise ValueError("max_entries needs a bucket that does not decrease in the order")
        else:
            allrows = bucketed_row_number(entries, group, bucket, [F.col(o) for o in order], "__pos")
        allrows = (allrows.withColumn("chunk", F.floor((F.col("__pos") - 1) / F.lit(max_entries)).cast("int"))
                          .drop("__pos"))
    key = F.struct(*[F.col(o).alias(f"k{i}") for i, o in enumerate(order)], F.col(name).alias("kn"))
    items = F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col(name).alias("name"),
                                                 F.col(value).alias("count"))))
    body = F.transform(items, lambda e: F.struct(e["name"].alias("name"), e["count"].alias("count")))
    return (allrows.groupBy(*group, "chunk")
                   .agg(body.alias("__items"), F.count(F.lit(1)).alias("n_entries"))
                   .select(*group, "chunk", "n_entries", F.to_json("__items").alias(out)))


def conflate(changelog: DataFrame, every: str = "1 second", t: str = "t", key: str = "name",
             value: str = "count", seq: Sequence[str] = ("t", "delta", "id")) -> DataFrame:
    """K5 entries: per interval the last value per name and where it was first seen.

    A grouped aggregate (combines map side): ``slot, name, count, first_seq``.
    """
    slot = F.window(F.col(t), every).start.alias("slot")
    order = F.struct(*[F.col(s) for s in seq])
    return (changelog.groupBy(slot, F.col(key))
                     .agg(F.max_by(value, order).alias(value), F.min(order).alias("first_seq")))


def conflated_feed(changelog: DataFrame, max_entries: int, every: str = "1 second", t: str = "t",
                   key: str = "name", value: str = "count",
                   seq: Sequence[str] = ("t", "delta", "id"), bounded: bool = False) -> DataFrame:
    """K5: messages per interval, ``max_entries`` names each at most, in first-seen order
    (``bounded``: an interval has few names, such as a board's seats)."""
    e = conflate(changelog, every, t, key, value, seq)
    e = e.select("slot", key, value, *[F.col("first_seq")[s].alias(f"__f{i}") for i, s in enumerate(seq)])
    order = [f"__f{i}" for i in range(len(seq))]
    return json_messages(e, ["slot"], order, key, value, max_entries,
                         bucket=F.floor(F.unix_micros(F.col("__f0").cast("timestamp")) / F.lit(1000)), bounded=bounded)


def snapshot(changelog: DataFrame, key: str = "name", value: str = "count",
             seq: Sequence[str] = ("t", "delta", "id")) -> DataFrame:
    """K6: last value per name ever touched (zeros included)."""
    order = F.struct(*[F.col(s) for s in seq])
    return changelog.groupBy(key).agg(F.max_by(value, order).alias(value))
