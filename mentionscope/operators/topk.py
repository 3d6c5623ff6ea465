"""Counting, top-k and keyed-table reductions.

Plan shape of the flagship (:func:`daily_top_names`):

    partial count (map side) -> Exchange hash(day, name) -> final count
    -> WindowGroupLimit Partial (k per day per task) -> Exchange hash(day)
    -> WindowGroupLimit Final -> Window row_number -> Filter rank <= k

so the second shuffle carries at most ``k`` rows per day per task, whatever
the number of distinct names, and a hot day or hot name never lands whole in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import all_columns


def count_mentions(m: DataFrame, keys: Sequence[str] = ("day", "name"),
                   out: str = "mentions") -> DataFrame:
    """A1/A2: mentions per key, map-side combined (partial + final aggregate)."""
    return m.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def top_k_per_group(counts: DataFrame, group: Sequence[str] | str, k: int = 10,
                    score: str = "mentions", tie: str = "name", rank: str = "rank") -> DataFrame:
    """T1 core: the ``k`` best rows per group, ties broken by ``tie`` ascending.

    ``row_number() <= k`` directly above the window lets Catalyst insert a
    partial WindowGroupLimit before the shuffle.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(F.desc(score), F.asc(tie))
    return counts.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def daily_top_names(m: DataFrame, k: int = 10, day: str = "day", name: str = "name") -> DataFrame:
    """Per day the ``k`` most-mentioned names -> ``day, name, mentions, rank``."""
    counts = count_mentions(m, (day, name))
    return top_k_per_group(counts, day, k, "mentions", name).select(day, name, "mentions", "rank")


def top_lists(top: DataFrame, group: str = "day", name: str = "name",
              score: str = "mentions", rank: str = "rank") -> DataFrame:
    """A3: fold the (already cut) top rows of each group into one ordered list.

    Runs after the top-k cut, so each list holds at most ``k`` entries.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(name).alias("n"),
                                                   F.col(score).alias("c"))))
    as_pairs = F.transform(entries, lambda e: F.struct(e["n"].alias(name), e["c"].alias(score)))
    return top.groupBy(group).agg(as_pairs.alias("top"))


def by_mentions(counts: DataFrame, name: str = "name", count: str = "mentions") -> DataFrame:
    """All names by ``count`` descending, then name (distributed range sort)."""
    return counts.orderBy(F.desc(count), F.asc(name))


def global_top(counts: DataFrame, n: int, score: str = "mentions",
               tie: Sequence[str] = ("name",)) -> DataFrame:
    """T2 + T3: global descending sort cut at ``n`` (TakeOrderedAndProject:
    each task keeps its own top ``n``, the merge sees ``n`` rows per task)."""
    return counts.orderBy(F.desc(score), *[F.asc(t) for t in tie]).limit(n)


def split_first_n(df: DataFrame, n: int, order: Sequence[str], flag: str = "in_head") -> DataFrame:
    """T4/T5: mark the first ``n`` rows of an ordered queue; the rest follow.

    The head is found with a bounded top-n (no global window): the ``n``
    ordering keys are taken with TakeOrderedAndProject, counted and joined back,
    so no single task sees the whole queue. Equal keys are numbered among
    themselves and no row is repeated. Both sides read one shuffle on the keys,
    so the input is computed once.
    """
    # Structs are equal where their fields are, nulls included. Counted, not row_number():
    # a group limit below one branch's shuffle would make it another shuffle.
    keyed = df.withColumn("__key", F.struct(*order))
    equals = Window.partitionBy("__key").orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queue = keyed.withColumn("__no", F.count(F.lit(1)).over(equals)).where(all_columns(keyed))
    head = (queue.where(F.col("__no") <= n).select(F.col("__key").alias("__h")).orderBy("__h").limit(n)
                 .groupBy("__h").agg(F.count(F.lit(1)).alias("__head")))
    d = queue.join(head, F.col("__key") == F.col("__h"), "left")
    return d.withColumn(flag, F.col("__no") <= F.coalesce("__head", F.lit(0))).drop("__no", "__head", "__key", "__h")


def head_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """T5: first ``n`` rows by position (``head -n``)."""
    return df.orderBy(*order).limit(n)


def latest_per_key(changelog: DataFrame, key: str = "name", value: str = "count",
                   seq: Sequence[str] = ("seq",), out: str | None = None) -> DataFrame:
    """Upsert view of a changelog, the value with the greatest ``seq``.

    ``max_by`` is an ordinary aggregate, so it combines map side: a key with
    millions of updates costs one partial row per task.
    """
    order = F.struct(*[F.col(s) for s in seq]) if len(seq) > 1 else F.col(seq[0])
    return changelog.groupBy(key).agg(F.max_by(value, order).alias(out or value))


def minimum_entry(table: DataFrame, key: str = "name", value: str = "count") -> DataFrame:
    """A5: the entry with the smallest value (ties to the smallest key)."""
    pick = F.min_by(F.struct(F.col(value).alias(value), F.col(key).alias(key)),
                    F.struct(F.col(value), F.col(key)))
    return table.agg(pick.alias("m")).select(f"m.{key}", f"m.{value}")


def distinct_keys(df: DataFrame, group: Sequence[str], key: str = "name",
                  out: str = "n_names", approx: bool = False) -> DataFrame:
    """Number of distinct keys per group (exact, or HyperLogLog++ sketch)."""
    agg = F.approx_count_distinct(key) if approx else F.count_distinct(key)
    return df.groupBy(*group).agg(agg.alias(out))


# ------------------------------------------------- A7: sketches that can be merged
LG_K = 12                   # 2^12 registers: a standard error of 1.6 %


def sketch_keys(df: DataFrame, group: Sequence[str], key: str = "name", out: str = "sketch") -> DataFrame:
    """A7, approximate: a HyperLogLog sketch of the distinct keys per group (null keys do not
    count, as in count distinct). A few kilobytes a group, whatever it holds."""
    return df.groupBy(*group).agg(F.hll_sketch_agg(F.col(key), F.lit(LG_K)).alias(out))


def merge_sketches(sketches: DataFrame, group: Sequence[str], sketch: str = "sketch", out: str = "n_names") -> DataFrame:
    """Estimated distinct keys over any union of sketched groups, without their rows."""
    return sketches.groupBy(*group).agg(F.hll_sketch_estimate(F.hll_union_agg(F.col(sketch))).alias(out))
