"""Exact running sums that do not put a whole key into one task.

A plain ``sum(x) OVER (PARTITION BY key ORDER BY t)`` sends every row of a
key to one task. When one key (a hot name, a huge segment) holds a third of
the data, that task holds a third of the data. Instead we run a two-level
scan:

1. split each key into ordered buckets (``bucket`` must be non-decreasing in
   the sort order within a key: a time slot, an input split, or equi-depth
   ranges from :func:`split_points`) and shuffle on (key, bucket);
2. one window pass per (key, bucket): the running sum, and a mark on the
   last row, whose running sum is the bucket's total;
3. a running sum of the marked rows over the buckets of a key gives each
   bucket's offset (one row per bucket, so a hot key costs one row per bucket);
4. join the offsets back on (key, bucket): the big side is already
   partitioned on exactly those columns, so only the small side moves.

Steps 2 and 3 read the same exchange. Spark shares an exchange only between
branches that need the same columns, so both name all of them
(:func:`all_columns`); the input is then computed once, however dear it is.

The result equals the single-partition window for any data layout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

_B = "__bucket"
_LOCAL = "__local"
_LAST = "__last"
_OFF = "__offset"
_KEYTOT = "__keytotal"


def all_columns(df: DataFrame) -> Column:
    """True for every row (a hash is never below the least int), and needs every column
    of ``df``: column pruning then leaves the shuffles below two branches equal."""
    cols = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return F.hash(*cols) >= F.lit(-(1 << 31))


def null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of two lists of columns; null keys are keys like any other."""
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def bucketed_running_sum(df: DataFrame, keys: Sequence[str], bucket: Column,
                         order: Sequence[Column], value: str | Column, out: str,
                         peers: bool = False, key_total: str | None = None,
                         firsts: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per ``keys`` in ``order``.

    ``peers=True`` uses a RANGE frame (rows equal on every order key get the
    same, inclusive sum); otherwise a ROWS frame (order must be total).
    ``key_total`` optionally adds the key's grand total (e.g. rows per file).
    ``firsts`` adds, per name, the first non-null value of an expression in
    the key's order.
    """
    keys, firsts = list(keys), dict(firsts or {})
    val = F.col(value) if isinstance(value, str) else value
    # One struct as the shuffle and join key: structs are equal where their fields are, nulls
    # included, so null keys are keys like any other and the join needs no shuffle of its own.
    # Expressions of ``firsts`` become columns here, below the shuffle of both branches.
    d = df.withColumn(_B, F.struct(*keys, bucket.alias("at"))).withColumns({f"__e_{c}": e for c, e in firsts.items()})
    w = Window.partitionBy(_B).orderBy(*order)
    frame = (w.rangeBetween(Window.unboundedPreceding, Window.currentRow) if peers
             else w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = d.select("*", F.sum(val).over(frame).alias(_LOCAL), F.lead(F.lit(1)).over(w).isNull().alias(_LAST),
                     *[F.first(f"__e_{c}", ignorenulls=True).over(whole).alias(f"__first_{c}") for c in firsts])

    totals = local.where(F.col(_LAST) & all_columns(d)).withColumn("__k", F.struct(*keys))
    in_order = Window.partitionBy("__k").orderBy(_B)
    before = F.sum(_LOCAL).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    every = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(F.col(_B).alias("__o"), F.coalesce(before, F.lit(0)).alias(_OFF),
                            *([F.sum(_LOCAL).over(every).alias(_KEYTOT)] if key_total else []),
                            *[F.first(f"__first_{c}", ignorenulls=True).over(every).alias(f"__key_{c}") for c in firsts])
    rows = local.where(all_columns(d)).drop(_LAST, *[f"__{x}_{c}" for c in firsts for x in ("e", "first")])
    res = rows.join(offsets, F.col(_B) == F.col("__o"), "inner")
    res = res.withColumn(out, (F.col(_OFF) + F.col(_LOCAL)).cast("bigint"))
    if key_total:
        res = res.withColumnRenamed(_KEYTOT, key_total)
    for c in firsts:
        res = res.withColumnRenamed(f"__key_{c}", c)
    return res.drop(_LOCAL, _OFF, "__o", _B)


def bucketed_row_number(df: DataFrame, keys: Sequence[str], bucket: Column,
                        order: Sequence[Column], out: str,
                        key_total: str | None = None, firsts: Mapping[str, Column] | None = None) -> DataFrame:
    """1-based row number per ``keys`` in ``order`` (order must be total)."""
    return bucketed_running_sum(df, keys, bucket, order, F.lit(1), out, peers=False, key_total=key_total, firsts=firsts)


# ------------------------------------------------------------ equi-depth buckets
MOST_HOT = 10_000           # hot groups at most: a group is hot with 1/MOST_HOT of all rows or more
QUANTILES = 256


def split_points(df: DataFrame, keys: Sequence[str], value: str, rows: int) -> DataFrame:
    """Ordered cut points of ``value`` (a number) within each group of ``keys`` that holds more
    than ``rows`` rows -> ``*keys, edges``; cut there, no part holds many more than ``rows``.

    One aggregate: a count and a mergeable quantile sketch per group (combined map side).
    ``rows`` counts as 1/MOST_HOT of the table at least, so there are at most MOST_HOT groups,
    which :func:`split_bucket` may broadcast. Rows with equal values stay together.
    """
    keys = list(keys)
    steps = F.array(*[F.lit(i / QUANTILES) for i in range(1, QUANTILES)])
    sketch = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx(value, steps, 10 * QUANTILES).alias("__q"))
    size = df.agg(F.count(F.lit(1)))
    limit = F.greatest(F.lit(float(rows)), size.scalar() / F.lit(MOST_HOT))
    hot = sketch.where(F.col("__n") > limit)
    parts = F.least(F.ceil(F.col("__n") / F.lit(rows)), F.lit(QUANTILES)).cast("int")
    at = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.element_at("__q", F.greatest(F.lit(1), F.floor(i * QUANTILES / parts).cast("int"))))
    return hot.select(*keys, F.array_sort(F.array_distinct(at)).alias("edges"))


def split_bucket(df: DataFrame, keys: Sequence[str], value: str, splits: DataFrame, out: str) -> DataFrame:
    """Adds ``out``: how many cut points of its group stand at or below ``value`` (0: none)."""
    keys = list(keys)
    s = splits.select(*[F.col(c).alias(f"__s_{c}") for c in keys], "edges")
    d = df.join(F.broadcast(s), null_safe(keys, [f"__s_{c}" for c in keys]), "left")     # at most MOST_HOT rows
    below = F.size(F.filter("edges", lambda e: e <= F.col(value)))
    return d.withColumn(out, F.when(F.col("edges").isNull(), F.lit(0)).otherwise(below)).drop("edges", *[f"__s_{c}" for c in keys])
