"""Rolling counts: FIXTURES §4.1 and properties of the bucketed running sum."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from mentionscope.operators import rolling
from mentionscope.operators.prefix import bucketed_running_sum


def t(hm):
    return dt.datetime(2015, 2, 18, int(hm[:2]), int(hm[3:]))


def mentions(spark):
    rows = [(1, "A", t("00:00")), (2, "A", t("00:10")), (3, "A", t("01:05")), (4, "B", t("00:20")),
            (5, "A", t("01:00"))]
    return spark.createDataFrame(rows, "id long, name string, ts timestamp")


def test_changelog_example(spark):
    df = mentions(spark).where("id <> 5")
    out = rolling.rolling_changelog(df).orderBy("name", "t", "delta", "id").collect()
    a = [(r["t"].strftime("%H:%M"), r["count"]) for r in out if r["name"] == "A"]
    b = [(r["t"].strftime("%H:%M"), r["count"]) for r in out if r["name"] == "B"]
    assert a == [("00:00", 1), ("00:10", 2), ("01:00", 1), ("01:05", 2), ("01:10", 1), ("02:05", 0)]
    assert b == [("00:20", 1), ("01:20", 0)]


def test_equal_time_expiry_first(spark):
    out = rolling.rolling_changelog(mentions(spark)).where("name = 'A'").orderBy("t", "delta", "id").collect()
    at_one = [(r["delta"], r["count"]) for r in out if r["t"] == t("01:00")]
    # count is 2 (00:00, 00:10) before 01:00: the 00:00 expiry applies first, then the mention
    assert at_one == [(-1, 1), (1, 2)]


def test_rolling_counts_closed_start(spark):
    out = {r["id"]: r["count"] for r in rolling.rolling_counts(mentions(spark)).collect()}
    # A at 01:00 sees 00:00 (closed start), 00:10 and itself
    assert out[5] == 3 and out[3] == 3 and out[1] == 1


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        name = "hot" if rnd.random() < 0.4 else f"n{rnd.randrange(20)}"
        rows.append((i, name, base + dt.timedelta(seconds=rnd.randrange(0, 6 * 3600))))
    return spark.createDataFrame(rows, "id long, name string, ts timestamp")


def test_bucketed_sum_equals_plain_window(spark):
    df = _skewed(spark)
    plain = df.withColumn("c", F.count(F.lit(1)).over(
        Window.partitionBy("name").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)))
    for bucket_s in (60, 900, 7200):
        b = bucketed_running_sum(df, ["name"], F.floor(F.unix_seconds("ts") / bucket_s),
                                 [F.col("ts"), F.col("id")], F.lit(1), "c")
        assert b.select("id", "c").exceptAll(plain.select("id", F.col("c").cast("bigint"))).count() == 0
        assert b.count() == df.count()


def test_changelog_properties_and_partition_independence(spark):
    df = _skewed(spark)
    a = rolling.rolling_changelog(df)
    b = rolling.rolling_changelog(df.repartition(3), splits=rolling.hot_splits(df, 40))
    assert a.exceptAll(b).count() == 0 and a.count() == 2 * df.count()
    assert a.agg(F.min("count")).first()[0] == 0
    last = a.groupBy("name").agg(F.max_by("count", F.struct("t", "delta", "id")).alias("c"))
    assert {r["c"] for r in last.collect()} == {0}
    plain = df.withColumn("c", F.count(F.lit(1)).over(
        Window.partitionBy("name").orderBy(F.col("ts").cast("long")).rangeBetween(-3600, 0)))
    rc = rolling.rolling_counts(df)
    assert rc.select("id", "count").exceptAll(plain.select("id", F.col("c").cast("bigint"))).count() == 0


def test_sliding_counts(spark):
    out = rolling.sliding_counts(mentions(spark)).where("name = 'B'").orderBy("window_start").collect()
    assert [(r["window_start"].strftime("%H:%M"), r["count"]) for r in out] == [
        ("23:30", 1), ("23:45", 1), ("00:00", 1), ("00:15", 1)]


# ---- property: equal times, many names, buckets narrower than the span -------
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

BASE = dt.datetime(2024, 1, 1)


def brute_changelog(rows, span_s=3600):
    """Model: sort each name's +1/-1 changes by (t, delta, id) and add them up."""
    out = {}
    for name in {r[1] for r in rows}:
        ch = sorted([(ts, 1, i) for i, n, ts in rows if n == name] +
                    [(ts + span_s, -1, i) for i, n, ts in rows if n == name])
        c = 0
        for t_, d, i in ch:
            c += d
            out[(name, i, t_, d)] = c
    return out


def brute_counts(rows, span_s=3600, closed=True):
    lo = (lambda t2, ts: ts - span_s <= t2) if closed else (lambda t2, ts: ts - span_s < t2)
    return {i: sum(1 for _, n2, t2 in rows if n2 == n and lo(t2, ts) and t2 <= ts) for i, n, ts in rows}


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 3 * 3600).map(lambda x: x - x % 600)),
                min_size=1, max_size=120))
def test_changelog_and_counts_match_brute_force(spark, pairs):
    rows = [(i, n, s) for i, (n, s) in enumerate(pairs)]          # times on a 10-minute grid: many ties
    df = spark.createDataFrame([(i, n, BASE + dt.timedelta(seconds=s)) for i, n, s in rows],
                               "id long, name string, ts timestamp")
    got = {(r["name"], r["id"], int((r["t"] - BASE).total_seconds()), r["delta"]): r["count"]
           for r in rolling.rolling_changelog(df, splits=rolling.hot_splits(df, 5)).collect()}
    assert got == brute_changelog(rows)
    cnt = {r["id"]: r["count"] for r in rolling.rolling_counts(df, splits=rolling.hot_splits(df, 5)).collect()}
    assert cnt == brute_counts(rows)
    half = {r["id"]: r["count"]
            for r in rolling.rolling_counts(df, closed_start=False).collect()}
    assert half == brute_counts(rows, closed=False)


# ---- mentions without a time, hot names within one hour, late rows ------------
def test_untimed_mentions_are_returned_with_a_reason(spark):
    df = _skewed(spark, 500).withColumn("ts", F.when(F.col("id") % 7 != 0, F.col("ts")))
    kept, out = rolling.rolling_changelog(df), rolling.untimed(df)
    assert kept.where("t IS NULL OR count < 0").count() == 0
    assert kept.count() // 2 + out.count() == 500 and {r["reason"] for r in out.collect()} == {"no time"}
    assert rolling.rolling_counts(df).count() + out.count() == 500


def test_one_name_one_hour_is_split_into_even_parts(spark):
    """All rows of one name within one hour, unevenly: equi-depth parts, the same counts."""
    df = spark.range(4000).select("id", F.lit("hot").alias("name"),
                                  F.timestamp_micros((F.lit(1_704_067_200_000_000) + F.pow(F.col("id") / 4000, F.lit(3)) * 3_500_000_000).cast("long")).alias("ts"))
    splits = rolling.hot_splits(df, 250)
    ch = rolling.split_bucket(rolling._changes(df, "ts", "name", "id", rolling.HOUR_US), ["name", "__span"], "__t", splits, "__sub")
    sizes = [r["count"] for r in ch.groupBy("__span", "__sub").count().collect()]
    assert len(sizes) == 32 and max(sizes) <= 2 * 8000 / 32
    a, b = rolling.rolling_changelog(df), rolling.rolling_changelog(df, splits=splits)
    assert a.exceptAll(b).count() == 0 and b.count() == 8000
    c, d = rolling.rolling_counts(df), rolling.rolling_counts(df, splits=splits)
    assert c.exceptAll(d).count() == 0 and d.count() == 4000


def test_late_rows_of_micro_batches(spark):
    rows = [(1, 0, "10:00"), (2, 0, "10:30"), (3, 1, "10:10"), (4, 1, "11:00"), (5, 2, "10:20"), (6, 2, "10:45"), (7, 2, None)]
    df = spark.createDataFrame([(i, b, None if h is None else t(h)) for i, b, h in rows], "id long, batch long, ts timestamp")
    got = {r["id"] for r in rolling.late(df, "batch", delay_us=15 * 60_000_000).collect() if r["late"]}
    assert got == {3, 5}


def test_null_names_and_times_before_1970(spark):
    rows = [(1, None, -7_200_000_000 - 5), (2, None, -7_200_000_000), (3, "a", -1), (4, "a", 0), (5, "a", 3_600_000_000)]
    df = spark.createDataFrame(rows, "id long, name string, us long").withColumn("ts", F.timestamp_micros("us"))
    got = {(r["name"], r["id"], r["delta"]): r["count"] for r in rolling.rolling_changelog(df).collect()}
    assert got == {(None, 1, 1): 1, (None, 2, 1): 2, (None, 1, -1): 1, (None, 2, -1): 0,
                   ("a", 3, 1): 1, ("a", 4, 1): 2, ("a", 3, -1): 1, ("a", 4, -1): 0, ("a", 5, 1): 1, ("a", 5, -1): 0}
    assert rolling.rolling_changelog(df).exceptAll(rolling.rolling_changelog(df, splits=rolling.hot_splits(df, 1))).count() == 0
