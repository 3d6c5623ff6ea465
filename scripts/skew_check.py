"""Skew check: does one hot name land in one task?

Generates synthetic mentions in Spark (``spark.range``) where one name holds a
third of all rows, then runs (a) the bucketed rolling changelog and (b) a
naive ``Window.partitionBy(name)`` running count, and reports the largest and
median number of shuffle records read by one task in each job, from Spark's
event log. Writes docs/SKEW.md.

Usage: python scripts/skew_check.py [rows]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from mentionscope.operators.rolling import hot_splits, rolling_changelog  # noqa: E402
from mentionscope.operators.topk import daily_top_names  # noqa: E402
from mentionscope.session import build_session  # noqa: E402


def task_reads(log_dir: str) -> dict:
    """(shuffle records, shuffle bytes) read per task of the stage with the largest task, by job group."""
    stage_group, out = {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if not os.path.isfile(path) or "appstatus" in os.path.basename(path):
            continue
        for line in open(path):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerJobStart":
                g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = g
            elif ev.get("Event") == "SparkListenerTaskEnd":
                g = stage_group.get(ev.get("Stage ID"))
                m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                n = m.get("Total Records Read", 0)
                b = m.get("Remote Bytes Read", 0) + m.get("Local Bytes Read", 0)
                if g and n:
                    out.setdefault(g, {}).setdefault(ev["Stage ID"], []).append((n, b))
    return {g: max(stages.values(), key=lambda r: max(x[1] for x in r)) for g, stages in out.items()}


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    log_dir = tempfile.mkdtemp(prefix="mentionscope-skew-")
    spark = build_session(app="skew-check", master="local[8]", shuffle_partitions=64,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    # one name holds a third of the rows; the rest spread over 10,000 names; 30 days
    df = spark.range(rows).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), (F.col("id") % 10_000).cast("string")))
         .alias("name"),
        F.timestamp_seconds(F.lit(1_704_067_200) + (F.col("id") * 7919) % (30 * 86_400)).alias("ts"))

    sc.setJobGroup("bucketed", "bucketed")
    rolling_changelog(df, ts="ts", key="name", id_col="id").write.format("noop").mode("overwrite").save()
    sc.setJobGroup("naive", "naive")
    w = Window.partitionBy("name").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    df.withColumn("c", F.count(F.lit(1)).over(w)).write.format("noop").mode("overwrite").save()

    # all mentions are of one name, within one hour, most of them late in it
    hour = spark.range(rows).select("id", F.lit("hot").alias("name"), F.timestamp_micros(
        (F.lit(1_704_067_200_000_000) + F.sqrt(F.col("id") / rows) * 3_599_000_000).cast("long")).alias("ts"))
    sc.setJobGroup("one_hour", "one_hour")
    rolling_changelog(hour, splits=hot_splits(hour, rows // 256)).write.format("noop").mode("overwrite").save()

    # daily top-10 with one day holding a third of the mentions over 200,000 names
    m = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, F.lit("2015-02-18")).otherwise(
            F.date_format(F.date_add(F.lit("2015-01-01"), (F.col("id") % 60).cast("int")), "yyyy-MM-dd")).alias("day"),
        F.concat(F.lit("n"), ((F.col("id") * 7919) % 200_000).cast("string")).alias("name"))
    sc.setJobGroup("topk", "topk")
    daily_top_names(m, k=10).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("group_by_day", "group_by_day")
    counts = m.groupBy("day", "name").count()
    (counts.groupBy("day").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("c"), "name"))),
                                       1, 10).alias("top"))
           .write.format("noop").mode("overwrite").save())
    spark.stop()

    reads = task_reads(log_dir)
    lines = ["# Skew check", "",
             f"`scripts/skew_check.py`: {rows:,} synthetic mentions, one name holds a third of them, the rest "
             "spread over 10,000 names and 30 days; 64 shuffle partitions, partition coalescing off. "
             "Shuffle data read by one task, over the tasks of the stage with the largest task (bytes show what "
             "records hide: one partial list is one record):", "",
             "| Plan | tasks | max records / task | max bytes / task | median bytes | max / mean bytes |",
             "|---|---|---|---|---|---|"]
    for g, label in (("bucketed", "rolling changelog (bucketed by name and hour)"),
                     ("naive", "Window.partitionBy(name) running count"),
                     ("one_hour", "rolling changelog of one name within one hour, equi-depth buckets"),
                     ("topk", "daily top-10 (partial WindowGroupLimit), one day = 1/3 of rows"),
                     ("group_by_day", "group each day's counts into one list, sort, take 10")):
        r = reads.get(g, [(0, 0)])
        recs, byts = [x[0] for x in r], [x[1] for x in r]
        lines.append(f"| {label} | {len(r)} | {max(recs):,} | {max(byts):,} | {int(statistics.median(byts)):,} | "
                     f"{max(byts) / max(statistics.mean(byts), 1):.2f} |")
    lines += ["", "The naive window gives the hot name's third of the rows to one task. The bucketed changelog "
              "(2 change rows per mention) spreads the hot name over its hour buckets; a name that has all its "
              "rows within one hour is cut at quantiles of its time. For the daily top-10, "
              "the partial WindowGroupLimit sends at most 10 rows per day per task across the day shuffle, "
              "while grouping a day's counted names into one list sends every distinct name of the hot day "
              "to one task.", ""]
    os.makedirs(os.path.join(ROOT, "docs"), exist_ok=True)
    with open(os.path.join(ROOT, "docs", "SKEW.md"), "w") as fh:
        fh.write("\n".join(lines))
    print("\n".join(lines))


if __name__ == "__main__":
    main()
