"""End-to-end jobs: the daily batch job writes day partitions; the streaming
job (article records -> rolling changelog -> leaderboard) equals its
batch twins on replayed records."""

import os

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mentionscope.functions import timefuncs as tf
from mentionscope.operators import eventtime, rolling
from mentionscope.plans import daily, stream_job
from mentionscope.sources import fixtures as fx
from mentionscope.streaming import board as sboard
from mentionscope.streaming.sources import record_frame
from replay import write_files


def test_daily_job_writes_day_partitions(spark, scratch):
    lines = fx.article_lines(spark, SF_SMALL, "month")
    seg = os.path.join(scratch, "segments")
    lines.select("value").coalesce(2).write.text(seg)
    out = os.path.join(scratch, "top")
    daily.run(spark, os.path.join(seg, "*.txt"), out, k=10, rejects_output=os.path.join(scratch, "rej"))
    got = spark.read.parquet(out)
    exp = daily.daily_top(lines, 10)
    assert got.count() == exp.count() > 0
    assert got.select("day", "name", "mentions", "rank").exceptAll(exp).count() == 0
    assert spark.read.parquet(os.path.join(scratch, "rej")).count() > 0


def test_streaming_job_equals_batch(spark, scratch):
    """Records with and without event times -> local, changelog, board, snapshot; no input is filtered."""
    lines = fx.article_lines(spark, SF_SMALL, "day")
    stamp = F.split("value", "\t").getItem(1)
    seg = lines.withColumn("seg", tf.floor_segment(tf.stamp_minute(stamp)))
    records = record_frame(eventtime.spread_event_times(seg, "seg", "id", F.col("seg"))).select("key", "value", "event_ts")
    pdf = records.toPandas().sort_values("event_ts").reset_index(drop=True)
    assert pdf.event_ts.isna().any()
    schema = records.schema
    inp = os.path.join(scratch, "in")
    write_files(spark, pdf, schema, inp, 4)
    far = pdf.event_ts.max() + pd.Timedelta(days=3)
    sent = pd.DataFrame({"key": ["99999999999999-0"], "event_ts": [far],
                         "value": ["\t".join(["99999999999999-0", "x", "1"] + [""] * 20 + ["__sentinel__,1"])]})
    write_files(spark, sent[["key", "value", "event_ts"]], schema, inp, 1, start=50)

    base = os.path.join(scratch, "run")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(inp, "*"))
    stream_job.run_available(spark, src, base, delay="0 seconds", n=25, bucket_us=3_600_000_000)
    allch = spark.read.parquet(os.path.join(base, "changelog"))
    got = allch.where("name <> '__sentinel__'")
    m = stream_job.record_mentions(records)
    exp = rolling.rolling_changelog(m, ts="ts", key="name", id_col="id")
    assert got.count() == exp.count() > 0
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    lost = stream_job.rejected(spark, base)
    assert lost.count() == rolling.untimed(m).count() > 0
    assert got.count() // 2 + lost.count() == m.count()

    board = sboard.current_board(spark, os.path.join(base, "state"))
    latest = allch.groupBy("name").agg(F.max_by("count", F.struct("t", "delta", "id")).alias("count"))
    exact = latest.orderBy(F.desc("count"), "name").limit(25)
    assert sorted(board.collect()) == sorted(exact.collect())
    snap = {r["name"]: r["count"] for r in sboard.snapshot_table(spark, os.path.join(base, "ck-snapshot")).collect()}
    assert {r["name"]: r["count"] for r in board.collect()}.items() <= snap.items()


def test_daily_job_cli_with_lists(spark, scratch):
    lines = fx.article_lines(spark, SF_SMALL, "month")
    seg = os.path.join(scratch, "segments")
    lines.select("value").coalesce(1).write.text(seg)
    out = os.path.join(scratch, "lists")
    daily.main([os.path.join(seg, "*.txt"), out, "--k", "3", "--lists", "--mode", "ds"])
    got = spark.read.parquet(out)
    assert set(got.columns) == {"day", "top"}
    sizes = [len(r["top"]) for r in got.collect()]
    assert sizes and max(sizes) <= 3
    exp = daily.daily_top(lines, 3, "ds")
    assert sum(sizes) == exp.count()


def _segments(spark, scratch, name, lines):
    out = os.path.join(scratch, "segments", name)
    lines.select("value").coalesce(1).write.text(out)
    return out


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.startswith("part-")}


def test_updates_equal_one_full_run(spark, scratch):
    """New segments only: two updates give the ranks of one full run, days that the second
    does not touch keep their files, and nothing is read twice."""
    lines = fx.article_lines(spark, SF_SMALL, "month")
    stamp = F.split("value", "\t").getItem(1)
    early = F.coalesce(stamp < "19980101000000", F.lit(False))
    _segments(spark, scratch, "a", lines.where(early))
    pattern, base = os.path.join(scratch, "segments", "*", "*.txt"), os.path.join(scratch, "tables")
    assert daily.update(spark, pattern, base) == 1
    first = _files(os.path.join(base, "top"))
    assert first and daily.update(spark, pattern, base) == 0 and _files(os.path.join(base, "top")) == first
    _segments(spark, scratch, "b", lines.where(~early & (F.col("id") % 2 == 0)))
    _segments(spark, scratch, "c", lines.where(~early & (F.col("id") % 2 == 1)))
    assert daily.update(spark, pattern, base) == 2
    second = _files(os.path.join(base, "top"))
    assert first.items() <= second.items() and len(second) > len(first)
    got, exp = daily.top_table(spark, base), daily.daily_top(lines, 10)
    assert got.count() == exp.count() > 0 and got.exceptAll(exp.select(got.columns)).count() == 0
    # Kept and rejected lines are the input.
    from mentionscope.operators import articles
    parsed = articles.parse_articles(lines, "rdd")
    assert daily.rejected(spark, base).agg(F.sum("n")).first()[0] == articles.rejects(parsed).count() > 0


def test_update_after_a_failure(spark, scratch):
    """A run that ended after its items were written, or before they were noted as seen."""
    lines = fx.article_lines(spark, SF_SMALL, "month").where("id % 3 = 0")
    _segments(spark, scratch, "a", lines)
    pattern, base = os.path.join(scratch, "segments", "*", "*.txt"), os.path.join(scratch, "tables")
    from mentionscope.sources.text import read_lines
    daily.ingest(spark, read_lines(spark, pattern, with_file=True).select("file", "value"), base)     # and then nothing more
    assert daily.top_table(spark, base).count() == 0
    assert daily.update(spark, pattern, base) == 1                                                    # the segment again: counted once
    got, exp = daily.top_table(spark, base), daily.daily_top(lines, 10)
    assert got.count() == exp.count() > 0 and got.exceptAll(exp.select(got.columns)).count() == 0


def test_full_run_with_rejects_reads_once(spark, scratch):
    lines = fx.article_lines(spark, SF_SMALL, "month")
    _segments(spark, scratch, "a", lines)
    out, rej = os.path.join(scratch, "out"), os.path.join(scratch, "rej")
    daily.run(spark, os.path.join(scratch, "segments", "*", "*.txt"), out, mode="ds", rejects_output=rej)
    exp = daily.daily_top(lines, 10, "ds")
    got = spark.read.parquet(out).select("day", "name", "mentions", "rank")
    assert got.count() == exp.count() > 0 and got.exceptAll(exp.select(got.columns)).count() == 0
    from mentionscope.operators import articles
    n = spark.read.parquet(rej).where("kind = 'reject'").agg(F.sum("n")).first()[0]
    assert n == articles.rejects(articles.parse_articles(lines, "ds")).count() > 0
