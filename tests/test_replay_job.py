"""The replay job: text segments -> record files -> the streaming job."""

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from mentionscope.operators import board, eventtime, rolling
from mentionscope.plans import replay_job, stream_job
from mentionscope.sources import fixtures as fx
from mentionscope.sources import segments
from mentionscope.streaming import board as sboard

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import run_replay  # noqa: E402
import run_stream  # noqa: E402

SCHEMA = "key string, value string, event_ts timestamp"


def _segment(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as fh:
        fh.write(b"\n".join(lines) + b"\n")


def _line(key, names="A,1"):
    return "\t".join([key, key[:14], "1"] + [""] * 20 + [names, "", "", ""]).encode()


def test_times_start_at_the_first_stamp(spark, scratch):
    seg = os.path.join(scratch, "seg")
    _segment(seg, "20150218230000.gkg.csv", [_line("20150218231559-1"), _line("20150219000000-2"), _line("20150218230000-3\xff")])
    _segment(seg, "20150218231500.gkg.csv", [b"no stamp\tx", _line("20150218233000-1") + b"\xff", _line("20150218233000-2"), _line("20150218233000-3")])
    _segment(seg, "20150218234500.gkg.csv", [b"only\tthis"])
    got = {r["key"]: r["event_ts"] for r in replay_job.replay_records(spark, os.path.join(seg, "*")).collect()}
    t = dt.datetime(2015, 2, 18, 23, 15)
    step = dt.timedelta(minutes=5)
    assert got["20150218231559-1"] == t                       # seconds are not part of the start
    assert got["20150219000000-2"] == t + step                # a later line's own stamp is not read
    u = dt.datetime(2015, 2, 18, 23, 30)
    step = dt.timedelta(milliseconds=900_000 // 4)
    assert got["no stamp"] == u and got["20150218233000-3"] == u + 3 * step
    assert got["only"] is None
    values = [r["value"] for r in replay_job.replay_records(spark, os.path.join(seg, "*")).collect()]
    assert len(values) == 8 and not any("�" in v for v in values)


def test_null_segments_are_segments(spark):
    rows = [(None, 1, "201502182300-1"), (None, 2, "x"), ("a", 3, "x"), ("a", 4, "201502182315-1")]
    d = spark.createDataFrame(rows, "seg string, id long, value string")
    got = {r["id"]: (r["line_no"], r["n_lines"], r["event_ts"]) for r in eventtime.replay_times(d, "seg", "id").collect()}
    half = dt.timedelta(milliseconds=450_000)
    assert got == {1: (0, 2, dt.datetime(2015, 2, 18, 23, 0)), 2: (1, 2, dt.datetime(2015, 2, 18, 23, 0) + half),
                   3: (0, 2, dt.datetime(2015, 2, 18, 23, 15)), 4: (1, 2, dt.datetime(2015, 2, 18, 23, 15) + half)}
    assert eventtime.replay_times(d.where("false"), "seg", "id").count() == 0


def test_job_feeds_the_stream(spark, scratch):
    """Text files -> run_replay -> run_stream (its default form) equals the batch changelog."""
    seg, rec, base = (os.path.join(scratch, x) for x in ("seg", "rec", "run"))
    fx.article_lines(spark, SF_SMALL, "month").select("value").repartition(3).write.text(seg)
    run_replay.main([os.path.join(seg, "*.txt"), rec, "--files", "4"])
    records = spark.read.schema(SCHEMA).parquet(rec)
    assert records.count() + spark.read.parquet(rec + "-untimed").count() == spark.read.text(seg).count()
    exp = rolling.rolling_changelog(stream_job.record_mentions(records), ts="ts", key="name", id_col="id")
    assert exp.count() > 0
    # One name far ahead moves the watermark past every expiry; it comes in a later batch.
    far = records.agg(F.max("event_ts") + F.expr("INTERVAL 3 DAYS")).first()[0]
    _later = spark.createDataFrame([("99999999999999-0", "\t".join(["99999999999999-0", "x", "1"] + [""] * 20 + ["__sentinel__,1"]), far)], SCHEMA)
    args = [rec, base, "--delay-minutes", "0", "--files-per-trigger", "1000", "--once"]
    run_stream.main(args)
    _later.coalesce(1).write.mode("append").parquet(rec)
    run_stream.main(args)
    got = spark.read.schema(stream_job.CHANGELOG_SCHEMA).parquet(os.path.join(base, "changelog")).where("name <> '__sentinel__'")
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    assert 0 < sboard.current_board(spark, os.path.join(base, "state")).count() <= 100


def test_marks_per_feed(spark):
    listed = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), (None, "5"), ("c", "9")], "feed string, file_name string")
    marks = spark.createDataFrame([("a", "1"), ("b", "1"), (None, "4")], "feed string, mark string")
    got = sorted((tuple(r) for r in segments.after_marks(listed, marks).collect()), key=repr)
    assert got == sorted([("a", "2"), (None, "5"), ("c", "9")], key=repr)


def test_published_boards(spark):
    h = [dt.datetime(2020, 1, 1, k) for k in range(3)]
    b = spark.createDataFrame([(h[0], "x", 3), (h[0], "y", 2), (h[1], "x", 4)], "bucket timestamp, name string, count long")
    got = sorted(tuple(r) for r in board.published(b).select("bucket", "name", "count").collect())
    assert got == [(h[0], "x", 3), (h[0], "y", 2), (h[1], "x", 4), (h[1], "y", 0), (h[2], "x", 0)]


@pytest.mark.parametrize("name", ["t2_names_by_mentions"])
def test_full_order(spark, name):
    import __spark_entry__ as E
    rows = [(-r["mentions"], r["name"]) for r in E.queries()[name](spark, SF_SMALL).collect()]
    assert rows == sorted(rows) and len(rows) > 100
