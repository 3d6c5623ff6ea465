"""Quarter-hour arithmetic, segment lists and event-time spread (FIXTURES §4.3, §4.4)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from mentionscope.functions import timefuncs as tf
from mentionscope.operators import eventtime
from mentionscope.sources import segments


def ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def test_segment_window_and_next_quarter(spark):
    df = spark.createDataFrame([(ts("2015-02-18 12:37:12"),)], "now timestamp")
    got = [r["file_name"] for r in segments.wanted_segments(df, "now", 60).collect()]
    assert got == ["20150218113000.gkg.csv", "20150218114500.gkg.csv",
                   "20150218120000.gkg.csv", "20150218121500.gkg.csv"]
    cases = spark.createDataFrame([(ts("2015-02-18 12:37:00"),), (ts("2015-02-18 12:59:00"),),
                                   (ts("2015-02-18 12:15:00"),)], "t timestamp")
    nxt = [r[0].strftime("%H:%M") for r in cases.select(tf.next_segment("t")).collect()]
    assert nxt == ["12:45", "13:00", "12:30"]


def test_stamp_minute_and_names(spark):
    df = spark.createDataFrame([("20150218230512",), ("bad",)], "s string")
    r = df.select(tf.stamp_minute("s").alias("m")).collect()
    assert r[0]["m"] == ts("2015-02-18 23:05:00") and r[1]["m"] is None
    seg = df.select(tf.segment_key(tf.floor_segment(tf.stamp_minute("s")))).first()[0]
    assert seg == "v2/gkg/20150218230000.gkg.csv"


def test_event_time_spread(spark):
    start = ts("2015-02-18 23:00:00")
    rows = [("s4", i, start) for i in range(4)] + [("s7", 100 + i, start) for i in range(7)]
    df = spark.createDataFrame(rows, "seg string, pos long, start timestamp")
    # a tiny bucket size so both segments span several buckets
    out = eventtime.spread_event_times(df, "seg", "pos", F.col("start"), bucket=F.floor(F.col("pos") / 2))
    got = {(r["seg"], r["line_no"]): r["event_ts"] for r in out.collect()}
    assert [got[("s4", i)].strftime("%H:%M:%S.%f")[:12] for i in range(4)] == [
        "23:00:00.000", "23:03:45.000", "23:07:30.000", "23:11:15.000"]
    step = got[("s7", 1)] - got[("s7", 0)]
    assert step == dt.timedelta(milliseconds=128571)
    assert {r["n_lines"] for r in out.where("seg = 's7'").collect()} == {7}


def test_manifest_head_and_new_segments(spark):
    lines = [(i, f"http://host/v2/gkg/2015021823{i:02d}00.gkg.csv") for i in range(5)]
    man = spark.createDataFrame(lines, "pos long, line string")
    head = segments.manifest_head(man, 2).orderBy("pos").collect()
    assert [r["file_name"] for r in head] == ["20150218230000.gkg.csv", "20150218230100.gkg.csv"]
    assert head[0]["bucket_path"] == "/v2/gkg/20150218230000.gkg.csv"
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "file_name string")
    seen = spark.createDataFrame([("c",), ("a",)], "file_name string")
    # "b" is older than the newest seen file "c" and is still reported
    assert [r[0] for r in segments.new_segments(listed, seen).collect()] == ["b"]


def test_last_key_default(spark):
    empty = spark.createDataFrame([], "key string, offset long")
    assert segments.last_key(empty).first()[0] == "20150218230000-0"
    log = spark.createDataFrame([("x-1", 5), ("x-2", 9)], "key string, offset long")
    assert segments.last_key(log).first()[0] == "x-2"


def test_record_id_parse(spark):
    from mentionscope.functions.names import parse_record_id
    df = spark.createDataFrame([("20150218230000-7",), ("20150218230000-T12",), ("x",), ("1-2-3",)], "k string")
    a, b = parse_record_id("k")
    assert [tuple(r) for r in df.select(a, b).collect()] == [(20150218230000, 7), (0, 0), (0, 0), (0, 0)]


def test_high_water_mark_skips_late_file(spark):
    listed = spark.createDataFrame([("20150218230000.gkg.csv",), ("20150218231500.gkg.csv",)], "file_name string")
    hwm = [r[0] for r in segments.after_high_water_mark(listed, "20150218230000.gkg.csv").collect()]
    assert hwm == ["20150218231500.gkg.csv"]
    # the earlier file arrives late: the high-water mark never reports it, the anti-join does
    seen = spark.createDataFrame([("20150218231500.gkg.csv",)], "file_name string")
    assert segments.after_high_water_mark(listed, "20150218231500.gkg.csv").count() == 0
    assert [r[0] for r in segments.new_segments(listed, seen).collect()] == ["20150218230000.gkg.csv"]


def test_day_string(spark):
    from mentionscope.functions.names import day_string
    df = spark.createDataFrame([(ts("2015-02-18 23:59:59"),)], "t timestamp")
    assert df.select(day_string("t")).first()[0] == "2015-02-18"


def test_event_time_spread_over_text_segments(spark, scratch):
    """E1 on real segment files: line order from the scan, start from the file name."""
    from mentionscope.sources.text import read_lines
    seg = os.path.join(scratch, "segment")
    os.makedirs(seg)
    for name, n in (("20150218230000.gkg.csv", 4), ("20150218231500.gkg.csv", 7)):
        with open(os.path.join(seg, name), "w") as fh:
            fh.write("\n".join(f"line{i}" for i in range(n)) + "\n")
    lines = read_lines(spark, os.path.join(seg, "*.csv"), with_file=True)
    lines = lines.withColumn("start", tf.segment_start_from_file("file"))
    out = eventtime.spread_event_times(lines, "file", "pos", F.col("start"), bucket=F.col("split"))
    got = {(r["file"], r["value"]): (r["line_no"], r["event_ts"].strftime("%H:%M:%S.%f")[:12]) for r in out.collect()}
    a = "20150218230000.gkg.csv"
    assert [got[(a, f"line{i}")] for i in range(4)] == [
        (0, "23:00:00.000"), (1, "23:03:45.000"), (2, "23:07:30.000"), (3, "23:11:15.000")]
    b = "20150218231500.gkg.csv"
    assert got[(b, "line6")] == (6, "23:27:51.426")      # 23:15 + 6 * 128,571 ms
