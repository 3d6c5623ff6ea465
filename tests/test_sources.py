"""Scans and source helpers: text segments, typed reads, header table,
UTF-8 repair, record frames, file discovery."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mentionscope.operators import articles, topk
from mentionscope.schema import ARTICLE_SCHEMA, read_header_table, schema_from_header_table
from mentionscope.sources import fixtures as fx
from mentionscope.sources import segments, text
from mentionscope.streaming.sources import changelog_value, decode_records, record_frame


def _line(stamp, names, n=27):
    fields = [f"{stamp}-1", stamp, "1"] + [""] * 20 + [names, "", "", ""]
    return "\t".join(fields[:n])


def test_text_scan_and_daily_top(spark, scratch):
    seg = os.path.join(scratch, "segment")
    os.makedirs(seg)
    with open(os.path.join(seg, "20150218230000.gkg.csv"), "w") as fh:
        fh.write("\n".join([_line("20150218230000", "A,1;B,2"), _line("20150218231500", "A,3"),
                            _line("20150219000000", "C,1"), "short\tline"]) + "\n")
    lines = text.read_lines(spark, os.path.join(seg, "*.csv"), with_file=True)
    assert set(lines.columns) == {"value", "file", "split", "pos"}
    top = topk.daily_top_names(articles.mentions(lines, "rdd"), k=10)
    got = sorted((str(r["day"]), r["name"], r["mentions"], r["rank"]) for r in top.collect())
    assert got == [("2015-02-18", "A", 2, 1), ("2015-02-18", "B", 1, 2), ("2015-02-19", "C", 1, 1)]
    typed = text.read_articles(spark, os.path.join(seg, "*.csv"))
    assert typed.schema == ARTICLE_SCHEMA and typed.count() == 3
    with pytest.raises(PySparkException, match="malformed article line: short"):
        text.read_articles(spark, os.path.join(seg, "*.csv"), mode="fail").count()


def test_header_table_to_schema(spark, scratch):
    path = os.path.join(scratch, "headers.csv")
    with open(path, "w") as fh:
        fh.write("GKGRECORDID\tSTRING\tNULLABLE\t\nDATE\tDATE\tNULLABLE\t\nSourceCollectionIdentifier\tINTEGER\tNULLABLE\t\n")
    s = schema_from_header_table(read_header_table(spark, path))
    assert [(f.name, f.dataType.simpleString()) for f in s.fields] == [
        ("identifier", "string"), ("timestamp", "date"), ("sourcetype", "int")]


def test_utf8_repair(spark, scratch):
    path = os.path.join(scratch, "bad.txt")
    with open(path, "wb") as fh:
        fh.write(b"ok line\nbro\xffken\xc3\n\xc3\xa9t\xc3\xa9\n")
    got = [r[0] for r in text.read_lines_utf8(spark, path).collect()]
    assert got == ["ok line", "broken", "été"]


def test_record_frame_contract(spark):
    df = spark.createDataFrame([("20150218230000-1\tx\ty", "2015-02-18 23:00:00")], "value string, event_ts string")
    r = record_frame(df.withColumn("event_ts", F.to_timestamp("event_ts"))).first()
    assert r["key"] == "20150218230000-1" and r["partition"] == 0
    assert r["headers"][0]["key"] == "event_ts_ms" and bytes(r["headers"][0]["value"]) == b"1424300400000"
    c = changelog_value(spark.createDataFrame([("A", 3)], "name string, count long")).first()
    assert (c["key"], c["value"]) == ("A", "3")


def test_topic_record_round_trip(spark):
    """record_frame -> (what the Kafka source returns) -> decode_records keeps key, value, event time."""
    df = spark.createDataFrame([("20150218230000-1\tx", "2015-02-18 23:00:01.250")], "value string, event_ts string")
    rec = record_frame(df.withColumn("event_ts", F.to_timestamp("event_ts")))
    as_source = rec.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                           F.current_timestamp().alias("timestamp"), "headers")
    r = decode_records(as_source).first()
    assert r["key"] == "20150218230000-1" and r["value"] == "20150218230000-1\tx"
    assert r["event_ts"].strftime("%H:%M:%S.%f") == "23:00:01.250000"
    no_hdr = as_source.withColumn("headers", F.array().cast("array<struct<key:string,value:binary>>"))
    assert decode_records(no_hdr).first()["event_ts"] is not None     # falls back to the record time


def test_cluster_conf_sizes_partitions():
    from mentionscope.session import cluster_conf
    c = cluster_conf(100 * 10**12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == -(-int(100 * 10**12 * 0.3) // (256 << 20))
    small = cluster_conf(10**9, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # at least two waves of tasks


# ---- one pass per reading mode, line numbers, sketches, malformed bytes ---------
def _scans(spark, df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_bad_rows_in_one_pass(spark, scratch):
    from pyspark.sql import Observation
    lines = fx.article_lines(spark, SF_SMALL, "day")
    path = os.path.join(scratch, "lines")
    lines.select("value").write.text(path)
    counts = Observation()
    kept = text.read_articles(spark, path, observation=counts)
    assert _scans(spark, kept) == 1
    n = kept.count()
    parsed = articles.typed_articles(lines)
    assert n == parsed.count() == counts.get["accepted"] and counts.get["rejected"] == lines.count() - n > 0
    strict = text.read_articles(spark, path, mode="fail")
    assert _scans(spark, strict) == 1
    with pytest.raises(PySparkException, match="malformed article line"):
        strict.count()
    clean = os.path.join(scratch, "clean")
    lines.where("value LIKE '%am\t\t'").where(F.size(F.split("value", "\t")) == 27).where("id % 1048576 < 1000").select("value").write.text(clean)
    assert text.read_articles(spark, clean, mode="fail").count() == spark.read.text(clean).count() > 0
    with pytest.raises(ValueError):
        text.read_articles(spark, path, mode="skip")


def test_lines_are_numbered_as_in_the_file(spark, scratch):
    """Files of many blocks, read by many tasks in another order."""
    for name, n in (("a.txt", 3000), ("b.txt", 1), ("c.txt", 500)):
        with open(os.path.join(scratch, name), "w") as f:
            f.writelines(f"{name} {i} {'x' * (i % 50)}\n" for i in range(1, n + 1))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        got = text.numbered_lines(spark, scratch)
        assert spark.read.text(scratch).rdd.getNumPartitions() > 10
        rows = got.collect()
        head = segments.read_manifest(spark, os.path.join(scratch, "a.txt")).orderBy("pos").limit(3).collect()
    finally:
        spark.conf.set(key, old)
    assert len(rows) == 3501 and all(r["value"].split(" ")[:2] == [r["file"], str(r["line_no"])] for r in rows)
    assert [r["pos"] for r in head] == [1, 2, 3] and head[2]["line"].startswith("a.txt 3 ")


def test_sketches_merge(spark):
    df = spark.range(60_000).selectExpr("id % 30 AS day", "CASE WHEN id % 1000 > 0 THEN concat('n', id % 20000) END AS name")
    daily = topk.sketch_keys(df, ["day"])
    assert daily.select(F.max(F.length("sketch"))).first()[0] < 10_000
    whole = topk.merge_sketches(daily.withColumn("g", F.lit(1)), ["g"]).first()["n_names"]
    exact = df.agg(F.count_distinct("name")).first()[0]
    assert abs(whole - exact) <= 4 * 1.04 / 64 * exact
    one = topk.sketch_keys(df.withColumn("g", F.lit(1)), ["g"])
    assert topk.merge_sketches(one, ["g"]).first()["n_names"] == whole         # merged parts equal the whole


def test_malformed_bytes_are_cut_out(spark):
    import __spark_entry__ as E
    rows = E.queries()["s10_repaired_bytes"](spark, SF_SMALL).collect()
    assert sum(r["n_cut"] > 0 for r in rows) > 20
    assert all("�" not in r["text"] for r in rows)
