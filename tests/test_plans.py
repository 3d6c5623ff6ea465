"""Plan-shape checks: the properties the scale design relies on are visible
in the physical plans of the registered queries."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def plan(spark, df, mode="formatted"):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", sorted(E.REGISTRY))
def test_no_cross_join_no_python_in_batch_queries(spark, name):
    p = plan(spark, E.REGISTRY[name].run(spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, (name, bad)


def test_flagship_limits_rows_before_the_day_shuffle(spark):
    p = plan(spark, E.REGISTRY["t1_daily_top_names"].run(spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2            # partial (map side) + final
    assert "partial_count" in p                         # map-side combined counting
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in scans


@pytest.mark.parametrize("name,bucket", [("e3_rolling_hour_counts", "__span"), ("e4_rolling_changelog", "__span"),
                                         ("e1_event_time_spread", "__bucket"), ("k5_conflated_feed", "__bucket")])
def test_running_sums_are_split_by_bucket(spark, name, bucket):
    """The rows are dealt by (key, bucket) and summed there; only the small per-bucket
    totals are ordered by the key alone."""
    p = plan(spark, E.REGISTRY[name].run(spark, SF_SMALL))
    parts = re.findall(r"hashpartitioning\(([^)]*)\)", p)
    assert any(bucket in x for x in parts), parts
    specs = re.findall(r"windowspecdefinition\(([^)]*)\)", p)
    assert any(re.search(rf"{bucket}#\d+L?, ", sp) and "specifiedwindowframe" in sp for sp in specs), specs


def test_scan_reads_only_needed_columns(spark):
    p = plan(spark, E.REGISTRY["e4_rolling_changelog"].run(spark, SF_SMALL))
    for s in re.findall(r"ReadSchema: (struct<[^>]*>)", p):
        assert "value" not in s and "props" not in s and "user_id" not in s


@pytest.mark.parametrize("name,scans", [("e1_event_time_spread", 1), ("e3_rolling_hour_counts", 1), ("e4_rolling_changelog", 1),
                                        ("k5_conflated_feed", 1), ("k5_board_feed", 1), ("t6_hourly_boards", 1),
                                        ("k2_record_frame", 4), ("t4_queue_head_flag", 4), ("t1_daily_top_names", 4)])
def test_each_table_is_read_once(spark, name, scans):
    """One scan per table (the article fixture has four): both sides of a self-join share
    their shuffle. Adaptive execution shares it while it runs; without it the plan shows it."""
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    try:
        p = E.REGISTRY[name].run(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, "true")
    assert p.count("FileScan") == scans, p


def _ran(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_articles_are_parsed_once(spark):
    """No filter on the parse below it: not in a scan, nor in the join that builds the lines."""
    for name in ("p1_article_fields", "s3_typed_articles"):
        plan = E.REGISTRY[name].run(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert not any("RLIKE" in x or "split(" in x for x in plan.splitlines() if "Join" in x or "Filter" in x), plan
        assert "lambdafunction(concat" not in plan


def test_sketches_and_exact_counts_share_the_mentions(spark):
    plan = _ran(E.REGISTRY["a7_sketched_names"].run(spark, SF_SMALL))
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]
