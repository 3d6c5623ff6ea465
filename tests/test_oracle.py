"""Every registered query equals its DuckDB statement (row count, columns,
order-insensitive values) on the sf0.001 tables; the driver repeats this at sf0.01."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from mentionscope.sources.fixtures import TABLES  # noqa: E402
from oracle_check import norm, type_mismatches  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(E.REGISTRY) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n in E.REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(cols) == sorted(rel.columns)
    assert type_mismatches(df, rel) == []
    order = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "name", "mentions", "rank"]
    assert df.count() > 0


@pytest.mark.parametrize("grain", ["day", "month"])
def test_article_lines_match_the_oracle(spark, con, grain):
    """Articles and edge lines are the same input on both sides, with one id each."""
    from mentionscope.plans import oracle_sql as q
    from mentionscope.sources import fixtures as fx
    got = sorted(tuple(r) for r in fx.article_lines(spark, SF_SMALL, grain).select("id", "value").collect())
    want = sorted(con.sql(f"WITH {q.lines_cte(grain).lstrip()} SELECT id, value FROM lines").fetchall())
    assert got == want
    assert len({i for i, _ in got}) == len(got)


def test_edge_lines_reach_the_rules(spark):
    """Every rule meets lines it rejects or names it removes."""
    from mentionscope.operators import articles
    from mentionscope.sources import fixtures as fx
    lines = fx.article_lines(spark, SF_SMALL).cache()
    for mode in ("rdd", "ds", "stream"):
        assert articles.rejects(articles.parse_articles(lines, mode)).count() > 0
    raw = articles.mentions(lines, articles.ReadRules("lenient", True, (), ()))
    assert raw.where("name = 'Type ParentCategory'").count() > 0
    assert raw.where("name like '%Category'").count() > 0
    assert raw.where("name = 'Audio Described'").count() > 0
    assert raw.where("name = ''").count() > 0
    lines.unpersist()
