"""Edge rows of FIXTURES.md §4 under the three reading rules, and the
JVM-compatible name-list split."""

import pytest
from pyspark.sql import functions as F

from mentionscope.functions.names import STRICT_NAME_DELIM, split_names
from mentionscope.operators import articles

# (packed names, expected split with the default delimiter)
SPLIT_CASES = [
    ("A B,12;C D,34", ["A B", "C D"]),
    ("Type ParentCategory,5;A,9", ["Type ParentCategory", "A"]),
    ("", [""]),
    (",5;X,9", ["", "X"]),
    ("A,1;49ers,22", ["A", "ers"]),
    ("Apollo,11 mission,3", ["Apollo", " mission"]),
    (",1", []),
    ("a,1;,2;b,3;", ["a", "", "b"]),
    ("A,1;A,7", ["A", "A"]),
    ("Solo", ["Solo"]),
    ('"Q,1;R,2', ['"Q', "R"]),
    ("x,1,2", ["x"]),
    ("x,12a,3", ["x", "a"]),
]


def test_split_names_matches_jvm_rules(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(SPLIT_CASES)], "i int, s string")
    got = {r["i"]: r["a"] for r in df.select("i", split_names(F.col("s")).alias("a")).collect()}
    for i, (_s, want) in enumerate(SPLIT_CASES):
        assert got[i] == want, SPLIT_CASES[i]


def test_strict_delimiter_keeps_digit_names(spark):
    df = spark.createDataFrame([("A,1;49ers,22",), ("Apollo,11 mission,3",)], "s string")
    got = [r[0] for r in df.select(split_names(F.col("s"), STRICT_NAME_DELIM)).collect()]
    assert got == [["A", "49ers"], ["Apollo,11 mission"]]


def line(names, n_fields=27, stamp="20150218230000", stype="1", tail=("", "", "")):
    fields = [f"{stamp}-1", stamp, stype] + [""] * 20 + [names] + list(tail)
    fields = fields[:n_fields] + [""] * max(0, n_fields - len(fields))
    return "\t".join(fields)


EDGE = [
    # (id, line, rdd names, ds names, stream names)
    (1, line("A B,12;C D,34"), ["A B", "C D"], ["A B", "C D"], ["A B", "C D"]),
    (2, line("Type ParentCategory,5;A,9"), ["A"], ["A"], ["Type ParentCategory", "A"]),
    (3, line("Sub Category List,5;A,9"), ["Sub Category List", "A"], ["A"], ["Sub Category List", "A"]),
    (4, line("", tail=("am", "", "")), [""], [], []),
    (5, line("", tail=("", "", "")), [], [], []),
    (6, line(",5;X,9"), ["", "X"], ["", "X"], ["X"]),
    (7, line("A,1;49ers,22"), ["A", "ers"], ["A", "ers"], ["A", "ers"]),
    (8, line(",1"), [], [], []),
    (9, line("a,1;,2;b,3;"), ["a", "", "b"], ["a", "", "b"], ["a", "b"]),
    (10, line("A,1;A,7"), ["A", "A"], ["A", "A"], ["A", "A"]),
    (11, line("Solo"), ["Solo"], ["Solo"], ["Solo"]),
    (12, line('"Q,1;R,2'), ['"Q', "R"], [], ['"Q', "R"]),
    (13, line("N24,1", n_fields=24), ["N24"], [], ["N24"]),
    (14, line("N28,1", n_fields=28, tail=("x", "", "", "y")), ["N28"], [], ["N28"]),
    (15, line("BadType,1", stype="x"), ["BadType"], [], ["BadType"]),
    (16, line("BadStamp,1", stamp="2015x218230000"), [], [], ["BadStamp"]),
    (17, line("BadTime,1", stamp="2015021823000x"), ["BadTime"], [], ["BadTime"]),
]


@pytest.mark.parametrize("mode,col", [("rdd", 2), ("ds", 3), ("stream", 4)])
def test_edge_rows(spark, mode, col):
    df = spark.createDataFrame([(e[0], e[1]) for e in EDGE], "id int, value string")
    m = articles.mentions(df, mode, keep=("id",))
    got = {}
    for r in m.collect():
        got.setdefault(r["id"], []).append(r["name"])
    for e in EDGE:
        want = e[col]
        assert sorted(got.get(e[0], [])) == sorted(want), (mode, e[0], got.get(e[0]))


def test_rejects_are_reported(spark):
    df = spark.createDataFrame([(e[0], e[1]) for e in EDGE], "id int, value string")
    p = articles.parse_articles(df, "ds", keep=("id",))
    bad = {r["id"] for r in articles.rejects(p).collect()}
    assert bad == {4, 5, 12, 13, 14, 15, 16, 17}
    p = articles.parse_articles(df, "rdd", keep=("id",))
    assert {r["id"] for r in articles.rejects(p).collect()} == {5, 16}


def test_typed_record_binding(spark):
    df = spark.createDataFrame([(1, line("A,1")), (2, line("B,1", stype="x"))], "id int, value string")
    t = articles.typed_articles(df).collect()
    assert len(t) == 1
    r = t[0]
    assert r["identifier"] == "20150218230000-1" and r["sourcetype"] == 1
    assert r["timestamp"].strftime("%Y%m%d%H%M%S") == "20150218230000"
    assert r["allnames"] == "A,1" and r["source"] is None


def test_stop_list_anti_join(spark):
    m = spark.createDataFrame([("d", "Audio Described"), ("d", "X"), ("d", "Type ParentCategory")],
                              "day string, name string")
    stop = spark.createDataFrame([("Audio Described",), ("Type ParentCategory",)], "name string")
    assert [r["name"] for r in articles.drop_stop_names(m, stop).collect()] == ["X"]


def test_strict_reading_unquotes_closed_quotes(spark):
    df = spark.createDataFrame([(1, line('"A,1;B,2"')), (2, line('"Q,1;R,2')), (3, line('"x""y,1"'))],
                               "id int, value string")
    got = {}
    for r in articles.mentions(df, "ds", keep=("id",)).collect():
        got.setdefault(r["id"], []).append(r["name"])
    # A doubled quote is no escape for the reader, so the third field stays as it is.
    assert got == {1: ["A", "B"], 3: ['"x""y', '"']}


# ---- property: the name split follows java.lang.String.split(regex) -------------
import re  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def java_split(s: str, pattern: str = ",[0-9;]+") -> list[str]:
    """Reference model of String.split(regex) with limit 0."""
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="Ab ,1;9", max_size=12), min_size=60, max_size=60))
def test_split_names_property(spark, strings):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = {r["i"]: r["a"] for r in df.select("i", split_names(F.col("s")).alias("a")).collect()}
    for i, s in enumerate(strings):
        assert got[i] == java_split(s), s


def test_record_ids_follow_the_jvm_rules(spark):
    from mentionscope.functions.names import parse_record_id
    ids = {"1-2": (1, 2), "1- 2": (0, 0), " 1-2": (0, 0), "1-2-": (1, 2), "1.1-2": (0, 0), "1-2-3": (0, 0), "x-1": (0, 0), "": (0, 0)}
    df = spark.createDataFrame([(k,) for k in ids], "rid string")
    assert {r[0]: (r[1], r[2]) for r in df.select("rid", *parse_record_id("rid")).collect()} == ids


def test_genuine_replacement_character_survives_the_repair(spark):
    from pyspark.sql import functions as F
    from mentionscope.sources.text import repair_utf8
    raw = spark.createDataFrame([(bytearray(b"a\xffb\xef\xbf\xbd"),), (bytearray(b"ok"),)], "b binary")
    got = raw.select(F.col("b").cast("string").alias("value")).select(repair_utf8("value")).collect()
    assert sorted(r[0] for r in got) == ["ab�", "ok"]


def test_queue_head_with_equal_keys(spark):
    from mentionscope.operators.topk import split_first_n
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    for n, heads in ((1, 1), (2, 2), (3, 3), (9, 4)):
        got = split_first_n(df, n, ["id"]).collect()
        assert len(got) == 4 and sum(r["in_head"] for r in got) == heads


def test_board_bucket_shorter_than_the_span_is_refused():
    import pytest
    from mentionscope.operators.board import _unit
    for bad in ("1 minute", "2 hours"):
        with pytest.raises(ValueError):
            _unit(bad)


def test_running_sum_keeps_null_keys(spark):
    from pyspark.sql import functions as F
    from mentionscope.operators.prefix import bucketed_running_sum
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 5)], "k string, t int")
    got = bucketed_running_sum(df, ["k"], F.col("t") % 2, [F.col("t")], F.lit(1), "s").collect()
    assert len(got) == 4


def test_csv_quotes_like_the_csv_reader(spark, tmp_path):
    """The strict reading keeps, drops and unquotes fields as Spark's CSV reader does."""
    from mentionscope.operators.articles import typed_articles
    from mentionscope.schema import ARTICLE_SCHEMA
    fields = ['"abc"def', '"a""b"', '"a\\"', '"abc', '"abc"', '"a\\"b"', 'a"b"', '""', '"a b" ', "plain"]
    rows = [f"k{i}-1\t20150218230000\t1" + "\t" * 21 + f + "\t" * 3 for i, f in enumerate(fields)]
    for i, line in enumerate(rows):  # one file a line: an open quote takes what follows
        (tmp_path / f"{i}.csv").write_text(line + "\n")
    key, names = ARTICLE_SCHEMA.fieldNames()[0], ARTICLE_SCHEMA.fieldNames()[23]
    want = (spark.read.schema(ARTICLE_SCHEMA).option("sep", "\t").option("mode", "DROPMALFORMED")
            .option("timestampFormat", "yyyyMMddHHmmss").csv(str(tmp_path)))
    want = {tuple(r)[0]: tuple(r)[23] for r in want.collect()}
    got = typed_articles(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert {r[key]: r[names] for r in got.collect()} == want
    assert "k2-1" not in want and "k0-1" in want
