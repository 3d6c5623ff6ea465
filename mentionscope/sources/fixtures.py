"""News-shaped inputs derived in Spark from the driver's test tables.

The test tables hold no news feed, so the feed is built from them (the same
input is written as SQL in :mod:`mentionscope.plans.oracle_sql` for the
DuckDB oracle):

* ``packed_names``: one article per order and block of ``LINES`` line numbers;
  its names are the parts (``p_name || ' ' || p_brand``) packed as
  ``name,l_linenumber`` joined by ``;`` in (line number, name) order; its time
  is the order date, or the order month for dense daily top-k. Its id is
  ``order key * ID_SPAN + block``, one id per article whatever the order's
  size (line numbers below ``LINES * ID_SPAN / 2``). Every line item of an
  order in ``orders`` is packed; an order without line items gives no article.
* ``article_lines``: the 27-field TAB line of each article (``stamp-id``,
  ``stamp``, ``1``, 20 empty fields, the names, ``am`` when ``id % 3 = 0``, two
  empty fields), and besides one edge line per row of ``customer``, by turns
  each of ``EDGE_LINES``: wrong field counts, bad stamps and numbers, CSV
  quotes, stop names, odd delimiters, invalid record ids.
* ``event_mentions``: ``events`` as a mention stream; the name is the event
  type (dense, five names) or the user id (150 names).

Plan: each table is scanned once; lineitem joins part on the part key, is
grouped by (order, block) and joins orders on the order key. A group holds the
items of ``LINES`` line numbers of one order, so a huge order is spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _edge(key: str = "{S}-{K}", stamp: str = "{S}", stype: str = "1", names: str = "{N},12;Other Name,3",
          tail: tuple = ("am", "", "")) -> str:
    return "\t".join([key, stamp, stype] + [""] * 20 + [names, *tail])


# ---- fixed values ------------------------------------------------------------
LINES = 4                   # line numbers packed into one article
ID_SPAN = 1 << 20           # article ids per order; edge lines take the upper half
EDGE_DAY = "1996-01-01"     # edge lines are dated from here, over 365 days
# {S}: stamp, {K}: id, {N}: customer name.
EDGE_LINES = [
    _edge(tail=()),                                  # 24 fields
    _edge(tail=("am", "")),                          # 26 fields
    _edge(tail=("am", "", "", "x")),                 # 28 fields
    _edge(stamp="2015021823000"),                    # 13 digits
    _edge(stamp="20150230230000"),                   # 30 February
    _edge(stamp="2015O218230000"),                   # a letter
    _edge(stamp=""),
    _edge(stype="x"),
    _edge(stype=""),
    _edge(names=""),                                 # an empty names field
    _edge(names="", tail=("", "", "")),              # ends before the names field
    _edge(names="Type ParentCategory,5;{N},9"),
    _edge(names="Audio Described,5;Capistrano Unified School District,7;{N},9;Some Category,11"),
    _edge(names="Foo,1;49ers,22"),                   # the delimiter eats digits
    _edge(names=",5;{N},9"),                         # leading delimiter
    _edge(names=",5;"),                              # delimiters only
    _edge(names='"{N}",4'),                          # text after a closing quote
    _edge(names='"{N},4"'),                          # quoted
    _edge(names='"{N} ""Jr"",4"'),                   # doubled quotes
    _edge(names='"{N} \\"Jr\\",4"'),                 # escaped quotes
    _edge(names='"{N},4'),                           # quote never closed
    _edge(names='"{N},4\\"'),                        # its closing quote escaped
    _edge(stype='"2"'),
    _edge(key="1- 2"),
    _edge(key="1.1-2"),
    _edge(key="{K}-"),
    _edge(key="{S}-{K}-"),
    _edge(key="-{K}"),
    _edge(key=""),
    _edge(key="9999999999999999999-1"),              # beyond a long
]
# ---- end of fixed values -----------------------------------------------------


def packed_names(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """``id, ts, allnames`` - one packed name list per order and block of line numbers."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("pname"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    block = F.floor((F.col("l_linenumber") - 1) / F.lit(LINES)).alias("block")
    text = F.concat("pname", F.lit(","), F.col("l_linenumber").cast("string")).alias("item")
    # Sorted by (line number, name); the text is made before, so that no lambda runs per item.
    items = (li.join(part, li.l_partkey == part.p_partkey)
             .groupBy("l_orderkey", block)
             .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "pname", text))).alias("items")))
    packed = F.array_join(F.col("items.item"), ";")
    ts = F.col("o_orderdate")
    if grain == "month":
        ts = F.date_trunc("month", ts)
    return (orders.join(items, orders.o_orderkey == items.l_orderkey)
                  .select((F.col("o_orderkey").cast("long") * ID_SPAN + F.col("block")).alias("id"),
                          ts.cast("timestamp_ntz").alias("ts"), packed.alias("allnames")))


def edge_lines(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """``id, value`` - one line per customer, by turns each of ``EDGE_LINES``."""
    key = F.col("c_custkey").cast("long")
    day = F.date_add(F.lit(EDGE_DAY).cast("date"), F.pmod(key, F.lit(365)).cast("int"))
    if grain == "month":
        day = F.date_trunc("month", day)
    line = F.get(F.array(*[F.lit(x) for x in EDGE_LINES]), F.pmod(key, F.lit(len(EDGE_LINES))).cast("int"))
    for mark, value in (("{S}", F.date_format(day, "yyyyMMddHHmmss")), ("{K}", F.col("id").cast("string")),
                        ("{N}", F.col("c_name"))):
        line = F.replace(line, F.lit(mark), value)
    d = table(spark, sf_dir, "customer").select("c_custkey", "c_name", (key * ID_SPAN + ID_SPAN // 2).alias("id"))
    return d.select("id", line.alias("value"))


def article_lines(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """``id, value`` - one TAB separated line per article, and the edge lines."""
    g = packed_names(spark, sf_dir, grain)
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    amounts = F.when(F.col("id") % 3 == 0, F.lit("am")).otherwise(F.lit(""))
    fields = ([F.concat(stamp, F.lit("-"), F.col("id").cast("string")), stamp, F.lit("1")]
              + [F.lit("")] * 20 + [F.col("allnames"), amounts, F.lit(""), F.lit("")])
    return g.select("id", F.concat_ws("\t", *fields).alias("value")).unionByName(edge_lines(spark, sf_dir, grain))


def event_mentions(spark: SparkSession, sf_dir: str, name: str = "event_type") -> DataFrame:
    """``id, ts, name`` from ``events`` (name = event type or user id)."""
    ev = table(spark, sf_dir, "events")
    nm = F.col(name).cast("string")
    return ev.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"),
                     nm.alias("name"))
