"""Merkle manifest of a dataset: a content-addressed graph, proofs by descent.

Every document is a leaf. Within a language the leaves ascend by doc_id; every
``ARITY`` consecutive nodes (the last run may be shorter) become one parent
until one node is left, the language's subroot. The subroots, in the order of
the languages, are the leaves of one more tree, whose top is the dataset's root.

The graph is stored as records digest -> children, one folder per height. A
proof is found by descending from the root: the digits of a leaf's rank select
one child at each height and the other children are collected. Requests that
share digits descend as one row, and a request gets a row of its own only at
the last height, so a level moves one row per node. The collected segments are
then reversed, leaf first.

Ranks come from a range-partitioned table: rows are numbered within its
partitions, and a running sum over the partitions' row counts gives each
partition its start, so a language with a third of all rows is no single task.

Edge cases: a null field counts as ``-``; a null doc_id comes first and is never
tampered with; equal doc_ids are ordered by their leaf digest, so repeated rows
are leaves of their own and any order of them gives the same digests; a null
language comes before all others; a lone document is its own subroot and root,
its proof the digest of nothing; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, shared_folder, shuffles_removed, stored

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 3                # leaves whose crc32 of the doc_id this divides are checked with changed text


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(columns[c]) for c in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, leaf, checked``: each row's digest and the one to check it
    with, which is made from a lower-cased text where the row is tampered with."""
    columns = {c: F.col(c) for c in FIELDS}
    changed = leaf_digest({**columns, "text": ascii_lower(F.col("text"))})
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    # A key that sorts like the language, null first.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    d = docs.select("doc_id", tree.alias("tree"), leaf_digest(columns).alias("leaf"),
                    F.when(tampered, changed).alias("__changed"))
    return d.withColumn("checked", F.coalesce("__changed", "leaf")).drop("__changed")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``idx``, the place of a row within its ``tree`` in ``order`` (from 0), and ``n``,
    the tree's number of rows. Equal rows may change places."""
    # The last key spreads rows that are equal in all else.
    placed = stored(rows.withColumn("__even", F.rand(11)).repartitionByRange("tree", *order, "__even").drop("__even")
                        .withColumn("__part", F.spark_partition_id()))
    counts = placed.groupBy("tree", "__part").agg(F.count(F.lit(1)).alias("__n"))
    tree = Window.partitionBy("tree")
    before = F.sum("__n").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("tree", "__part", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(tree).alias("n"))
    within = F.row_number().over(Window.partitionBy("tree", "__part").orderBy(*order)) - 1
    return (placed.withColumn("__within", within).join(starts, ["tree", "__part"])
                  .withColumn("idx", (F.col("__before") + F.col("__within")).cast("long"))
                  .drop("__part", "__within", "__before"))


@dataclass
class Graph:
    """Records digest -> children under ``folder/height=h`` for h from 1 to ``height``,
    and ``tops``: ``tree, subroot, height, size``, one row for each tree."""

    folder: str
    height: int
    tops: DataFrame

    def records(self, spark, height: int) -> DataFrame:
        """The records of a height, each digest once."""
        r = spark.read.parquet(f"{self.folder}/height={height}").select("digest", "children")
        return r.groupBy("digest").agg(F.first("children").alias("children"))


def build(nodes: DataFrame, arity: int = ARITY) -> Graph:
    """The trees over ``tree, idx, n, digest`` (a row per leaf), height by height."""
    spark = nodes.sparkSession
    folder = f"{shared_folder(spark)}/graph-{uuid.uuid4().hex}"
    most = nodes.agg(F.max("n")).first()[0] or 0
    top = F.col("n") == 1
    heights = [nodes]
    height = 0
    while most > 1:
        height += 1
        inner = heights[-1].where(~top)
        run = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        level = (inner.groupBy("tree", F.ceil(F.col("n") / arity).cast("long").alias("n"), F.expr(f"idx div {arity}").alias("idx"))
                      .agg(run.alias("run"))
                      .select("tree", "n", "idx", F.transform("run", lambda x: x["digest"]).alias("children"))
                      .withColumn("digest", F.sha2(F.array_join("children", ""), 256)))
        path = f"{folder}/height={height}"
        with shuffles_removed(spark):
            level.write.parquet(path)
        heights.append(spark.read.parquet(path))
        most = -(-most // arity)
    tops = None
    for h, level in enumerate(heights):
        # A tree of this height has between arity ** (h - 1) + 1 and arity ** h leaves.
        t = level.where(top).select("tree", F.col("digest").alias("subroot"), F.lit(h).alias("height"))
        tops = t if tops is None else tops.unionByName(t)
    return Graph(folder, height, tops)


def descend(graph: Graph, starts: DataFrame, requests: DataFrame, keep: list[str], every: bool = False,
            arity: int = ARITY) -> DataFrame:
    """Paths from the tops of the trees to the wanted leaves.

    ``starts``: ``tree, digest, height, path`` and the columns ``keep`` of each tree, where
    ``path`` holds what was collected above it. ``requests``: ``tree, idx`` of the wanted
    leaves and any other columns; ``every`` says that no leaf is missing among them. Returns
    the requests with ``keep`` and ``path``: segments (left, right), from the top down, of the
    digests before and behind the one selected."""
    spark = starts.sparkSession
    columns = ["tree", *keep, "path", "digest", "idx"]
    tops = starts.withColumn("idx", F.lit(0).cast("long"))
    lone = tops.where(F.col("height") == 0).select("tree", *keep, "path", "idx")
    out = requests.join(lone, ["tree", "idx"])
    if not graph.height:
        return out

    def grown(digit: Column) -> Column:
        left = F.array_join(F.slice("children", F.lit(1), digit), "")
        right = F.array_join(F.slice("children", digit + 2, F.lit(arity)), "")
        return F.array_append("path", F.struct(left.alias("left"), right.alias("right"))).alias("path")

    frontier = tops.where(F.col("height") == graph.height).select(*columns)
    for h in range(graph.height, 1, -1):
        opened = (frontier.join(graph.records(spark, h), "digest")
                          .select("tree", *keep, "path", "idx", "children", F.posexplode("children").alias("__digit", "digest")))
        frontier = opened.select("tree", *keep, grown(F.col("__digit")), "digest",
                                 (F.col("idx") * arity + F.col("__digit")).alias("idx"))
        if not every:       # only nodes above a wanted leaf are opened further
            above = requests.select("tree", F.expr(f"idx div {arity ** (h - 1)}").alias("idx")).distinct()
            frontier = frontier.join(above, ["tree", "idx"], "left_semi").select(*columns)
        frontier = stored(frontier.unionByName(tops.where(F.col("height") == h - 1).select(*columns)))
    last = frontier.join(graph.records(spark, 1), "digest").drop("digest").withColumnRenamed("idx", "__run")
    asked = requests.withColumn("__run", F.expr(f"idx div {arity}"))
    rows = asked.join(last, ["tree", "__run"]).withColumn("__digit", (F.col("idx") % arity).cast("int"))
    return rows.select(*requests.columns, *keep, grown(F.col("__digit"))).unionByName(out.select(*requests.columns, *keep, "path"))


def proofs(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root, verified`` of every document.

    ``proof`` is the path from the leaf up: segments (left, right) of the siblings' digests."""
    rows = ranked(stored(leaves(docs)), ["doc_id", "leaf"])
    rows = stored(rows)
    graph = build(rows.select("tree", "idx", "n", F.col("leaf").alias("digest")), arity)
    tops = stored(graph.tops)
    # The tree over the subroots: its leaves are the languages.
    langs = stored(ranked(tops.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "subroot", "height"), ["lang"]))
    upper = build(langs.select("tree", "idx", "n", F.col("subroot").alias("digest")), arity)
    empty = F.array().cast("array<struct<left:string,right:string>>")
    root = upper.tops.select("tree", F.col("subroot").alias("digest"), F.col("subroot").alias("root"), "height", empty.alias("path"))
    asked = langs.select("tree", "idx", "lang", "subroot", F.col("height").alias("__height"))
    starts = descend(upper, root, asked, ["root"], True, arity)
    starts = stored(starts.select(F.col("lang").alias("tree"), F.col("subroot").alias("digest"), "subroot", "root",
                                  F.col("__height").alias("height"), "path"))
    found = descend(graph, starts, rows.select("tree", "idx", "doc_id", "leaf", "checked"), ["subroot", "root"], True, arity)
    up = found.withColumn("proof", F.reverse("path")).drop("path")
    fold = F.aggregate("proof", F.col("checked"), lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))
    return (up.withColumn("folded_root", fold).withColumn("verified", F.col("folded_root") == F.col("root"))
              .drop("tree", "idx", "checked"))


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof as one text, leaf first, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """The contract's rows: :func:`proofs` with the proof as one digest."""
    return proofs(docs, arity).select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
                                      "folded_root", "verified")



_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_leaf(text: str) -> str:
    fields = [f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')" for x in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


# DuckDB has no crc32: each digit is folded in, then eight shifts, marked by -1.
_SQL_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, {_sql_leaf('text')} AS leaf,
         CASE WHEN {_SQL_CRC} % {TAMPERED} = 0 THEN {_sql_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS changed FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM d),
up AS (
  SELECT tree, 0 AS h, idx, n, leaf AS dg FROM l
  UNION ALL SELECT tree, h + 1, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(dg, '' ORDER BY idx))
  FROM up WHERE n > 1 GROUP BY tree, h, n, idx // {ARITY}),
sub AS (SELECT tree, dg AS subroot FROM up WHERE n = 1),
lg AS (SELECT tree, subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM sub),
up2 AS (
  SELECT '' AS tree, 0 AS h, idx, n, subroot AS dg FROM lg
  UNION ALL SELECT tree, h + 1, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(dg, '' ORDER BY idx))
  FROM up2 WHERE n > 1 GROUP BY tree, h, n, idx // {ARITY}),
seg AS (SELECT a.tree, a.h, a.idx, coalesce(string_agg(b.dg, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lft,
               coalesce(string_agg(b.dg, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rgt
        FROM up a JOIN up b ON a.tree = b.tree AND a.h = b.h AND a.idx // {ARITY} = b.idx // {ARITY} WHERE a.n > 1 GROUP BY 1, 2, 3),
seg2 AS (SELECT a.h, a.idx, coalesce(string_agg(b.dg, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lft,
                coalesce(string_agg(b.dg, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rgt
         FROM up2 a JOIN up2 b ON a.h = b.h AND a.idx // {ARITY} = b.idx // {ARITY} WHERE a.n > 1 GROUP BY 1, 2),
fold AS (
  SELECT r, tree, 0 AS h, idx, coalesce(changed, leaf) AS dg, '' AS proof FROM l
  UNION ALL SELECT f.r, f.tree, f.h + 1, f.idx // {ARITY}, sha256(s.lft || f.dg || s.rgt), f.proof || s.lft || s.rgt
  FROM fold f JOIN seg s ON f.tree = s.tree AND f.h = s.h AND f.idx = s.idx),
mid AS (SELECT r, arg_max(dg, h) AS dg, arg_max(proof, h) AS proof FROM fold GROUP BY r),
fold2 AS (
  SELECT m.r, 0 AS h, lg.idx, m.dg, m.proof FROM mid m JOIN l ON m.r = l.r JOIN lg ON l.tree = lg.tree
  UNION ALL SELECT f.r, f.h + 1, f.idx // {ARITY}, sha256(s.lft || f.dg || s.rgt), f.proof || s.lft || s.rgt
  FROM fold2 f JOIN seg2 s ON f.h = s.h AND f.idx = s.idx),
fin AS (SELECT r, arg_max(dg, h) AS folded_root, arg_max(proof, h) AS proof FROM fold2 GROUP BY r),
top AS (SELECT dg AS root FROM up2 WHERE n = 1)
SELECT l.doc_id, l.leaf, sub.subroot, top.root, sha256(fin.proof) AS proof_sha256, fin.folded_root, fin.folded_root = top.root AS verified
FROM l JOIN sub ON l.tree = sub.tree JOIN fin ON l.r = fin.r, top
"""
