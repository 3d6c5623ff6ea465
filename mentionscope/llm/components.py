"""Connected components of a table of links, by alternating large-star and
small-star steps. Links lead from the greater node to the lesser one. Each step
is a grouped minimum (combined before the shuffle) and a join, and every round is
checkpointed, so no node's links meet in one group and nothing is collected. A
round's table is written in partitions of ``ROWS`` links, however many the
shuffles have, and its shuffle files go when it ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shuffles_removed

ROWS = 1 << 18


def _least(links: DataFrame, node: str) -> DataFrame:
    """The least of each node's lesser neighbours."""
    return links.groupBy(F.col("u").alias(node)).agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each greater neighbour of a node is linked to the least of the node and its neighbours
    (links may repeat)."""
    least = _least(links, "node")
    return links.join(least, F.col("v") == F.col("node"), "left").select("u", F.coalesce("m", "v").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and each lesser neighbour are linked to the least of these."""
    met = links.join(_least(links, "node"), F.col("u") == F.col("node"))
    ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
    return met.select(F.inline(ends)).where("u <> v").distinct()


def components(links: DataFrame, rows: int = ROWS) -> DataFrame:
    """``u, v`` (links between longs, any order, repeats allowed) -> ``node, component``,
    the least node reachable, for every node that has a link to another one."""
    low, high = F.least("u", "v"), F.greatest("u", "v")

    def seen(d):
        r = d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    with shuffles_removed(links.sparkSession):
        now = cut(links.where("u <> v").select(high.alias("u"), low.alias("v")).distinct())
        before = seen(now)
        while before[0]:
            now = cut(_small_star(_large_star(now)).coalesce(-(-before[0] // rows)))
            after = seen(now)
            if after == before:
                break
            before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
