"""Mixing sources to target weights by systematic sampling (DataFrame only).

Every document of a source has the same expected number of copies, target
over source size. The expected copies are prefix-summed within the source, one
random offset is added, and a document is emitted once for each integer
boundary that its interval crosses. Documents are ordered by size class first,
so each class gets its share and the words taken stay near the target.

The prefix sums of a source are split: running numbers within small buckets
(source, size class, hash prefix) and a sum over the bucket counts, so a source
with a third of all rows is no single task.

Edge cases: null text has size 0; a null source is a source of its own, last in
order; repeated rows are documents of their own; an empty table gives an empty
result; an input column named like an output column is replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import word_count

WEIGHTS = (3, 1, 2)
SHARE, CAP, SEED = 1.5, 2.0, "mix"


def offset(seed: str) -> float:
    """The one random offset in [0, 1), fixed by the seed so that reruns agree."""
    return int(hashlib.sha256(seed.encode()).hexdigest()[:12], 16) / float(1 << 48)


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``__key, source, source_size`` -> also ``target`` and ``rate``.

    Sharing the excess again until no source is above its cap is a water level:
    with the sources ordered by cap over weight, the level after the first k are
    capped is (total - their caps) / (weights left)."""
    one = Window.partitionBy(F.lit(0))
    order = one.orderBy(F.col("source").isNull(), "source")
    rank = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank + 1).cast("int"))
    s = sizes.withColumn("__w", weight.cast("double")).withColumn("__cap", F.col("source_size") * F.lit(float(cap)))
    s = s.withColumn("__ratio", F.col("__cap") / F.col("__w"))
    by = one.orderBy("__ratio", F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("__cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("__w").over(by.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(one) * F.lit(float(share))
    s = s.withColumn("__level", (total - before) / left)
    # The level at the first source that it does not fill.
    found = F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__level"))).over(one)
    s = s.withColumn("__found", found)
    full = F.col("__found").isNull() | (F.col("__ratio") < F.col("__found.__ratio"))
    target = F.when(full, F.col("__cap")).otherwise(F.col("__found.__level") * F.col("__w"))
    target = F.least(target, F.col("__cap"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return s.select("__key", "source_size", target.alias("target"), rate.alias("__rate"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with ``size``, ``source_size``,
    ``target`` (words wanted of its source), ``copies`` and ``taken``
    (copies times size); one row per input row."""
    size = F.col("__size")
    bits = F.length(F.bin(size))
    d = docs.drop("size", "source_size", "target", "copies", "taken")
    d = (d.withColumn("__size", word_count(F.col("text")))
          .withColumn("__key", _key(F.col("source")))
          .withColumn("__order", F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")),
                                                   F.md5(F.coalesce("text", F.lit("")))))))
    d = (d.withColumn("__class", bits * 8 + F.expr("shiftright(__size, greatest(length(bin(__size)), 3) - 3)").cast("int"))
          .withColumn("__part", F.substring("__order", 1, 2)))
    bucket = ["__key", "__class", "__part"]
    counts = d.groupBy(*bucket).agg(F.count(F.lit(1)).alias("__n"), F.sum("__size").alias("__words"),
                                    F.first("source").alias("source"))
    sizes = counts.groupBy("__key").agg(F.sum("__words").alias("source_size"), F.first("source").alias("source"))
    ahead = Window.partitionBy("__key").orderBy("__class", "__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("__before", F.coalesce(F.sum("__n").over(ahead), F.lit(0)))
                    .select(*bucket, "__before")
                    .join(targets(sizes, weights, share, cap), "__key"))
    within = F.row_number().over(Window.partitionBy(*bucket).orderBy("__order", "__size"))
    d = d.withColumn("__i", within).join(starts, bucket)
    i, u = F.col("__before") + F.col("__i"), F.lit(offset(seed))
    copies = F.floor(i * F.col("__rate") + u) - F.floor((i - 1) * F.col("__rate") + u)
    return (d.withColumn("copies", copies.cast("long"))
             .withColumn("taken", F.col("copies") * F.col("__size"))
             .withColumnRenamed("__size", "size")
             .drop("__key", "__order", "__class", "__part", "__i", "__before", "__rate"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, numbered in ``copy``."""
    return (mixed.where("copies > 0").drop("copy")
                 .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(length(text) - length(text) + len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || md5(coalesce(text, ''))) AS o FROM documents),
b AS (SELECT *, length(bin(size)) * 8 + (size >> (greatest(length(bin(size)), 3) - 3)) AS cls FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM b GROUP BY source),
w AS (SELECT *, CAST([{', '.join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS DOUBLE) AS w,
             source_size * {CAP}::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / w AS ratio,
             (sum(source_size) OVER ()::DOUBLE * {SHARE}::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT ratio AS fr, level AS fl FROM l WHERE level <= ratio ORDER BY ratio, level LIMIT 1),
t AS (SELECT source, source_size, least(CASE WHEN fr IS NULL OR ratio < fr THEN cap ELSE fl * w END, cap) AS target FROM l LEFT JOIN f ON true),
r AS (SELECT b.doc_id, b.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             row_number() OVER (PARTITION BY b.source ORDER BY cls, o, size) AS i
      FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(i * rate + {offset(SEED)!r}::DOUBLE) - floor((i - 1) * rate + {offset(SEED)!r}::DOUBLE)) * size AS BIGINT) AS taken FROM r
"""
