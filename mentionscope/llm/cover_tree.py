"""Embedding near duplicates by dual traversal of cover trees.

Unit vectors with cosine >= 0.9 are at most sqrt(0.2) apart. A few pivots from a
bounded sample are the top level; every vector belongs to its nearest
pivot's cell, large cells are cut into blocks, and each block gets nested
levels with halving radii (1, then 1/2, then the vectors). Two trees are
traversed together: a pair of nodes is given up when their centres are further
apart than both covering radii and the threshold. Products are made in single
precision with a bound on their error; what it leaves open is decided in
double precision, so the pairs found are exactly those of the threshold.

Equal vectors are one weighted class (named by a 64-bit hash) before any comparison. Tasks return link
counts and a spanning forest of the links, never the pairs of a dense group.

Bounds: pivots come from at most ``SAMPLE`` vectors, drawn by hash; every
vector is indexed and the result is exact whatever the pivots.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing (own component); vectors of different lengths
never link; repeated rows are vectors of their own; rows without vec_id get no
links and no component; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import components

COSINE = 0.9
SAMPLE, BLOCK, MOST_CELLS = 4096, 8192, 256
SLACK = 1e-9


def units(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: the unit vector as doubles in bytes, null where it links with nothing."""
    def run(batches):
        for batch in batches:
            out = []
            for x in batch.column(1):
                a = np.array(x.as_py() or [0.0], dtype=object)
                try:
                    a = a.astype(np.float64)
                except TypeError:  # a null component
                    a = np.array([np.nan])
                top = np.abs(a).max() if np.isfinite(a).all() else 0.0
                if top > 0:
                    a = a / top
                    out.append((a / np.sqrt(a @ a)).tobytes())
                else:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "v"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, v binary")


def _matrix(column) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1) if raw else np.zeros((0, 1))


def far_pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first pivots: each next one is the point least covered so far."""
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < count and far.max() > SLACK:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def _slack(points: np.ndarray) -> float:
    """Most that a product of unit vectors may be off in single precision."""
    return 2.4e-7 * (points.shape[1] + 8)


def cover(points: np.ndarray, radius: float, rows: int = 256) -> np.ndarray:
    """Greedy net: the index of the centre that covers each point, first come first
    served. Products are made for ``rows`` candidates at a time, in single precision:
    radii are measured afterwards, so a point at the very edge may fall to either side."""
    owner = np.full(len(points), -1)
    single = points.astype(np.float32)
    left = np.arange(len(points))
    while len(left):
        near = single[left[:rows]] @ single[left].T >= 1 - radius * radius / 2
        own = np.full(len(left), -1)
        for r in range(len(near)):
            if own[r] < 0:
                own[near[r] & (own < 0)] = r
                own[r] = r
        done = own >= 0
        owner[left[done]] = left[own[done]]
        left = left[~done]
    return owner


def build(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres at radius 1 and, within each of those nodes, at radius 1/2 (indices per point)."""
    coarse = cover(points, 1.0)
    fine = np.arange(len(points))
    order = np.argsort(coarse, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(coarse[order])) + 1):
        if len(part) > 1:
            fine[part] = part[cover(points[part], 0.5)]
    return coarse, fine


class Tree:
    """A block's points with their nodes: centres, covering radii, members. Nodes are
    numbered in order of their radius."""

    def __init__(self, points: np.ndarray, coarse: np.ndarray, fine: np.ndarray) -> None:
        self.points = points
        self.single = points.astype(np.float32)
        self.fine_ids, self.fine, self.fine_radius = self._nodes(fine)
        self.coarse_ids, point_coarse, self.coarse_radius = self._nodes(coarse)
        self.fine_coarse = point_coarse[self.fine_ids]

    def _nodes(self, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, node = np.unique(centre, return_inverse=True)
        d = np.sqrt(((self.points - self.points[centre]) ** 2).sum(1))
        radius = np.zeros(len(ids))
        np.maximum.at(radius, node, d)
        order = np.argsort(radius, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        return ids[order], place[node], radius[order]


def _near(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray, reach: float, slack: float) -> np.ndarray:
    """Node pairs that the covering radii do not rule out, by products in single
    precision. The columns (in order of radius) are taken in runs, each under its largest radius."""
    out = a @ b.T
    near = np.empty(out.shape, bool)
    zero = int(np.searchsorted(rb, SLACK, "right"))
    edges = [0, *np.linspace(zero, len(rb), 9).astype(int)]
    for lo, hi in zip(edges[:-1], edges[1:]):
        if hi > lo:
            bound = np.minimum(ra + rb[hi - 1] + reach + 1e-7, 2.0)
            least = (1 - bound * bound / 2 - slack).astype(np.float32)
            np.greater_equal(out[:, lo:hi], least[:, None], out=near[:, lo:hi])
    return near


def _links(a: Tree, part: np.ndarray, b: Tree, cols: np.ndarray, cosine: float, slack: float) -> np.ndarray:
    """Links of points: products in single precision decide the clear pairs, those
    within the slack of the threshold are decided in double precision."""
    s = a.single[part] @ b.single[cols].T
    links = s >= np.float32(cosine + slack)
    i, j = np.nonzero((s >= np.float32(cosine - slack)) & ~links)
    for k in range(0, len(i), 1 << 16):
        x, y = i[k: k + (1 << 16)], j[k: k + (1 << 16)]
        links[x, y] = np.einsum("ij,ij->i", a.points[part[x]], b.points[cols[y]]) >= cosine
    return links


def linked_pairs(a: Tree, b: Tree, cosine: float = COSINE, rows: int = 512):
    """Yields (rows of a, columns of b, boolean matrix of links), by dual traversal.
    As nodes come in order of their radius, single points, which few nodes of b are
    near to, do not share a step with wide nodes."""
    reach = float(np.sqrt(2 - 2 * cosine))
    slack = _slack(a.points)
    for first in range(0, len(a.coarse_ids), rows):
        block = slice(first, first + rows)
        coarse = _near(a.single[a.coarse_ids[block]], a.coarse_radius[block], b.single[b.coarse_ids], b.coarse_radius, reach, slack)
        fine_b = np.flatnonzero(coarse.any(0)[b.fine_coarse])
        fine_all = np.flatnonzero((a.fine_coarse >= first) & (a.fine_coarse < first + rows))
        if not len(fine_b):
            continue
        for at in range(0, len(fine_all), rows):
            fine_a = fine_all[at: at + rows]
            near = _near(a.single[a.fine_ids[fine_a]], a.fine_radius[fine_a], b.single[b.fine_ids[fine_b]], b.fine_radius[fine_b], reach, slack)
            use_a, use_b = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if not len(use_a):
                continue
            in_a, in_b = np.zeros(len(a.fine_ids), bool), np.zeros(len(b.fine_ids), bool)
            in_a[fine_a[use_a]] = True
            in_b[fine_b[use_b]] = True
            points_a, points_b = np.flatnonzero(in_a[a.fine]), np.flatnonzero(in_b[b.fine])
            for k in range(0, len(points_a), rows):
                part = points_a[k: k + rows]
                links = _links(a, part, b, points_b, cosine, slack)
                if links.any():
                    yield part, points_b, links


def compare(ids_a, weight_a, a: Tree, ids_b, weight_b, b: Tree | None):
    """Link counts per id and a spanning forest of the links between two blocks (or within one)."""
    same = b is None
    if same:
        ids_b, weight_b, b = ids_a, weight_a, a
    n = len(ids_a)
    ids = ids_a if same else np.concatenate([ids_a, ids_b])
    shift = 0 if same else n
    degree = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))
    edges = []
    for part, points_b, links in linked_pairs(a, b):
        if same:
            at = np.minimum(np.searchsorted(points_b, part), len(points_b) - 1)
            itself = np.flatnonzero(points_b[at] == part)
            links[itself, at[itself]] = False
        row, col = np.nonzero(links)
        if not len(row):
            continue
        col = points_b[col]
        np.add.at(degree, part[row], weight_b[col])
        if not same:
            np.add.at(degree, col + shift, weight_a[part[row]])
        for k in np.split(np.arange(len(row)), np.flatnonzero(np.diff(row)) + 1):
            r, cols = part[row[k[0]]], col[k] + shift
            other, at = np.unique(root[cols], return_index=True)
            fresh = other != root[r]
            for o, c in zip(other[fresh], cols[at[fresh]]):
                edges.append((ids[r], ids[c]))
                root[root == o] = root[r]
    some = np.flatnonzero(degree)
    return ids[some], degree[some], edges


def link_table(classes: DataFrame) -> DataFrame:
    """``rep, weight, v`` (distinct unit vectors) -> ``a, b, n``: links (b is null, n the
    weight of the other classes linked) and spanning edges (a, b)."""
    spark = classes.sparkSession
    size_of = F.length("v")
    # Lengths with more vectors than a block holds have a plan each; all others, one block each, share one.
    lengths = classes.groupBy(size_of.alias("bytes")).agg(F.count(F.lit(1)).alias("n"))
    large = [r["bytes"] for r in lengths.where(F.col("n") > BLOCK).collect()]

    def alone(rows: pa.Table) -> pa.Table:
        x = _matrix(rows.column("v"))
        ids, degree, edges = compare(rows.column("rep").to_numpy(), rows.column("weight").to_numpy(), Tree(x, *build(x)), None, None, None)
        a, b = ([e[0] for e in edges], [e[1] for e in edges])
        return pa.table({"a": pa.array([*ids, *a], pa.int64()), "b": pa.array([*([None] * len(ids)), *b], pa.int64()),
                         "n": pa.array([*degree, *([0] * len(a))], pa.int64())})

    small = classes.where(~size_of.isin(large)) if large else classes
    parts = [small.withColumn("bytes", size_of).groupBy("bytes").applyInArrow(alone, "a long, b long, n long")]
    for size in sorted(large):
        of = classes.where(F.length("v") == size)
        n = of.count()
        drawn = of.orderBy(F.xxhash64("v"), "rep").limit(SAMPLE).toArrow()
        pivots = far_pivots(_matrix(drawn.column("v")), max(1, min(MOST_CELLS, -(-n // BLOCK))))
        sent = spark.sparkContext.broadcast(pivots)

        def assign(batches, sent=sent):
            for batch in batches:
                x = _matrix(batch.column("v"))
                d2 = np.maximum(2 - 2 * (x @ sent.value.T), 0) if len(x) else np.zeros((0, 1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d2.argmin(1).astype(np.int32)), pa.array(np.sqrt(d2.min(1)))],
                                                 [*batch.schema.names, "cell", "far"])

        placed = of.mapInArrow(assign, "rep long, weight long, v binary, cell int, far double")
        cells = {r["cell"]: (r["n"], r["far"]) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
        # Blocks: cells, cut by hash where they are large.
        cut_into = {c: -(-k // BLOCK) for c, (k, _) in cells.items()}
        start, total = {}, 0
        for c in sorted(cells):
            start[c], total = total, total + cut_into[c]
        first = F.element_at(F.create_map(*[F.lit(x) for c in start for x in (c, start[c])]), F.col("cell"))
        many = F.element_at(F.create_map(*[F.lit(x) for c in cut_into for x in (c, cut_into[c])]), F.col("cell"))
        block = (first + F.pmod(F.xxhash64("v"), many)).cast("int")

        def tree(rows: pa.Table) -> pa.Table:
            coarse, fine = build(_matrix(rows.column("v")))
            return pa.table({"rep": rows.column("rep"), "weight": rows.column("weight"), "v": rows.column("v"), "block": rows.column("block"),
                             "coarse": pa.array(coarse, pa.int32()), "fine": pa.array(fine, pa.int32()),
                             "at": pa.array(np.arange(len(coarse)), pa.int32())})

        trees = placed.select("rep", "weight", "v", block.alias("block")).groupBy("block").applyInArrow(
            tree, "rep long, weight long, v binary, block int, coarse int, fine int, at int")
        trees = cut(trees)
        # Pairs of cells that the covering radii leave, by blocks.
        reach = float(np.sqrt(2 - 2 * COSINE)) + 1e-7
        d = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
        met = {c: [e for e in cells if d[c, e] <= cells[c][1] + cells[e][1] + reach] for c in cells}
        near = F.element_at(F.create_map(*[x for c in met for b in range(start[c], start[c] + cut_into[c])
                                           for x in (F.lit(b), F.array(*[F.lit(start[e]) for e in met[c]]))]), F.col("block"))
        spans = F.create_map(*[F.lit(x) for c in start for x in (start[c], start[c] + cut_into[c] - 1)])
        others = F.flatten(F.transform(near, lambda s: F.sequence(s, F.element_at(spans, s))))
        rows = trees.withColumn("other", F.explode(others))
        rows = rows.withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other")).drop("other")

        def pair(group: pa.Table) -> pa.Table:
            def side(k):
                t = group.filter(pc.equal(group.column("block"), k)).sort_by("at")
                return (t.column("rep").to_numpy(), t.column("weight").to_numpy(),
                        Tree(_matrix(t.column("v")), t.column("coarse").to_numpy(), t.column("fine").to_numpy()))
            p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
            one = side(p)
            two = side(q) if p != q else (None, None, None)
            ids, degree, edges = compare(*one, *two)
            a, b = ([e[0] for e in edges], [e[1] for e in edges])
            return pa.table({"a": pa.array([*ids, *a], pa.int64()), "b": pa.array([*([None] * len(ids)), *b], pa.int64()),
                             "n": pa.array([*degree, *([0] * len(a))], pa.int64())})

        parts.append(rows.groupBy("p", "q").applyInArrow(pair, "a long, b long, n long"))
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    d = cut(units(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")))
    good = d.where("v is not null and vec_id is not null")
    classes = cut(good.groupBy("v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
                  .select(F.xxhash64("v").alias("rep"), "weight", "v", "least"))
    found = cut(link_table(classes.drop("least")))
    degree = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    linked = components(found.where("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v")))
    info = (classes.join(degree, F.col("rep") == F.col("a"), "left").join(linked, F.col("rep") == F.col("node"), "left")
            .select(F.col("v").alias("__v"), "least", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                    F.coalesce("component", "rep").alias("c")))
    info = cut(info)
    names = info.groupBy("c").agg(F.min("least").alias("component_id"))
    some = good.join(info.join(names, "c"), F.col("v") == F.col("__v")).select("vec_id", "n_links", "component_id")
    none = d.where("v is null or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return some.union(none).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ORACLE_SQL = """
WITH RECURSIVE x AS (SELECT vec_id, list_transform(embedding, lambda c: c::DOUBLE) AS v FROM embeddings),
u AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda c: c * c))) AS norm,
             v IS NOT NULL AND len(v) > 0 AND coalesce(list_bool_and(list_transform(v, lambda c: c IS NOT NULL AND isfinite(c))), false) AS fine FROM x),
g AS (SELECT vec_id, v, norm FROM u WHERE fine AND norm > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.vec_id),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT r.vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(c) AS component_id, r.vec_id = min(c) AS kept
FROM r LEFT JOIN n ON n.a = r.vec_id GROUP BY r.vec_id
"""
