"""Near duplicates by a size-aware heavy-light join on word 5-grams.

Two sets link when 100 * |intersection| >= 80 * |union|. Both then share at
least ceil(0.8 n) elements, so in any common order of all shingles the first
n - ceil(0.8 n) + k elements of each set (its prefix) share k of them. Small
sets enumerate the 2-subsets of their prefix (k = 2) as keys; large sets, and
small ones that may pair with a large one, are entered in inverted lists by
single prefix elements (k = 1). The boundary between small and large is where
enumerating costs as much as scanning, from the measured collisions.

The order puts shingles that a sketch of fixed size finds frequent last, so
common passages stay out of the prefixes; it never drops anything.

Equal sets are one class before any join. Lists are cut into bands of
compatible size, each with a hub; members are compared with their hub first,
and after the components of these links are known, only pairs of different
components in one list are left. Groups of thousands of near copies thus cost
a few comparisons a member, and no link between different components is lost.
Keys that the sketch knows to be frequent are salted, each part with a hub.

Edge cases: null, empty or blank text has an empty set, linked with nothing;
texts under five words are one shingle, the whole sequence; rows with equal
doc_id or equal text each get their row; a row with null doc_id takes part, but
names no component unless all its members are null; empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, WORD, cut, lower_words, mix64, offset_slices, shuffles_removed
from .components import components

K = 5
SLOTS, MOST_SLOTS, SLOT_BLOCK = 1 << 20, 1 << 24, 4096
SALT_ROWS = 1000
LARGEST_BOUNDARY = 48
BINS = 512
SHORT, BLOCK = 16, 512
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(texts: list[bytes]):
    """(text index, 64-bit shingle) pairs, distinct, sorted by both."""
    doc, h = lower_words(texts)
    n = len(h)
    parts_d, parts_h = [], []
    if n >= K:
        whole = doc[K - 1:] == doc[: n - K + 1]
        x = np.zeros(n - K + 1, np.uint64)
        for j in range(K):
            x = x + h[j: n - K + 1 + j] * _STEP[j]
        parts_d.append(doc[: n - K + 1][whole])
        parts_h.append(mix64(x[whole]))
    counts = np.bincount(doc, minlength=len(texts)) if n else np.zeros(len(texts), int)
    ends = np.cumsum(counts)
    for d in np.flatnonzero((counts > 0) & (counts < K)):
        own = h[ends[d] - counts[d]: ends[d]]
        parts_d.append(np.array([d]))
        parts_h.append(mix64(np.array([(own * _STEP[: len(own)]).sum() ^ _STEP[len(own)]], np.uint64)))
    if not parts_d:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    d, x = np.concatenate(parts_d), np.concatenate(parts_h)
    order = np.lexsort((x, d))
    d, x = d[order], x[order]
    keep = np.ones(len(d), bool)
    keep[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    return d[keep], x[keep]


def set_classes(d: np.ndarray, x: np.ndarray, n_texts: int):
    """Set sizes and a 64-bit class per text: equal sets have equal classes."""
    size = np.bincount(d, minlength=n_texts)
    total = np.zeros(n_texts, np.uint64)
    if len(d):
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        total[d[first]] = np.add.reduceat(mix64(x ^ _STEP[1]), first)
    return size, mix64(total + size.astype(np.uint64) * _STEP[0]).view(np.int64)


def signatures(d: np.ndarray, x: np.ndarray, n_texts: int) -> list[bytes]:
    """Elements of each set by the top bits of their hash (255: that many or more).
    The sum of the lesser counts of two sets bounds their intersection from above."""
    out = np.empty((n_texts, BINS), np.uint8)
    ends = np.searchsorted(d, np.arange(n_texts + 1))
    bins = (x >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    for i in range(n_texts):
        out[i] = np.minimum(np.bincount(bins[ends[i]: ends[i + 1]], minlength=BINS), 255)
    return [row.tobytes() for row in out]


def least_shared(n):
    """ceil(0.8 n): what a set of n shares at least with any that it links to."""
    return (4 * n + 4) // 5


def _rows(arrays, names):
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)


def classes(docs: DataFrame) -> DataFrame:
    """The columns but ``text``, with the set's size ``n``, class ``cls`` and signature ``sig``."""
    rest = [c for c in docs.columns if c != "text"]
    spec = T.StructType([docs.schema[c] for c in rest] + [T.StructField("n", T.LongType()), T.StructField("cls", T.LongType()), T.StructField("sig", T.BinaryType())])

    def run(batches):
        for batch, texts in offset_slices(batches):
            d, x = shingles(texts)
            size, cls = set_classes(d, x, len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(size.astype(np.int64)), pa.array(cls),
                                              pa.array(signatures(d, x, len(texts)), pa.binary())], [*rest, "n", "cls", "sig"])

    return docs.mapInArrow(run, spec)


def sketch(docs: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """Documents per slot of the shingles' hash; ``slots`` numbers whatever the input.
    A task sends its counts in blocks, which are added up block by block."""
    def run(batches):
        held = np.zeros(slots, np.uint32)
        seen: list[np.ndarray] = []
        for _, texts in offset_slices(batches):
            seen.append((shingles(texts)[1] & np.uint64(slots - 1)).astype(np.uint32))
            if sum(map(len, seen)) > 2 << 20:
                _count(held, seen)
                seen = []
        _count(held, seen)
        blocks = held.reshape(-1, SLOT_BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([_pack(blocks[i]) for i in some], pa.binary())], ["block", "n"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[block] = total.get(block, 0) + _unpack(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([_pack(n) for n in total.values()], pa.binary())], ["block", "n"])

    parts = docs.select("text").mapInArrow(run, "block int, n binary")
    out = np.zeros((slots // SLOT_BLOCK, SLOT_BLOCK), np.uint32)      # at most 2^32 - 1: beyond it a slot is as frequent as can be
    for r in parts.repartition(slots // SLOT_BLOCK // 8, "block").mapInArrow(add, "block int, n binary").collect():
        out[r["block"]] = np.minimum(out[r["block"]] + _unpack(r["n"]), (1 << 32) - 1)
    return out.reshape(-1)


def _count(held: np.ndarray, seen: list[np.ndarray], block: int = 1 << 20) -> None:
    """Add the slots of ``seen`` to ``held``, a block of slots at a time."""
    if not seen:
        return
    at = np.sort(np.concatenate(seen)) if len(held) > block else np.concatenate(seen)
    edges = np.searchsorted(at, np.arange(0, len(held) + block, block)) if len(held) > block else [0, len(at)]
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        part = held[k * block:(k + 1) * block]
        part += np.bincount(at[a:b].astype(np.int64) - k * block, minlength=len(part)).astype(np.uint32)


def _pack(n: np.ndarray) -> bytes:
    """A block's counts, in as few bytes each as the greatest needs."""
    most = int(n.max())
    return n.astype(next(t for t in ("u1", "u2", "u4", "u8") if most <= np.iinfo(t).max)).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // SLOT_BLOCK}").astype(np.int64)


def boundary(counts: np.ndarray) -> int:
    """Largest set size whose 2-subsets cost no more than scanning its lists: a scan
    reads its prefix lists, with as many strangers as the sketch shows beyond chance."""
    total = counts.sum()
    if not total:
        return 0
    meet = float((counts.astype(float) ** 2).sum() / total - counts.mean())
    best = 0
    for n in range(2, LARGEST_BOUNDARY + 1):
        p = n - least_shared(n) + 1
        if (p + 1) * p / 2 <= p * (1 + meet):
            best = n
    return best


def keys(texts: list[bytes], counts: np.ndarray, limit: int):
    """Keys of a batch: (key, salt, class, set size), one text of each class. A key
    that the sketch finds frequent is salted by class; all others have salt -1."""
    d, x = shingles(texts)
    size, cls = set_classes(d, x, len(texts))
    if not len(d):
        return [np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int32)]
    _, one = np.unique(cls, return_index=True)  # one text of each class
    chosen = np.zeros(len(texts), bool)
    chosen[one] = True
    here = chosen[d]
    d, x = d[here], x[here]
    df = counts[(x & np.uint64(len(counts) - 1)).astype(np.int64)].astype(np.int64)
    floor = max(1.0, 2.0 * counts.mean())
    level = np.maximum(0, np.floor(np.log2(np.maximum(df, 1) / floor)) + 1).astype(np.int64)
    level[df < floor] = 0
    order = np.lexsort((x, level, d))
    d, x, level, df = d[order], x[order], level[order], df[order]
    first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
    n = np.diff(np.r_[first, len(d)])
    at = np.arange(len(d)) - np.repeat(first, n)
    prefix = n - least_shared(n) + 1
    salts = df // SALT_ROWS + 1
    out = []
    # Inverted lists of single elements, for all that may pair with a large set.
    listed = np.repeat((n >= least_shared(limit + 1)), n) & (at < np.repeat(prefix, n))
    out.append((x[listed], salts[listed], d[listed]))
    # 2-subsets of the small sets.
    small = np.flatnonzero((n <= limit) & (n >= 2))
    for i in range(int(prefix[small].max()) if len(small) else 0):
        for j in range(i + 1, int(prefix[small].max()) + 1):
            s = small[(prefix[small] + 1 > j) & (n[small] > j)]
            a, b = first[s] + i, first[s] + j
            lo, hi = np.minimum(x[a], x[b]), np.maximum(x[a], x[b])
            out.append((mix64(lo * _STEP[2] + hi * _STEP[3] + _STEP[4]), np.minimum(salts[a], salts[b]), d[a]))
    key, salt, owner = (np.concatenate([o[k] for o in out]) for k in range(3))
    c = cls[owner]
    part = (mix64(c.view(np.uint64)) % salt.astype(np.uint64)).astype(np.int32)
    salt = np.where(salt > 1, part, -1).astype(np.int32)
    return [key.view(np.int64), salt, c, size[owner].astype(np.int32)]


def _lists(batches):
    """Rows sorted by (key, salt, n, cls) -> the distinct rows of lists that have
    another member or are salted, with the hub of their band of sizes (within
    5/4). The hub is drawn by key, so the many lists that a group shares have different
    hubs. Holds a batch and the last, still open list."""
    names = ["key", "salt", "n", "cls"]
    held = None
    for batch in batches:
        now = [batch.column(k).to_numpy() for k in names]
        held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
        change = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))
        if len(change):
            yield _hubs([x[: change[-1] + 1] for x in held])
            held = [x[change[-1] + 1:] for x in held]
    if held is not None and len(held[0]):
        yield _hubs(held)


def _hubs(rows):
    key, salt, n, cls = rows
    fresh = np.r_[True, (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])]
    keep = fresh | np.r_[True, cls[1:] != cls[:-1]]
    key, salt, n, cls, fresh = (x[keep] for x in (key, salt, n, cls, fresh))
    first = np.flatnonzero(fresh)
    size = np.diff(np.r_[first, len(key)])
    least = np.repeat(n[first], size)
    # A band holds its upper edge: two sets of 4k and 5k elements may link. The first
    # band is cut in integers, so a list of two is compared or its sizes are incompatible.
    band = np.ceil(np.log(n / least) / np.log(1.25) - 1e-9) - 1
    band = np.where(4 * n.astype(np.int64) <= 5 * least.astype(np.int64), 0, np.maximum(band, 1))
    lead = fresh | np.r_[True, band[1:] != band[:-1]]
    at = np.flatnonzero(lead)
    group = np.cumsum(lead) - 1
    drawn = np.lexsort((mix64(cls.view(np.uint64) ^ mix64(key.view(np.uint64))), group))[at]
    hub, hub_n = cls[drawn][group], n[drawn][group]
    keep = (np.repeat(size, size) > 1) | (salt >= 0)
    return _rows([x[keep] for x in (key, salt, n, cls, hub, hub_n)], ["key", "salt", "n", "cls", "hub", "hub_n"])


def lists(docs: DataFrame, sent, limit: int) -> DataFrame:
    """``key, salt, n, cls, hub, hub_n``: the inverted lists with more than one member,
    by the broadcast counts of :func:`sketch`."""
    def run(batches):
        for _, texts in offset_slices(batches):
            yield _rows(keys(texts, sent.value, limit), ["key", "salt", "cls", "n"])

    rows = docs.select("text").mapInArrow(run, "key long, salt int, cls long, n int")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt", "n", "cls").mapInArrow(
        _lists, "key long, salt int, n int, cls long, hub long, hub_n int")


def _pair(a: str, b: str):
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def hub_pairs(listed: DataFrame) -> DataFrame:
    """Pairs to compare first: each member with its hub, and the hubs of a salted
    key with the least of them."""
    own = listed.where("cls <> hub and 5 * hub_n >= 4 * n and 5 * n >= 4 * hub_n").select(*_pair("cls", "hub"))
    hubs = listed.where("salt >= 0 and cls = hub").select("key", "cls", "n").distinct()
    least = hubs.groupBy("key").agg(F.min(F.struct("n", "cls")).alias("h"))
    across = hubs.join(least, "key").where("cls <> h.cls and 5 * h.n >= 4 * n").select(*_pair("cls", "h.cls"))
    return own.union(across).distinct()


def open_lists(listed: DataFrame, linked: DataFrame) -> DataFrame:
    """``key, n, cls, comp, m`` of the lists of m > 2 members that still hold different
    components. (Two members in a band are compared already, all others cannot link.)"""
    rows = listed.select("key", "n", "cls").join(linked, F.col("cls") == F.col("node"), "left")
    rows = cut(rows.select("key", "n", "cls", F.coalesce("component", "cls").alias("comp")))
    mixed = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("m > 2 and lo <> hi").select("key", "m"))
    return cut(rows.join(mixed, "key"))


def rest_pairs(rows: DataFrame, tested: DataFrame, own: DataFrame) -> DataFrame:
    """Pairs of one open list, sizes compatible, in different components and not yet
    compared. Long lists are cut into blocks by hash, and pairs of blocks compared by
    signature where they meet, so only pairs that may link leave the task."""
    short = rows.where(F.col("m") <= SHORT).drop("m")
    other = short.select(F.col("key").alias("key2"), F.col("n").alias("n2"), F.col("cls").alias("cls2"), F.col("comp").alias("comp2"))
    pairs = short.join(other, (F.col("key") == F.col("key2")) & (F.col("cls") < F.col("cls2")) & (F.col("comp") != F.col("comp2"))
                       & (5 * F.col("n") >= 4 * F.col("n2")) & (5 * F.col("n2") >= 4 * F.col("n")))
    pairs = pairs.select(F.col("cls").alias("a"), F.col("cls2").alias("b"))

    long = rows.where(F.col("m") > SHORT)
    sigs = own.select("cls", "sig").join(long.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"])
    count = F.ceil(F.col("m") / BLOCK).cast("int")
    long = long.join(sigs, "cls").withColumn("own", F.pmod(F.xxhash64("cls", "key"), count).cast("int"))
    long = long.withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    long = long.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "cls", "n", "comp", "sig")

    def compare(block: pa.Table) -> pa.Table:
        own_, p, q, cls, n, comp = (block.column(k).to_numpy() for k in ("own", "p", "q", "cls", "n", "comp"))
        sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), np.uint8).reshape(-1, BINS)
        left = np.flatnonzero(own_ == p[0])
        right = np.flatnonzero(own_ == q[0])
        found = []
        for i in left:
            other = right[(comp[right] != comp[i]) & (5 * n[right] >= 4 * n[i]) & (5 * n[i] >= 4 * n[right])]
            if p[0] == q[0]:
                other = other[cls[other] > cls[i]]
            if len(other):
                keep = other[_bound(sig[i], sig[other], n[i], n[other])]
                found += [(min(cls[i], cls[j]), max(cls[i], cls[j])) for j in keep]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    met = long.groupBy("key", "p", "q").applyInArrow(compare, "a long, b long")
    return pairs.union(met).distinct().join(tested, ["a", "b"], "left_anti")


def _bound(x: np.ndarray, y: np.ndarray, nx, ny) -> np.ndarray:
    """Whether sets with signatures ``x`` and ``y`` may link."""
    low = np.minimum(x, y)
    most = np.where((low == 255).any(axis=1), np.minimum(nx, ny), low.sum(axis=1, dtype=np.int64))
    return 100 * most >= 80 * (nx + ny - most)


def possible(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """The pairs that their signatures leave possible (an upper bound, so none is lost)."""
    need = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    sigs = own.select("cls", "n", "sig").join(need, "cls", "left_semi").dropDuplicates(["cls"])
    both = (pairs.join(sigs.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a")
                 .join(sigs.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b"))

    def compare(batches):
        for batch in batches:
            a, b, na, nb = (batch.column(k).to_numpy() for k in ("a", "b", "na", "nb"))
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BINS) for k in ("sa", "sb"))
            keep = _bound(x, y, na, nb)
            yield _rows([a[keep], b[keep]], ["a", "b"])

    return both.mapInArrow(compare, "a long, b long")


def verified(docs: DataFrame, pairs: DataFrame, own: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The pairs whose whole sets link. Sets are made again for the classes in
    question only: a bitmap of fixed size keeps most others from the shuffle, the join the rest."""
    pairs = cut(possible(pairs, own))
    need = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    marked = need.select(F.pmod("cls", F.lit(slots)).cast("int").alias("s")).distinct().toArrow().column("s").to_numpy()
    bitmap = np.zeros(slots, bool)
    bitmap[marked] = True
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches):
        wanted = np.unpackbits(sent.value).astype(bool)
        for _, texts in offset_slices(batches):
            d, x = shingles(texts)
            size, cls = set_classes(d, x, len(texts))
            ends = np.cumsum(size)
            _, one = np.unique(cls, return_index=True)
            take = [int(i) for i in one if size[i] and wanted[cls[i] % slots]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[take]), pa.array([x[ends[i] - size[i]: ends[i]].tobytes() for i in take], pa.binary())], ["cls", "elements"])

    sets = docs.select("text").mapInArrow(run, "cls long, elements binary").join(need, "cls", "left_semi").dropDuplicates(["cls"])
    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("elements").alias("ea")), "a")
                 .join(sets.select(F.col("cls").alias("b"), F.col("elements").alias("eb")), "b"))

    def compare(batches):
        for batch in batches:
            a, b, ea, eb = (batch.column(k).to_pylist() for k in ("a", "b", "ea", "eb"))
            keep = []
            for x, y in zip(ea, eb):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= 80 * (len(x) + len(y) - shared))
            yield _rows([np.array([v for v, k in zip(c, keep) if k], np.int64) for c in (a, b)], ["u", "v"])

    return both.mapInArrow(compare, "u long, v long")


def link_components(docs: DataFrame, own: DataFrame) -> DataFrame:
    """``node, component`` over the classes of equal sets that link to other classes;
    ``own`` has the classes of ``docs``. What the steps shuffle and broadcast goes when they end."""
    with shuffles_removed(docs.sparkSession):
        total = own.agg(F.sum("n")).first()[0] or 0
        slots = SLOTS
        while slots < MOST_SLOTS and slots * 32 < total:
            slots *= 2
        counts = sketch(docs, slots)
        limit, sent = boundary(counts), docs.sparkSession.sparkContext.broadcast(counts)  # at most MOST_SLOTS numbers
        del counts
        listed = cut(lists(docs, sent, limit))
        sent.destroy()
        first = cut(hub_pairs(listed))
        links = cut(verified(docs, first, own))
        linked = components(links)
        rows = open_lists(listed, linked)
        if rows.isEmpty():
            return linked
        rest = cut(rest_pairs(rows, first, own))
        if rest.isEmpty():
            return linked
        return components(links.union(verified(docs, rest, own)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row."""
    kind = docs.schema["doc_id"].dataType
    docs = docs.select("doc_id", "text")
    own = cut(classes(docs))
    linked = link_components(docs, own)
    named = own.drop("sig").join(linked, F.col("cls") == F.col("node"), "left").withColumn("__c", F.coalesce("component", "cls"))
    least = named.where("n > 0").groupBy("__c").agg(F.min("doc_id").alias("component_id"))
    some = named.where("n > 0").join(least, "__c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.union(own.where("n = 0").select("doc_id", "n", F.col("doc_id").cast(kind)))


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each component (the least doc_id, nulls last, then the text's
    hash) and every document without words; the columns stay as they are."""
    d = docs.withColumn("__row", F.xxhash64("text"))
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    own = classes(d.select("doc_id", "__row", "text"))
    own = cut(own.where("n > 0"))
    linked = link_components(docs.select("text"), own)
    named = own.drop("sig").join(linked, F.col("cls") == F.col("node"), "left").withColumn("__c", F.coalesce("component", "cls"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))
    chosen = named.groupBy("__c").agg(F.min(order).alias("o")).select(F.col("o.doc_id").alias("__id"), F.col("o.__row").alias("__at"))
    kept = d.where(worded).join(chosen, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__at")), "left_semi")
    # Rows that agree in doc_id and text are one document.
    first = F.row_number().over(Window.partitionBy("doc_id", "__row").orderBy(F.lit(0)))
    kept = kept.withColumn("__first", first).where("__first = 1").drop("__first", "__row")
    return kept.union(d.where(~worded).drop("__row"))


ORACLE_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (SELECT doc_id, doc_id AS c FROM documents
      UNION SELECT v.t AS doc_id, r.c FROM r JOIN (SELECT a AS f, b AS t FROM e UNION ALL SELECT b, a FROM e) v ON v.f = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
