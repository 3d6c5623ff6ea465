"""Removal of repeated 50-byte strings by suffix arrays over shards.

A byte goes if a 50-byte string that covers it also starts in a document with a
smaller doc_id. Each 50-byte string is dealt to a shard by its anchor, the
least of its 20-byte hashes, so equal strings always meet, whichever document
they stand in; the strings of one anchor that follow each other form one
segment. First the anchors alone are exchanged: those of one text only cannot
repeat elsewhere. A segment that is the same wherever its anchor stands needs no
bytes, the least doc_id of its digest says all; bitmaps of the shared anchors and
of those with different segments keep most of the text where it is.

In a shard the distinct segments are concatenated and a suffix array is built
by Larsson-Sadakane refinement (ranks of 8 bytes, doubled, only unsorted groups
sorted again). Neighbours in it that agree in 50 bytes are one string; the
common prefix is read off the ranks of the 32-byte round, which numpy can do at
once, instead of Kasai's loop over bytes. The least doc_id of each string says
which parts of a segment go. Shards need no merging, as no string is in two.
An anchor with many different segments (a very common line with another neighbour
each time) goes to no shard: its 50-byte strings are dealt one by one, by a
128-bit hash of the whole string, and the least doc_id of each comes by a partial
and final minimum. Rows of a string or segment that very many documents hold are
salted where they meet its least doc_id. A text over ``PIECE`` bytes is read in
pieces that overlap by 49 bytes, so each string is in one of them.

Edge cases: null text is empty; texts under 50 bytes lose nothing; rows with
one doc_id never remove from each other unless a smaller one has the string;
a null doc_id neither loses nor removes; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import offset_slices, mix64, shuffles_removed, stored

SPAN, GRAM = 50, 20
STARTS = SPAN - GRAM + 1
MANY = 1 << 14  # rows with another segment than the first from which an anchor is dealt by its strings
PLACE_BITS = 26
PIECE = 1 << 20  # bytes of one text hashed at a time
LEAST_BITS, MOST_BITS, BLOCK_BITS, MOST_BLOCKS = 22, 28, 19, 18
SLOTS, MOST_SALTS = 1 << 16, 1 << 12
SLICE, CHUNK = 1 << 16, 1 << 18  # bytes of text hashed at a time (arrays that fit a core's cache), of a suffix array


def _joined(texts: list[bytes]):
    data = np.frombuffer(b"".join(texts) + bytes(64), np.uint8)
    return data, np.r_[0, np.cumsum([len(t) for t in texts])]


_TABLE = np.random.default_rng(20250611).integers(0, 1 << 64, 256, dtype=np.uint64)


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    base = 0x9E3779B97F4A7C15
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n, x, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def segments(texts: list[bytes], piece: int = PIECE):
    """Segments of a batch: (text index, first byte, last byte excluded, within the
    text; anchor hash; digest of the segment), and the joined bytes with the texts' offsets."""
    if max(map(len, texts), default=0) < piece + SPAN:
        return _segments(texts)
    found = []
    for i, text in enumerate(texts):
        for s in range(0, max(len(text) - SPAN + 1, 1), piece):
            _, a, b, h, k, _, _ = _segments([text[s: s + piece + SPAN - 1]])
            found.append((np.full(len(a), i), a + s, b + s, h, k))
    return (*(np.concatenate(x) for x in zip(*found)), *_joined(texts))


def _segments(texts: list[bytes]):
    data, offsets = _joined(texts)
    n = len(data) - 64
    empty = np.zeros(0, np.int64)
    if n < SPAN:
        return empty, empty, empty, np.zeros(0, np.uint64), np.zeros(0, np.uint64), data, offsets
    # Running sums of a random number per byte value times a power of its place: the
    # difference of two, times the inverse power of the first place, tells the bytes between.
    power, inverse = _powers(max(1 << (n - 1).bit_length(), SLICE * 2))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data[:n]] * power[:n], out=sums[1:])
    h = np.zeros(n, np.uint64)
    h[: n - GRAM + 1] = mix64((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = h & ~low
    least |= np.arange(n, dtype=np.uint64)
    width = 1
    while width * 2 <= STARTS:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < STARTS:
        least = np.minimum(least[: len(least) - (STARTS - width)], least[STARTS - width:])
    # A segment begins where the anchor changes, where a text begins and behind its last string.
    least = least[: n - SPAN + 1]
    new = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    edges = np.r_[offsets[:-1], np.maximum(offsets[1:] - SPAN + 1, offsets[:-1])]
    new[edges[edges < len(new)]] = True
    first = np.flatnonzero(new)
    doc = np.searchsorted(offsets, first, "right") - 1
    inside = first + SPAN <= offsets[doc + 1]
    a, b, doc = first[inside], np.r_[first[1:], len(new)][inside] + SPAN - 1, doc[inside]
    return (doc, a - offsets[doc], b - offsets[doc], h[(least[a] & low).astype(np.int64)],
            mix64((sums[b] - sums[a]) * inverse[a]), data, offsets)


def slot_marks(batches, bits: int, deal: int, many: int):
    """Rows ``h, t, k`` sorted by scrambled anchor, whose high bits are its slot -> two
    bitmaps for each block of slots: anchors of two texts, anchors of two segments; and
    the crowded anchors of the block."""
    inside = bits - deal
    block = last = None
    so_far, crowded = 0, set()
    shared, mixed = np.zeros(1 << inside, bool), np.zeros(1 << inside, bool)

    def done():
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *(pa.array([np.packbits(x).tobytes()], pa.binary()) for x in (shared, mixed)),
                                           pa.array([np.array(sorted(crowded), np.uint64).tobytes()], pa.binary())],
                                          ["block", "shared", "mixed", "crowded"])

    for batch in batches:
        h = batch.column("h").to_numpy().view(np.uint64)
        t, k = (batch.column(c).to_numpy() for c in ("t", "k"))
        blocks = (h >> np.uint64(64 - deal)).astype(np.int64)
        for part in np.split(np.arange(len(h)), np.flatnonzero(np.diff(blocks)) + 1):
            if not len(part):
                continue
            if blocks[part[0]] != block:
                if block is not None:
                    yield done()
                block, last = int(blocks[part[0]]), None
                so_far, crowded = 0, set()
                shared[:], mixed[:] = False, False
            x, tx, kx = h[part], t[part], k[part]
            if last is not None:  # the first row of the last anchor so far
                x, tx, kx = np.r_[last[0], x], np.r_[last[1], tx], np.r_[last[2], kx]
            first = np.maximum.accumulate(np.where(np.r_[True, x[1:] != x[:-1]], np.arange(len(x)), 0))
            slot = (x >> np.uint64(64 - bits) & np.uint64((1 << inside) - 1)).astype(np.int64)
            shared[slot[tx != tx[first]]] = True
            other = kx != kx[first]
            mixed[slot[other]] = True
            xs = x[other]
            if so_far + np.searchsorted(xs, x[0], "right") >= many:
                crowded.add(int(x[0]))
            if len(xs) >= many:
                found, n = np.unique(xs, return_counts=True)
                crowded.update(found[n >= many].tolist())
            so_far = int(len(xs) - np.searchsorted(xs, x[-1])) + (so_far if x[0] == x[-1] else 0)
            last = x[-1], tx[first[-1]], kx[first[-1]]
    if block is not None:
        yield done()


def anchor_bitmaps(docs: DataFrame, total_bytes: int, many: int = MANY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits of the anchors that stand in two different texts, and of those with two
    different segments; and, scrambled and sorted, the anchors with at least ``many``
    rows of another segment than their first (one anchor for ``many`` rows at most). The
    bitmaps follow the input up to a fixed most; full ones cost traffic, never results.
    The blocks they are made in follow it further, up to ``2 ** MOST_BLOCKS``. Texts and
    segments of one anchor are told apart by 64 bits each."""
    bits = LEAST_BITS
    while bits < MOST_BITS and (1 << bits) < total_bytes // 8:
        bits += 1
    deal = bits - BLOCK_BITS
    while deal < MOST_BLOCKS and 1 << (deal + BLOCK_BITS + 3) < total_bytes:
        deal += 1

    def anchors(batches):
        for batch, texts in offset_slices(batches, limit=SLICE):
            doc, _, _, h, k, _, _ = segments(texts)
            yield pa.RecordBatch.from_arrays([pa.array(mix64(h).view(np.int64)), pa.array(batch.column("t").to_numpy()[doc]), pa.array(k.view(np.int64))], ["h", "t", "k"])

    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    block = F.shiftrightunsigned("h", 64 - deal)
    rows = docs.select("t", "text").mapInArrow(anchors, "h long, t long, k long").repartition(parts, block).sortWithinPartitions("h")
    out = np.zeros((2, 1 << deal, (1 << (bits - deal)) // 8), np.uint8)
    with shuffles_removed(docs.sparkSession):
        found = rows.mapInArrow(lambda batches: slot_marks(batches, bits, deal, many), "block int, shared binary, mixed binary, crowded binary").collect()
    for r in found:
        out[0, r["block"]], out[1, r["block"]] = np.frombuffer(r["shared"], np.uint8), np.frombuffer(r["mixed"], np.uint8)
    crowded = np.sort(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["crowded"], np.uint64) for r in found)]))
    return out[0].reshape(-1), out[1].reshape(-1), crowded


def _marked(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (mix64(h) >> np.uint64(64 - (len(bitmap) * 8 - 1).bit_length())).astype(np.int64)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def suffix_ranks(data: np.ndarray):
    """Larsson-Sadakane refinement: (suffix array by 64 bytes, ranks by 32 bytes).
    Only groups that are not yet told apart are sorted again."""
    n = len(data)
    padded = np.r_[data, np.zeros(72, np.uint8)]
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = key << np.uint64(8) | padded[j: n + j].astype(np.uint64)
    sa = np.argsort(key, kind="stable")
    same = np.r_[False, key[sa][1:] == key[sa][:-1]]
    rank = np.zeros(n + 72, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    ranks32 = None
    for width in (8, 16, 32):
        if width == 32:
            ranks32 = rank.copy()
        grouped = same | np.r_[same[1:], False]
        at = np.flatnonzero(grouped)
        if not len(at):
            continue
        p = sa[at]
        pair = rank[p] << 32 | rank[p + width] + 1
        order = np.argsort(pair, kind="stable")
        sa[at] = p[order]
        pair = pair[order]
        equal = np.r_[False, pair[1:] == pair[:-1]]
        fresh = rank.copy()
        fresh[sa[at]] = np.maximum.accumulate(np.where(equal, 0, at))
        same = np.zeros(n, bool)
        same[at] = equal
        rank = fresh
    return sa, ranks32 if ranks32 is not None else rank


def least_ids(segs: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """For each 50-byte string of each segment the least id of a segment that holds it."""
    data = np.frombuffer(b"".join(segs), np.uint8)
    offsets = np.r_[0, np.cumsum([len(s) for s in segs])]
    owner = np.repeat(np.arange(len(segs)), np.diff(offsets))
    start = np.arange(len(data)) + SPAN <= offsets[owner + 1]
    sa, rank = suffix_ranks(data)
    sa = sa[start[sa]]  # strings that end within their segment, in order
    other = rank[sa + SPAN - 32]
    same = np.r_[False, (rank[sa][1:] == rank[sa][:-1]) & (other[1:] == other[:-1])]
    first = np.flatnonzero(~same)
    low = np.minimum.reduceat(ids[owner[sa]], first)
    found = np.zeros(len(data), np.int64)
    found[sa] = np.repeat(low, np.diff(np.r_[first, len(sa)]))
    return [found[offsets[i]: offsets[i + 1] - SPAN + 1] for i in range(len(segs))]


def _shards(batches):
    """Rows sorted by (h, k): whole anchors at a time -> ``h, k, m, cuts``: for a
    segment of which this loses parts as well, its least doc_id and the parts."""
    held = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        h = held.column("h").to_numpy()
        change = np.flatnonzero(h[1:] != h[:-1])
        if len(change) and held.num_rows > 1:
            end = int(change[-1]) + 1
            yield from _shard(held.slice(0, end))
            held = held.slice(end)
    if held is not None and held.num_rows:
        yield from _shard(held)


def _shard(rows):
    h, m = (rows.column(k).to_numpy() for k in ("h", "m"))
    keys = rows.column("k").to_numpy()
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    size = np.repeat(np.diff(np.r_[first, len(h)]), np.diff(np.r_[first, len(h)]))
    cuts = [[] for _ in range(len(h))]
    many = np.flatnonzero(size > 1)
    segs = rows.column("seg").to_pylist()
    at, room = 0, 0
    # Anchors with several segments, about CHUNK bytes at a time, an anchor never in two parts.
    while at < len(many):
        end, room = at, 0
        while end < len(many) and (room < CHUNK or h[many[end]] == h[many[end - 1]]):
            room += len(segs[many[end]])
            end += 1
        part = many[at:end]
        for i, low in zip(part, least_ids([segs[i] for i in part], m[part])):
            gone = np.r_[False, low < m[i], False]
            edge = np.flatnonzero(gone[1:] != gone[:-1])
            cuts[i] = [int(x) for a, b in zip(edge[::2], edge[1::2]) for x in (a, b - 1 + SPAN)]
        at = end
    keep = [i for i in range(len(h)) if cuts[i]]
    yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(keys[keep]), pa.array(m[keep]), pa.array([cuts[i] for i in keep], pa.list_(pa.int32()))],
                                     ["h", "k", "m", "cuts"])


def _string_keys(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row of 50 bytes."""
    lanes = np.zeros((len(raw), 56), np.uint8)
    lanes[:, :SPAN] = raw
    lanes = lanes.view("<u8").astype(np.uint64)
    out = []
    for seed in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        x = np.full(len(raw), seed, np.uint64)
        for j in range(lanes.shape[1]):
            x = mix64((x ^ lanes[:, j]) * np.uint64(seed) + np.uint64(j + 1))
        out.append(x.view(np.int64))
    return out[0], out[1]


def _strings(batches):
    """Segments -> ``s1, s2, h, k, at, m``: each of their 50-byte strings."""
    for batch in batches:
        for first in range(0, batch.num_rows, 1024):
            piece = batch.slice(first, 1024)
            segs = piece.column("seg").to_pylist()
            data = np.frombuffer(b"".join(segs), np.uint8)
            sizes = np.array([len(x) for x in segs])
            count = sizes - SPAN + 1
            row = np.repeat(np.arange(len(segs)), count)
            at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            s1, s2 = _string_keys(np.lib.stride_tricks.sliding_window_view(data, SPAN)[(np.cumsum(sizes) - sizes)[row] + at])
            h, k, m = (piece.column(c).to_numpy()[row] for c in ("h", "k", "m"))
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (s1, s2, h, k, at.astype(np.int32), m))], ["s1", "s2", "h", "k", "at", "m"])


def salted_join(rows: DataFrame, told: DataFrame, key: list[str], spread: list[str], many: int) -> DataFrame:
    """``rows`` joined with ``told`` on ``key``, rows of a key with more than ``many`` of
    them (``told.n``) dealt over several tasks by ``spread``. Which keys are salted is told
    by one of ``SLOTS`` classes of the first key column: that many rows are broadcast at most."""
    slot = F.pmod(F.col(key[0]), F.lit(SLOTS)).cast("int").alias("__slot")
    salts = F.least(F.ceil(F.max("n") / many), F.lit(MOST_SALTS)).cast("int").alias("__salts")
    hot = F.broadcast(told.where(F.col("n") > many).groupBy(slot).agg(salts))
    n = F.coalesce("__salts", F.lit(1))
    dealt = (rows.withColumn("__slot", slot).join(hot, "__slot", "left")
             .withColumn("__salt", F.pmod(F.xxhash64(*spread), n).cast("int")).drop("__slot", "__salts"))
    copies = (told.withColumn("__slot", slot).join(hot, "__slot", "left")
              .withColumn("__salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("__slot", "__salts", "n"))
    return dealt.join(copies, [*key, "__salt"]).drop("__salt")


def crowded_cuts(distinct: DataFrame, many: int = MANY) -> DataFrame:
    """``h, k, m, cuts`` as of ``_shards``, for segments of crowded anchors, string by
    string; no task holds all rows of a string of more than ``many`` segments."""
    rows = stored(distinct.mapInArrow(_strings, "s1 long, s2 long, h long, k long, at int, m long"))
    key = ["s1", "s2"]
    least = stored(rows.groupBy(*key).agg(F.min("m").alias("low"), F.max("m").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high").drop("high"))
    gone = salted_join(rows, least, key, ["h", "k", "at"], many).where("low < m")

    def runs(batches):
        for batch in batches:
            cuts = []
            for at in batch.column("at").to_pylist():
                at = np.sort(at)
                edge = np.flatnonzero(np.diff(at) > 1)
                cuts.append([int(x) for a, b in zip(at[np.r_[0, edge + 1]], at[np.r_[edge, len(at) - 1]]) for x in (a, b + SPAN)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("h", "k", "m")), pa.array(cuts, pa.list_(pa.int32()))], ["h", "k", "m", "cuts"])

    # At most one place for each of the few starts of a segment.
    listed = gone.groupBy("h", "k").agg(F.min("m").alias("m"), F.collect_list("at").alias("at"))
    return listed.select("h", "k", "m", "at").mapInArrow(runs, "h long, k long, m long, cuts array<int>")


def distinct_segments(docs: DataFrame, shared: np.ndarray, mixed: np.ndarray, crowded: np.ndarray, of_crowded: bool) -> DataFrame:
    """``h, k, seg, m``: the different segments of shared anchors that have several, with
    their least doc_id; those of the crowded anchors, or those of all others."""
    sent = docs.sparkSession.sparkContext.broadcast((shared, mixed, crowded))

    def send(batches):
        """The segments of shared anchors that have different ones, each once a batch."""
        for batch, texts in offset_slices(batches, limit=SLICE):
            doc, a, b, h, k, data, offsets = segments(texts)
            take = _marked(sent.value[0], h) & _marked(sent.value[1], h)
            if len(sent.value[2]):
                take &= np.isin(mix64(h), sent.value[2]) == of_crowded
            keep = np.flatnonzero(take)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[doc[keep]].astype(np.int64)
            order = np.lexsort((ids, k[keep], h[keep]))
            keep, ids = keep[order], ids[order]
            doc, a, b, h, k = doc[keep], a[keep], b[keep], h[keep], k[keep]
            first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (k[1:] != k[:-1])]) if len(h) else np.zeros(0, int)
            raw = data.tobytes()
            segs = [raw[offsets[d] + x: offsets[d] + y] for d, x, y in zip(doc[first], a[first], b[first])]
            yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(k[first].view(np.int64)), pa.array(segs, pa.binary()), pa.array(ids[first])],
                                             ["h", "k", "seg", "doc_id"])

    return (docs.select("doc_id", "t", "text").mapInArrow(send, "h long, k long, seg binary, doc_id long")
            .groupBy("h", "k").agg(F.first("seg").alias("seg"), F.min("doc_id").alias("m")))


def removed_spans(docs: DataFrame, shared: np.ndarray, mixed: np.ndarray, crowded: np.ndarray, many: int = MANY) -> DataFrame:
    """``doc_id, t, a, b``: byte ranges to remove, which may overlap."""
    sent = docs.sparkSession.sparkContext.broadcast(shared)

    def place(batches):
        """The segments of shared anchors, without their bytes."""
        for batch, texts in offset_slices(batches, limit=SLICE):
            doc, a, b, h, k, _, _ = segments(texts)
            keep = np.flatnonzero(_marked(sent.value, h))
            doc = doc[keep]
            ids, t = (batch.column(c).to_numpy(zero_copy_only=False)[doc].astype(np.int64) for c in ("doc_id", "t"))
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (h[keep].view(np.int64), k[keep].view(np.int64), ids, t)),
                                              *(pa.array(x[keep].astype(np.int32)) for x in (a, b))], ["h", "k", "doc_id", "t", "a", "b"])

    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    slim = docs.select("doc_id", "t", "text")
    distinct = distinct_segments(docs, shared, mixed, crowded, False)
    parted = (distinct.repartition(parts, "h").sortWithinPartitions("h", "k")
              .mapInArrow(_shards, "h long, k long, m long, cuts array<int>"))
    if len(crowded):
        parted = parted.union(crowded_cuts(distinct_segments(docs, shared, mixed, crowded, True), many))
    placed = stored(slim.mapInArrow(place, "h long, k long, doc_id long, t long, a int, b int"))
    least = placed.groupBy("h", "k").agg(F.min("doc_id").alias("m"), F.max("doc_id").alias("mx"), F.count(F.lit(1)).alias("n")).where("m < mx")
    # Later holders of a segment lose all of it, the first one its parts.
    told = stored(least.select("h", "k", "m", F.lit(None).cast("array<int>").alias("cuts"), "n").union(parted.withColumn("n", F.lit(None).cast("long"))))
    met = salted_join(placed, told, ["h", "k"], ["doc_id", "a"], many)
    whole = F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")))
    some = F.transform(F.sequence(F.lit(0), (F.size("cuts") / 2 - 1).cast("int")),
                       lambda i: F.struct((F.col("a") + F.get("cuts", i * 2)).alias("a"), (F.col("a") + F.get("cuts", i * 2 + 1)).alias("b")))
    spans = F.when(F.col("cuts").isNull() & (F.col("doc_id") > F.col("m")), whole).when(F.col("cuts").isNotNull() & (F.col("doc_id") == F.col("m")), some)
    return met.select("doc_id", "t", F.explode(spans).alias("s")).select("doc_id", "t", "s.a", "s.b")


def dedup(docs: DataFrame, many: int = MANY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) of every row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    known = d.where("doc_id is not null")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = max(many, total >> 26)  # so at most about 2 ** 22 anchors are crowded, whatever the input
    spans = removed_spans(known, *anchor_bitmaps(known, total, many), many)
    # A copy of a whole text loses all of it, whatever its anchors.
    size = F.octet_length("text")
    texts = known.where(size >= SPAN).select("doc_id", "t", size.alias("b"))
    least = texts.groupBy("t").agg(F.min("doc_id").alias("m"), F.max("doc_id").alias("mx")).where("m < mx")
    copies = texts.join(least, "t").where("doc_id > m").select("doc_id", "t", F.lit(0).alias("a"), "b")
    spans = spans.union(copies)
    # A document's ranges, in order, as one list (no longer than the text).
    listed = stored(spans.groupBy("doc_id", "t").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans")))
    marked = np.zeros(1 << 20, bool)
    marked[listed.select(F.pmod("t", F.lit(1 << 20)).cast("int").alias("s")).distinct().toArrow().column("s").to_numpy()] = True
    sent = d.sparkSession.sparkContext.broadcast(np.packbits(marked))
    spec = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                         T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])

    def write(ids, texts, spans):
        rows = []
        for text, own in zip(texts, spans):
            kept, n, at = [], 0, 0
            end = -1
            for s in own or ():
                if s["a"] > end:  # a new maximal run
                    kept.append(text[at: s["a"]])
                    n += 1
                    end = at = s["b"]
                elif s["b"] > end:
                    end = at = s["b"]
            kept.append(text[at:])
            rest = b"".join(kept)
            rows.append((len(text), len(text) - len(rest), n, hashlib.sha256(rest).hexdigest(), rest))
        return pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in rows], kind) for k, kind in
                                                  enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))], spec.names)

    def hit(t):
        bits = np.unpackbits(sent.value).astype(bool)
        return bits[t % (1 << 20)]

    def clean(batches):
        for batch, texts in offset_slices(batches):
            out = np.flatnonzero(~hit(batch.column("t").to_numpy()))
            yield write(batch.column("doc_id").take(pa.array(out)), [texts[i] for i in out], [None] * len(out))

    def touched(batches):
        for batch in batches:
            yield batch.filter(pa.array(hit(batch.column("t").to_numpy())))

    def apply(batches):
        for batch, texts in offset_slices(batches):
            yield write(batch.column("doc_id"), texts, batch.column("spans").to_pylist())

    some = d.mapInArrow(touched, d.schema).join(listed.withColumnsRenamed({"doc_id": "__id", "t": "__t"}),
                                                (F.col("doc_id") == F.col("__id")) & (F.col("t") == F.col("__t")), "left")
    return d.mapInArrow(clean, spec).union(some.select("doc_id", "text", "spans").mapInArrow(apply, spec))


ORACLE_SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
n AS (SELECT doc_id, x, (length(x) // 2)::BIGINT AS n_bytes FROM b),
g AS (SELECT doc_id, p, substr(x, 2 * p + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(n_bytes - 49)) AS p FROM n WHERE n_bytes >= 50)),
m AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s HAVING min(doc_id) < max(doc_id)),
w AS (SELECT g.doc_id, p FROM g JOIN m ON g.s = m.s AND m.least < g.doc_id),
v AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 OR lag(p) OVER (PARTITION BY doc_id ORDER BY p) IS NULL THEN 1 ELSE 0 END AS fresh FROM w),
k AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM v),
r AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS e FROM k GROUP BY doc_id, run),
q AS (SELECT doc_id, a, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
z AS (SELECT q.doc_id, sum(e - a)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS last,
             string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM q JOIN n ON n.doc_id = q.doc_id GROUP BY q.doc_id)
SELECT n.doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN z.doc_id IS NULL THEN x ELSE head || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM n LEFT JOIN z ON z.doc_id = n.doc_id
"""
