"""Helpers shared by the operators: column expressions, the checkpoint folder
and vectorised word tables for code that runs inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are maximal runs of anything but the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor sees: what ``spark.checkpoint.dir`` names.
    Only a local session without the setting (tests) gets a scratch folder of its own."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        path = sc.getConf().get("spark.checkpoint.dir", None)
        if path is None:
            if not sc.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            import tempfile
            path = tempfile.mkdtemp(prefix="llm-checkpoint-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


BATCH = 4 << 20             # bytes of an Arrow batch on its way to a Python worker


def bound_batches(spark: SparkSession, size: int = BATCH) -> None:
    """Bound the Arrow batches of the session by bytes. Spark's own bound (64 MB, 10,000 rows) is
    held several times over by each task: in the JVM's vectors, on the way, and in the worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Jobs that run within remove their shuffle files when they end, so the disk
    holds those of one job and not of all before it."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written to the shared folder (Parquet, smaller
    than a checkpoint's rows)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.parquet(path)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (an invertible scramble)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words(texts: list[bytes], lower: bool = True):
    """The words of a batch: (bytes, starts, ends, text index, 64-bit hash)."""
    joined = b"\n" + b"\n".join(t.lower() if lower else t for t in texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    edge = np.diff(_SPACE[data].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
    offsets = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    doc = np.searchsorted(offsets, starts, "right") - 1
    return data, starts, ends, doc, word_hashes(data, starts, ends)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    within = np.arange(lens.sum()) - np.repeat(first, lens)
    at = within + np.repeat(starts, lens)
    terms = _RANDOM[data[at]] * powers(int(lens.max()))[within]
    return mix64(np.add.reduceat(terms, first))


SPAN = 1 << 17


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of :func:`word_hashes` from running sums: a word's terms are the difference
    of two of them, times the inverse power of where it starts (the base is odd, so it has one)."""
    out = np.empty(len(starts), np.uint64)
    up = powers(SPAN)
    down = np.full(SPAN, pow(int(_BASE), -1, 1 << 64), np.uint64)
    down[0] = 1
    down = np.multiply.accumulate(down)
    a = 0
    while a < len(starts):
        at = int(starts[a])
        b = int(np.searchsorted(ends, at + SPAN, "right"))
        if b <= a:                      # a word longer than a span
            out[a:a + 1] = word_hashes(data, starts[a:a + 1], ends[a:a + 1])
            a += 1
            continue
        sums = _RANDOM[data[at:int(ends[b - 1])]]
        sums *= up[:len(sums)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(sums, dtype=np.uint64)])
        first = starts[a:b] - at
        out[a:b] = mix64((sums[ends[a:b] - at] - sums[first]) * down[first])
        a = b
    return out


def lower_words(texts: list[bytes]):
    """(text index, 64-bit hash) of the words of a batch, A-Z lower-cased, as :func:`words` finds them."""
    data = np.frombuffer((b"\n" + b"\n".join(texts) + b"\n").lower(), np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1      # white space is first and last: starts and ends by turns
    starts, ends = edge[0::2], edge[1::2]
    offsets = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    counts = np.diff(np.searchsorted(starts, offsets))
    return np.repeat(np.arange(len(texts)), counts), span_hashes(data, starts, ends)


def arrow_slices(batches, column: str = "text", limit: int = 2 << 20) -> Iterator:
    """Cut Arrow record batches into pieces of about ``limit`` bytes of text (one
    row at least), with the texts as UTF-8 bytes (null: empty). Bounds the memory
    of numpy work on a batch, whatever the batch holds."""
    import pyarrow as pa
    for batch in batches:
        texts = [b"" if t is None else t for t in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]
        first, held = 0, 0
        for i, t in enumerate(texts):
            if i > first and held + len(t) > limit:
                yield batch.slice(first, i - first), texts[first:i]
                first, held = i, 0
            held += len(t)
        if first < len(texts):
            yield batch.slice(first), texts[first:]


def offset_slices(batches, column: str = "text", limit: int = 2 << 20) -> Iterator:
    """As :func:`arrow_slices`, but cut by the column's lengths first, so that only the
    texts of one piece are made Python bytes at a time, not those of the whole batch."""
    import pyarrow as pa
    import pyarrow.compute as pc
    for batch in batches:
        raw = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first), [b"" if t is None else t for t in raw.slice(first, last - first).to_pylist()]
            first = last
