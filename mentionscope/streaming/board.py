"""Streaming leaderboard and subscriber feed (ST7, ST8, ST9, K5, K6).

The changelog stream (``name, id, t, delta, count``) is consumed with
``foreachBatch``. Per micro-batch:

1. conflate: the latest value per name in the batch, and where it was first
   seen (K5; a grouped aggregate);
2. board step: merge with the current board (at most ``n`` rows) - see
   :func:`mentionscope.operators.board.board_step`; names that lose their
   seat get a 0 tombstone (ST8);
3. publish: the changes of this batch (first-seen order) are written as rows
   and as chunked JSON messages (K4/K5) to the feed folder.

State is a written table, not driver memory: the board of epoch ``e`` is
stored at ``<state>/board/epoch=e``. A replayed epoch overwrites its own
files, so a batch re-run after a failure is idempotent, and a restarted query
(same checkpoint) resumes from the last stored board (ST10).

The snapshot for a new subscriber (K6) is the last published value per name. A
query of its own keeps it as keyed state, one small entry per name
(:func:`start_snapshot`); :func:`snapshot_table` reads that state, not the
feed's history.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.board import board_changes, board_step
from ..operators.feed import json_messages

BOARD_SCHEMA = "name string, count long"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def stored_epochs(spark: SparkSession, base: str) -> list[int]:
    """Epochs with a stored (committed) board under ``base``."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("epoch=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


class LeaderboardWriter:
    """``foreachBatch`` function maintaining a bounded top-``n`` board."""

    def __init__(self, state_dir: str, feed_dir: str, n: int = 100, keep_epochs: int = 2):
        self.state_dir = state_dir.rstrip("/")
        self.feed_dir = feed_dir.rstrip("/")
        self.n = n
        self.keep_epochs = keep_epochs

    @property
    def board_dir(self) -> str:
        return f"{self.state_dir}/board"

    def previous_board(self, spark: SparkSession, epoch_id: int) -> DataFrame:
        prev = [e for e in stored_epochs(spark, self.board_dir) if e < epoch_id]
        if not prev:
            return spark.createDataFrame([], BOARD_SCHEMA)
        return spark.read.schema(BOARD_SCHEMA).parquet(f"{self.board_dir}/epoch={prev[-1]}")

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        seq = F.struct("t", "delta", "id")
        # Used three times below: kept for the duration of this batch only
        # (recomputed from the batch's input if an executor is lost).
        latest = (batch.groupBy("name")
                       .agg(F.max_by("count", seq).alias("count"), F.min(seq).alias("first"))
                       .persist(StorageLevel.MEMORY_AND_DISK))
        try:
            self._step(spark, latest, epoch_id)
        finally:
            latest.unpersist()
        self._prune(spark, epoch_id)

    def _step(self, spark: SparkSession, latest: DataFrame, epoch_id: int) -> None:
        old = self.previous_board(spark, epoch_id)
        new_board, _ = board_step(old, latest.select("name", "count"), self.n)
        # The new board is at most n rows: one file per epoch.
        board_path = f"{self.board_dir}/epoch={epoch_id}"
        new_board.coalesce(1).write.mode("overwrite").parquet(board_path)
        stored = spark.read.schema(BOARD_SCHEMA).parquet(board_path)
        changes = board_changes(old, stored, latest.select("name"))

        # Tombstones first (an eviction precedes the admission that caused it),
        # then the batch's changes in first-seen order. The epoch is the folder.
        ordered = (changes.join(latest.select("name", "first"), "name", "left")
                          .select("name", "count", "tombstone",
                                  F.col("first.t").alias("first_t"),
                                  F.col("first.delta").alias("first_delta"),
                                  F.col("first.id").alias("first_id")))
        path = f"{self.feed_dir}/changes/epoch={epoch_id}"
        ordered.write.mode("overwrite").parquet(path)
        written = (spark.read.parquet(path).withColumn("epoch", F.lit(epoch_id).cast("long"))
                        .withColumn("__late", ~F.col("tombstone")))
        msgs = json_messages(written, ["epoch"], ["__late", "first_t", "first_delta", "first_id", "name"],
                             "name", "count")
        msgs.drop("epoch").write.mode("overwrite").parquet(f"{self.feed_dir}/messages/epoch={epoch_id}")

    def _prune(self, spark: SparkSession, epoch_id: int) -> None:
        """Drop stored boards older than the last ``keep_epochs`` (they are never read again)."""
        fs, _ = _fs(spark, self.board_dir)
        for e in stored_epochs(spark, self.board_dir):
            if e <= epoch_id - self.keep_epochs:
                fs.delete(_fs(spark, f"{self.board_dir}/epoch={e}")[1], True)


def current_board(spark: SparkSession, state_dir: str) -> DataFrame:
    """ST7: the latest stored board."""
    w = LeaderboardWriter(state_dir, state_dir)
    epochs = stored_epochs(spark, w.board_dir)
    if not epochs:
        return spark.createDataFrame([], BOARD_SCHEMA)
    return spark.read.schema(BOARD_SCHEMA).parquet(f"{w.board_dir}/epoch={epochs[-1]}")


CHANGES_SCHEMA = "name string, count long, tombstone boolean, epoch long"


def feed_changes(spark: SparkSession, feed_dir: str) -> DataFrame:
    """All published changes (``epoch, name, count, ...``)."""
    return spark.read.parquet(f"{feed_dir.rstrip('/')}/changes")


def last_values(changes: DataFrame) -> DataFrame:
    """K6: the last published value per name, of a table or a stream of changes.

    The largest (epoch, tombstone, count) of a name: adding a change twice, as when an
    epoch is written again after a failure, changes nothing.
    """
    seq = F.struct("epoch", "tombstone", "count")
    return changes.groupBy("name").agg(F.max(seq).alias("last"))


def start_snapshot(spark: SparkSession, feed_dir: str, checkpoint: str, trigger: dict | None = None):
    """K6/ST9: keep the last published value of every name as the state of a running
    aggregate. The state store holds one entry per name, whatever the feed's length, and
    compacts itself; the query gives nothing out."""
    changes = (spark.readStream.schema(CHANGES_SCHEMA).option("ignoreMissingFiles", "true")
               .parquet(f"{feed_dir.rstrip('/')}/changes"))
    w = last_values(changes).writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def snapshot_table(spark: SparkSession, checkpoint: str) -> DataFrame:
    """K6/ST9: what a new subscriber receives -> ``name, count, epoch`` (zeros kept), read from
    the state of :func:`start_snapshot` as of its last finished batch."""
    state = spark.read.format("statestore").load(checkpoint)
    last = state["value"][state.schema["value"].dataType.fieldNames()[0]]
    return state.select(F.col("key.name").alias("name"), last["count"].alias("count"), last["epoch"].alias("epoch"))


def start_leaderboard(changelog: DataFrame, state_dir: str, feed_dir: str, checkpoint: str,
                      n: int = 100, trigger: dict | None = None):
    """ST7-ST9: run the leaderboard over a changelog stream (1-second trigger by default)."""
    writer = LeaderboardWriter(state_dir, feed_dir, n)
    w = changelog.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "1 second"}))
    return w.start()
