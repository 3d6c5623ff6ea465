"""REPLAY tests: each streaming operator equals its batch twin on the same rows,
and a restarted query (same checkpoint) ends in the same state."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mentionscope.operators import rolling
from mentionscope.sources import fixtures as fx
from mentionscope.streaming import board as sboard
from mentionscope.streaming import rolling as srl
from replay import sentinels, write_files


def _events(spark, name="event_type"):
    ev = fx.event_mentions(spark, SF_SMALL, name)
    return ev, ev.toPandas().sort_values(["ts", "id"]).reset_index(drop=True)


def _run_rolling(spark, src_glob, schema, base, delay="0 seconds", bucket_us=3_600_000_000, chunk=4096):
    """Both stages over what is there; returns the first query."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src_glob)
    local = srl.local_changes(srl.mention_stream(src, delay=delay), bucket_us=bucket_us, chunk=chunk)
    q = (local.writeStream.format("parquet").option("path", os.path.join(base, "local"))
         .option("checkpointLocation", os.path.join(base, "ck1")).partitionBy("kind").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    closed = spark.readStream.schema(srl.LOCAL_SCHEMA).parquet(os.path.join(base, "local"))
    q2 = (srl.with_offsets(closed).writeStream.format("parquet").option("path", os.path.join(base, "out"))
          .option("checkpointLocation", os.path.join(base, "ck2")).outputMode("append").trigger(availableNow=True).start())
    q2.awaitTermination(600)
    return q


def _changelog(spark, base):
    return spark.read.parquet(os.path.join(base, "out")).where("name IS NULL OR name <> '__sentinel__'")


def _rejects(spark, base):
    return srl.rejects(spark.read.schema(srl.LOCAL_SCHEMA).parquet(os.path.join(base, "local")))


def _same(got, exp):
    assert got.count() == exp.count() > 0
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_rolling_stream_equals_batch(spark, scratch):
    ev, pdf = _events(spark)
    write_files(spark, pdf, ev.schema, os.path.join(scratch, "in"), 5)
    for i, s in enumerate(sentinels(pdf.ts.max())):
        write_files(spark, s, ev.schema, os.path.join(scratch, "in"), 1, start=100 + i)
    _run_rolling(spark, os.path.join(scratch, "in", "*"), ev.schema, scratch)
    got = _changelog(spark, scratch)
    _same(got, rolling.rolling_changelog(ev, ts="ts", key="name", id_col="id"))
    assert got.count() // 2 + _rejects(spark, scratch).count() == len(pdf)


def test_rolling_stream_out_of_order_within_delay(spark, scratch):
    ev, pdf = _events(spark)
    rng = np.random.default_rng(3)
    jitter = pd.to_timedelta(rng.uniform(-1.5, 1.5, len(pdf)), unit="D")
    order = np.argsort((pdf.ts + jitter).to_numpy())
    shuffled = pdf.iloc[order].reset_index(drop=True)
    write_files(spark, shuffled, ev.schema, os.path.join(scratch, "in"), 5)
    far = [s.assign(ts=s.ts + pd.Timedelta(days=6)) for s in sentinels(pdf.ts.max())]
    for i, s in enumerate(far):
        write_files(spark, s, ev.schema, os.path.join(scratch, "in"), 1, start=100 + i)
    _run_rolling(spark, os.path.join(scratch, "in", "*"), ev.schema, scratch, delay="4 days", bucket_us=7_200_000_000)
    _same(_changelog(spark, scratch), rolling.rolling_changelog(ev, ts="ts", key="name", id_col="id"))
    assert _rejects(spark, scratch).count() == 0


def test_rolling_stream_recovers_from_checkpoint(spark, scratch):
    """Stopped after two files, within open buckets; restarted with narrow buckets throughout."""
    ev, pdf = _events(spark)
    chunks = np.array_split(pdf, 4)
    inp = os.path.join(scratch, "in")
    write_files(spark, pd.concat(chunks[:2]), ev.schema, inp, 2)
    _run_rolling(spark, os.path.join(inp, "*"), ev.schema, scratch, bucket_us=600_000_000)
    write_files(spark, pd.concat(chunks[2:]), ev.schema, inp, 2, start=2)
    for i, s in enumerate(sentinels(pdf.ts.max())):
        write_files(spark, s, ev.schema, inp, 1, start=100 + i)
    _run_rolling(spark, os.path.join(inp, "*"), ev.schema, scratch, bucket_us=600_000_000)
    _same(_changelog(spark, scratch), rolling.rolling_changelog(ev, ts="ts", key="name", id_col="id"))


def test_hot_name_is_spread_and_its_state_bounded(spark, scratch):
    """One name holds a third of the rows, in a few minutes: its changes lie in many keys,
    in state entries of a bounded size, and the counts equal the batch's."""
    rng = np.random.default_rng(8)
    n, chunk = 6000, 64
    at = np.sort(rng.integers(0, 20 * 60_000, n))
    pdf = pd.DataFrame({"id": np.arange(n), "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(at, unit="ms"),
                        "name": np.where(rng.random(n) < 1 / 3, "hot", np.char.add("n", rng.integers(0, 40, n).astype(str)))})
    schema = "id long, ts timestamp, name string"
    inp = os.path.join(scratch, "in")
    write_files(spark, pdf, schema, inp, 4)
    _run_rolling(spark, os.path.join(inp, "*"), schema, scratch, delay="1 hour", bucket_us=60_000_000, chunk=chunk)
    state = (spark.read.format("statestore").option("stateVarName", "changes").option("flattenCollectionTypes", "true")
             .load(os.path.join(scratch, "ck1")))
    entries = state.select(F.col("key.name").alias("name"), F.col("key.bucket").alias("bucket"), F.size("list_element.t").alias("n")).collect()
    hot = [r for r in entries if r["name"] == "hot"]
    assert max(r["n"] for r in entries) <= chunk                   # the largest state value
    assert sum(r["n"] for r in hot) == 2 * int((pdf.name == "hot").sum())
    assert len({r["bucket"] for r in hot}) >= 38 and max(sum(r["n"] for r in hot if r["bucket"] == b) for b in {r["bucket"] for r in hot}) < 200
    for i, s in enumerate(sentinels(pdf.ts.max())):
        write_files(spark, s[["id", "ts", "name"]], schema, inp, 1, start=100 + i)
    _run_rolling(spark, os.path.join(inp, "*"), schema, scratch, delay="1 hour", bucket_us=60_000_000, chunk=chunk)
    _same(_changelog(spark, scratch), rolling.rolling_changelog(spark.createDataFrame(pdf, schema)))
    assert spark.read.format("statestore").option("stateVarName", "changes").option("flattenCollectionTypes", "true").load(
        os.path.join(scratch, "ck1")).where("key.name = 'hot'").count() == 0      # closed buckets leave nothing behind


def test_sliding_window_stream_complete_mode(spark, scratch):
    ev, pdf = _events(spark)
    write_files(spark, pdf, ev.schema, os.path.join(scratch, "in"), 5)
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(scratch, "in", "*"))
    out = srl.sliding_counts_stream(srl.mention_stream(src, delay="2 hours"))
    q = (out.writeStream.format("memory").queryName("st4").outputMode("complete")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = spark.sql("select * from st4")
    exp = rolling.sliding_counts(ev)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def _changelog_files(spark, scratch, n_files):
    users = fx.event_mentions(spark, SF_SMALL, "user_id")
    ch = rolling.rolling_changelog(users, ts="ts", key="name", id_col="id")
    pdf = ch.toPandas().sort_values(["t", "delta", "id"]).reset_index(drop=True)
    write_files(spark, pdf, ch.schema, os.path.join(scratch, "ch"), n_files)
    return ch, pdf


def _run_board(spark, scratch, schema, n):
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(scratch, "ch", "*"))
    q = sboard.start_leaderboard(src, os.path.join(scratch, "state"), os.path.join(scratch, "feed"),
                                 os.path.join(scratch, "ck"), n=n, trigger={"availableNow": True})
    q.awaitTermination(600)


def test_leaderboard_single_batch_equals_exact_top_n(spark, scratch):
    ch, _ = _changelog_files(spark, scratch, 1)
    _run_board(spark, scratch, ch.schema, n=20)
    board = sboard.current_board(spark, os.path.join(scratch, "state"))
    latest = ch.groupBy("name").agg(F.max_by("count", F.struct("t", "delta", "id")).alias("count"))
    exact = latest.orderBy(F.desc("count"), "name").limit(20)
    assert sorted(board.collect()) == sorted(exact.collect())


def test_leaderboard_replay_matches_incremental_rule(spark, scratch):
    from mentionscope.operators.board import board_step
    ch, pdf = _changelog_files(spark, scratch, 5)
    _run_board(spark, scratch, ch.schema, n=10)
    # the same five batches through the batch form of the step
    cur = spark.createDataFrame([], "name string, count long")
    for part in np.array_split(pdf, 5):
        b = spark.createDataFrame(part, ch.schema)
        latest = b.groupBy("name").agg(F.max_by("count", F.struct("t", "delta", "id")).alias("count"))
        cur, _ = board_step(cur, latest, 10)
        cur = spark.createDataFrame(cur.collect(), "name string, count long")
    board = sboard.current_board(spark, os.path.join(scratch, "state"))
    assert sorted(board.collect()) == sorted(cur.collect())
    assert board.count() <= 10
    msgs = spark.read.parquet(os.path.join(scratch, "feed", "messages"))
    assert msgs.count() >= 1 and msgs.agg(F.max("n_entries")).first()[0] <= 2 * 10


def test_late_and_untimed_rows_are_rejected_with_a_reason(spark, scratch):
    ev, pdf = _events(spark)
    pdf = pd.concat([pdf, pdf.head(2).assign(name=None, id=[10**7, 10**7 + 1])]).sort_values(["ts", "id"]).reset_index(drop=True)
    inp = os.path.join(scratch, "in")
    untimed = pdf.head(40).assign(id=10**8 + np.arange(40), ts=pd.NaT)
    write_files(spark, pd.concat([pdf.head(500), untimed]), ev.schema, inp, 1)
    write_files(spark, pdf.tail(len(pdf) - 500), ev.schema, inp, 1, start=1)
    late = pdf.head(3).assign(id=2 * 10**8 + np.arange(3))             # far older than the watermark
    write_files(spark, late, ev.schema, inp, 1, start=10)
    for i, s in enumerate(sentinels(pdf.ts.max())):
        write_files(spark, s, ev.schema, inp, 1, start=100 + i)
    _run_rolling(spark, os.path.join(inp, "*"), ev.schema, scratch, delay="1 hour")
    got, out = _changelog(spark, scratch), _rejects(spark, scratch)
    assert {(r["reason"], r["count"]) for r in out.groupBy("reason").count().collect()} == {("late", 3), ("no time", 40)}
    assert {r["id"] for r in out.where("reason = 'late'").collect()} == set(late.id)
    assert out.where("reason = 'no time' AND (ts IS NOT NULL OR id < 100000000)").count() == 0
    _same(got, rolling.rolling_changelog(spark.createDataFrame(pdf, ev.schema)))
    assert got.count() // 2 + out.count() == len(pdf) + len(late) + len(untimed)


def test_leaderboard_recovers_from_checkpoint(spark, scratch):
    users = fx.event_mentions(spark, SF_SMALL, "user_id")
    ch = rolling.rolling_changelog(users, ts="ts", key="name", id_col="id")
    pdf = ch.toPandas().sort_values(["t", "delta", "id"]).reset_index(drop=True)
    parts = np.array_split(pdf, 5)
    one = os.path.join(scratch, "one")            # uninterrupted run
    write_files(spark, pdf, ch.schema, os.path.join(one, "ch"), 5)
    _run_board(spark, one, ch.schema, n=10)
    two = os.path.join(scratch, "two")            # stop after two files, restart with three more
    write_files(spark, pd.concat(parts[:2]), ch.schema, os.path.join(two, "ch"), 2)
    _run_board(spark, two, ch.schema, n=10)
    write_files(spark, pd.concat(parts[2:]), ch.schema, os.path.join(two, "ch"), 3, start=2)
    _run_board(spark, two, ch.schema, n=10)
    b1 = sboard.current_board(spark, os.path.join(one, "state")).collect()
    b2 = sboard.current_board(spark, os.path.join(two, "state")).collect()
    assert sorted(b1) == sorted(b2) and len(b1) == 10


def test_sliding_window_stream_append_mode(spark, scratch):
    """Live mode: windows are emitted once the watermark passes their end."""
    ev, pdf = _events(spark)
    inp = os.path.join(scratch, "in")
    write_files(spark, pdf, ev.schema, inp, 5)
    for i, s in enumerate(sentinels(pdf.ts.max())):
        write_files(spark, s, ev.schema, inp, 1, start=100 + i)
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(inp, "*"))
    # No name filter on the stream: it would be pushed below the watermark and
    # keep the sentinels from closing the last windows. Filter the output instead.
    out = srl.sliding_counts_stream(srl.mention_stream(src, delay="0 seconds"))
    q = (out.writeStream.format("parquet").option("path", os.path.join(scratch, "out"))
         .option("checkpointLocation", os.path.join(scratch, "ck")).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = spark.read.parquet(os.path.join(scratch, "out")).where(F.col("name") != "__sentinel__")
    exp = rolling.sliding_counts(ev)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_processor_form_switches_to_rocksdb_state(spark):
    s2 = spark.newSession()                       # own SQL settings, same context
    key = "spark.sql.streaming.stateStore.providerClass"
    s2.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    srl.use_rocksdb_state(s2)
    assert s2.conf.get(key) == srl.ROCKSDB_PROVIDER


def test_snapshot_is_keyed_state_and_survives_a_restart(spark, scratch):
    """The last published value of every name, from one state table: equal to the whole feed's
    last values, names off the board at 0, after a stop and a restart."""
    srl.use_rocksdb_state(spark)
    rng = np.random.default_rng(4)
    schema = "name string, id long, t timestamp, delta int, count long"
    pdf = pd.DataFrame({"name": np.char.add("n", rng.integers(0, 40, 600).astype(str)), "id": np.arange(600),
                        "t": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(600), unit="min"), "delta": 1, "count": rng.integers(1, 90, 600)})
    write_files(spark, pdf.head(200), schema, os.path.join(scratch, "ch"), 2)
    feed_dir, ck = os.path.join(scratch, "feed"), os.path.join(scratch, "ck-snap")

    def snapshot():
        sboard.start_snapshot(spark, feed_dir, ck, {"availableNow": True}).awaitTermination(600)
        return {r["name"]: r["count"] for r in sboard.snapshot_table(spark, ck).collect()}

    _run_board(spark, scratch, schema, n=10)
    assert snapshot()
    write_files(spark, pdf.tail(400), schema, os.path.join(scratch, "ch"), 4, start=50)
    _run_board(spark, scratch, schema, n=10)
    got = snapshot()
    exp = {r["name"]: r["last"]["count"] for r in sboard.last_values(sboard.feed_changes(spark, feed_dir)).collect()}
    assert got == exp
    board = {r["name"]: r["count"] for r in sboard.current_board(spark, os.path.join(scratch, "state")).collect()}
    assert all(got[k] == board.get(k, 0) for k in got) and set(board) <= set(got) and len(got) > 10
    assert sboard.snapshot_table(spark, ck).count() == len(got) < sboard.feed_changes(spark, feed_dir).count()
