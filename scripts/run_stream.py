"""spark-submit launcher for the streaming job (see mentionscope.plans.stream_job).

Reads record files (``key, value, event_ts`` parquet) from a folder as a file
stream and keeps the exact rolling changelog, the leaderboard and the feed
under ``base``, with the rejected mentions and the last value of every name.
"""

import argparse

from pyspark.sql import SparkSession

from mentionscope.plans import stream_job

SCHEMA = "key string, value string, event_ts timestamp"


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Rolling one-hour mention counts and leaderboard")
    ap.add_argument("records", help="folder of record files (parquet: key, value, event_ts)")
    ap.add_argument("base", help="folder for changelog, state, feed and checkpoints (shared storage)")
    ap.add_argument("--delay-minutes", type=int, default=15)
    ap.add_argument("--board", type=int, default=100)
    ap.add_argument("--bucket-ms", type=int, default=60_000, help="width of a name's time buckets")
    ap.add_argument("--files-per-trigger", type=int, default=1)
    ap.add_argument("--once", action="store_true", help="process what is there, then stop")
    a = ap.parse_args(argv)
    spark = (SparkSession.builder.appName("mentionscope-stream")
             .config("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
             .getOrCreate())
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    src = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", a.files_per_trigger)
           .parquet(a.records))
    delay, bucket_us = f"{a.delay_minutes} minutes", a.bucket_ms * 1000
    if a.once:
        stream_job.run_available(spark, src, a.base, delay, a.board, bucket_us)
        return
    for q in stream_job.start(spark, src, a.base, delay, a.board, bucket_us=bucket_us):
        q.awaitTermination()


if __name__ == "__main__":
    main()
