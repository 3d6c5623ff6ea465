"""spark-submit launcher of the replay job (see mentionscope.plans.replay_job).

Reads text segments and writes record files for scripts/run_stream.py. The stream
takes files in the order of their modification time; files of one run are
written at once, so stream them in one trigger (``--files-per-trigger`` at least
their number) or with a delay that covers their span of event time.
"""

import argparse

from pyspark.sql import SparkSession

from mentionscope.plans import replay_job


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Text segments to keyed records with event times")
    ap.add_argument("segments", nargs="+", help="files or globs of text segments")
    ap.add_argument("records", help="folder for the record files (parquet: key, value, event_ts)")
    ap.add_argument("--files", type=int, default=None)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("mentionscope-replay").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    replay_job.write_records(replay_job.replay_records(spark, a.segments), a.records, a.files)


if __name__ == "__main__":
    main()
