"""Spark session helpers.

Everything in the library takes a ``SparkSession`` from the caller; this
module only offers a sensible builder for tests, the bench and the CLI and
one place that decides where lineage-cutting checkpoints go.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that event times and day boundaries
# are the same on every executor, AQE for runtime re-planning (partition
# coalescing, skew splitting, broadcast only when the measured side is small).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "mentionscope", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's base settings.

    ``master`` defaults to ``local[$BENCH_CPUS]`` (or ``local[*]``) only when
    no master was given by spark-submit.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])
    builder = SparkSession.builder.appName(app)
    if master is None and "SPARK_MASTER" not in os.environ:
        cpus = os.environ.get("BENCH_CPUS", "*")
        master = f"local[{cpus}]"
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is read from
    the session. Only a local-mode session without the setting (tests, the
    bench) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="mentionscope-ckpt-"))
    return sc.getCheckpointDir()


MIB = 1 << 20


def cluster_conf(input_bytes: int, total_cores: int, shuffle_ratio: float = 0.3,
                 split_bytes: int = 512 * MIB, target_partition_bytes: int = 256 * MIB) -> dict:
    """Settings sized for a cluster run over ``input_bytes`` of input.

    * scan splits of ``split_bytes`` (fewer, larger scan tasks on big files);
    * shuffle partitions so that each holds about ``target_partition_bytes`` of
      the expected shuffle (``input_bytes * shuffle_ratio``), and at least two
      waves of tasks; AQE starts from that number, coalesces small partitions
      to the same advisory size and splits skewed join partitions.

    Example: 100 TB of input on 1,000 executors x 8 cores gives about 117k
    shuffle partitions of 256 MiB.
    """
    shuffle_bytes = int(input_bytes * shuffle_ratio)
    parts = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
