"""Run-cost metrics of the batch job (M1-M3).

A runs table holds one row per cluster run. These are plain column
expressions and window functions over that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUNS_SCHEMA = ("step int, approach string, instance_type string, instances int, ec2 double, "
               "emr double, master double, elapsed_s int")

# ---- fixed values: the published runs (prices in $/hour) ----------------------
PUBLISHED_RUNS = [
    (1, "Baseline", "c4.8xlarge", 20, 0.290, 0.270, 0.130, 562),
    (2, "Changed to Kryo serialization", "c4.8xlarge", 20, 0.290, 0.270, 0.130, 526),
    (3, "Changed parallelism to 200", "c4.8xlarge", 20, 0.290, 0.270, 0.130, 476),
    (4, "Switched to C5 instances", "c5.18xlarge", 10, 0.696, 0.270, 0.130, 434),
    (5, "Downsized to 3 core nodes", "c5.18xlarge", 3, 0.696, 0.270, 0.130, 1204),
]
TIME_LIMIT_S = 30 * 60
# ---- end of fixed values ------------------------------------------------------


def published_runs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PUBLISHED_RUNS, RUNS_SCHEMA)


def run_costs(runs: DataFrame) -> DataFrame:
    """M1: cost = elapsed hours x (master + instances x (ec2 + emr)), rounded to cents."""
    hourly = F.col("master") + F.col("instances") * (F.col("ec2") + F.col("emr"))
    return (runs.withColumn("elapsed_min", F.round(F.col("elapsed_s") / 60, 2))
                .withColumn("cost", F.round(F.col("elapsed_s") / 3600 * hourly, 2)))


def cheapest_within(runs_with_cost: DataFrame, limit_s: int = TIME_LIMIT_S) -> DataFrame:
    """M2: the cheapest run that finished within the time limit."""
    ok = runs_with_cost.where(F.col("elapsed_s") <= limit_s)
    return ok.agg(F.min_by("approach", F.struct("cost", "elapsed_s")).alias("approach"),
                  F.min("cost").alias("cost"))


def savings(runs_with_cost: DataFrame, order: str = "step") -> DataFrame:
    """M3: seconds and dollars saved against the previous run."""
    w = Window.orderBy(order)
    return (runs_with_cost
            .withColumn("saved_s", F.lag("elapsed_s").over(w) - F.col("elapsed_s"))
            .withColumn("saved_cost", F.round(F.lag("cost").over(w) - F.col("cost"), 2)))
