"""Published events: one write by day, and an index that says which run holds which log.

``data/run=R/day=D`` holds the events of one run, ``index/run=R`` its logs. The index is written
last and in one commit, so a run is seen whole or not at all. A log that is published again is
read from its newest run; older rows of it, and of no other log, are left out.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewright.operators.sizing import broadcast_if_small, settle


def new_run() -> str:
    """A name of a run; later runs sort behind, and two at once differ."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def publish(good: DataFrame, status: DataFrame, target: str, *, run: str | None = None, even: bool = False) -> str:
    """Write the events of accepted logs once, then the index. A repeated run replaces itself.

    Tasks follow the input splits and a log covers few days, so nothing is shuffled. ``even``
    rebalances by day instead, for folders of many small logs: files of even size for one exchange.
    """
    run = run or new_run()
    dated = good.withColumn("day", F.to_date("event_time"))
    if even:
        dated = dated.hint("rebalance", "day")
    dated.write.mode("overwrite").partitionBy("day").parquet(f"{target}/data/run={run}")
    index = status.where("ok").select("file", "n_lines", "n_ok")
    index.write.mode("overwrite").parquet(f"{target}/index/run={run}")
    return run


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """``file, n_lines, n_ok, run``: the newest run of each published log."""
    index = spark.read.parquet(f"{target}/index").withColumn("run", F.col("run").cast("string"))
    newest = F.max_by(F.struct("n_lines", "n_ok", "run"), "run").alias("newest")
    return index.groupBy("file").agg(newest).select("file", "newest.*")


def read_published(spark: SparkSession, target: str) -> DataFrame:
    """Events of every published log, each from its newest run."""
    index = spark.read.parquet(f"{target}/index").withColumn("run", F.col("run").cast("string"))
    runs = broadcast_if_small(settle(index.select("run").distinct()))
    newest = read_index(spark, target).select("file", F.col("run").alias("newest"))
    # Only logs that were published more than once have rows here.
    stale = index.join(newest, "file").where("run < newest").select("file", "run")
    data = spark.read.parquet(f"{target}/data").withColumn("run", F.col("run").cast("string"))
    return data.join(runs, "run", "left_semi").join(broadcast_if_small(settle(stale)), ["file", "run"], "left_anti")
