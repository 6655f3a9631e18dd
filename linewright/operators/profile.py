"""Event profile: how many of each type, and how many fields they carry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linewright.operators.sizing import settle


def event_profile(headed: DataFrame, *, running: bool = False) -> DataFrame:
    """Count, least and most comma fields per event type.

    ``running`` adds the running total in order of event name and the grand total, from the
    rows of the profile, never the events.
    """
    profile = (
        headed.groupBy("event")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("n_fields").alias("min_fields"),
            F.max("n_fields").alias("max_fields"),
            F.count("event").alias("named"),
        )
        .where("named > 0")
        .drop("named")
    )
    if not running:
        return profile
    # Names are any text before a comma, so there may be many in bad logs: ranges of names are
    # summed apart, and a row per range carries what is before it.
    ranged = settle(profile.repartitionByRange("event").withColumn("part", F.spark_partition_id()))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("n").alias("in_part")).select(
        "part",
        F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("before"),
        F.sum("in_part").over(W.partitionBy()).alias("total"),
    )
    upto = W.partitionBy("part").orderBy("event").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = ranged.withColumn("in_part", F.sum("n").over(upto))
    return summed.join(F.broadcast(parts), "part").select(
        *profile.columns, (F.col("in_part") + F.col("before")).alias("running"), "total"
    )
