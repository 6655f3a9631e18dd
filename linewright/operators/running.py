"""Running counts that no single hot key can hold up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_LINES = 1 << 16


def running_count(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str,
    bucket: Column | None = None,
) -> DataFrame:
    """Number rows 1, 2, … per ``keys`` by the BIGINT column ``order``.

    Rows are numbered inside ranges of ``order`` first. The counts of the ranges, one row
    each, give the offset of every range, so a key that holds most rows is spread over
    many tasks.
    """
    spread = df.withColumn(
        "_range", bucket if bucket is not None else F.floor(F.col(order) / BUCKET_LINES)
    )
    inner = W.partitionBy(*keys, "_range").orderBy(order)
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        spread.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    numbered = spread.withColumn("_local", F.row_number().over(inner))
    return (
        numbered.join(offsets, [*keys, "_range"])
        .withColumn(name, F.col("_local") + F.col("_before"))
        .drop("_range", "_local", "_before")
    )
