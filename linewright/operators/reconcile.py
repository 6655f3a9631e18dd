"""Do two event sets hold the same instants?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewright.operators.sizing import broadcast_if_small, settle


def _micros(df: DataFrame, time: str) -> Column:
    kind = dict(df.dtypes)[time]
    if kind == "timestamp":
        return F.unix_micros(time)
    if kind == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{time}`)")
    return F.col(time).cast("bigint")


def _side(df: DataFrame, time: str, name: str) -> DataFrame:
    return df.select(_micros(df, time).alias("micros"), F.lit(name).alias("side"))


def reconcile(left: DataFrame, right: DataFrame, time: str = "event_time") -> DataFrame:
    """Instants that only one side holds, with that side's name.

    ``time`` is a TIMESTAMP, with or without a zone, or BIGINT microseconds: equality is exact. One shuffle over
    both sides; each side is reduced to distinct instants on the map side.
    """
    both = _side(left, time, "left").unionByName(_side(right, time, "right"))
    seen = (
        both.where("micros is not null")
        .groupBy("micros")
        .agg(
            F.max(F.col("side") == "left").alias("in_left"),
            F.max(F.col("side") == "right").alias("in_right"),
        )
    )
    return seen.where("not (in_left and in_right)").selectExpr(
        "micros", "if(in_left, 'left', 'right') as only_in"
    )


def reconcile_summary(left: DataFrame, right: DataFrame, time: str = "event_time") -> DataFrame:
    """One row: instants missing on either side, and whether the sets are equal."""
    return reconcile(left, right, time).agg(
        F.count_if(F.col("only_in") == "right").alias("missing_left"),
        F.count_if(F.col("only_in") == "left").alias("missing_right"),
        (F.count(F.lit(1)) == 0).alias("equal"),
    )


_DAY = 86_400_000_000


def _digests(df: DataFrame, time: str, by: list[str], side: str) -> DataFrame:
    """Per log and day: what does not depend on the order of its instants. Merged on the map side."""
    rows = df.select(*by, _micros(df, time).alias("micros")).where("micros is not null")
    day = F.floor(F.col("micros") / _DAY).alias("day")
    return rows.groupBy(*by, day).agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("micros").cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(F.xxhash64(F.lit(1), "micros")).alias("xor"),
        ).alias(side)
    )


def differing_days(left: DataFrame, right: DataFrame, time: str = "event_time", by: list[str] | None = None) -> DataFrame:
    """``by``, day and the number of instants on either side, where the two sides differ.

    Only a row per log and day leaves a task, however many events there are. Days of equal
    digests hold the same instants, each as often (a 64-bit sum, a 64-bit exclusive-or and
    the count agree); a day that differs may still hold the same set, repeated differently.
    """
    by = by or []
    keys = [*by, "day"]
    one, two = _digests(left, time, by, "l"), _digests(right, time, by, "r").select(*(F.col(k).alias(f"r_{k}") for k in keys), "r")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"r_{k}"))
    both = one.join(two, same, "full").where(~F.col("l").eqNullSafe(F.col("r")))
    has_left = F.col("l").isNotNull()
    return both.select(
        *(F.when(has_left, F.col(k)).otherwise(F.col(f"r_{k}")).alias(k) for k in keys),
        F.coalesce("l.n", F.lit(0)).alias("n_left"),
        F.coalesce("r.n", F.lit(0)).alias("n_right"),
    )


def reconcile_by_digest(left: DataFrame, right: DataFrame, time: str = "event_time") -> DataFrame:
    """``reconcile``, with details taken only from days whose digests differ.

    Where both sides agree no detail row is read a second time or shuffled. A day is judged
    by all its logs, as instants are compared over all logs.
    """
    days = settle(differing_days(left, right, time).select("day"))
    if days.isEmpty():
        return reconcile(left.limit(0), right.limit(0), time)
    days = broadcast_if_small(days)
    part = lambda df: (
        df.select(_micros(df, time).alias("micros"))
        .withColumn("day", F.floor(F.col("micros") / _DAY))
        .join(days, "day", "left_semi")
    )
    return reconcile(part(left), part(right), "micros")
