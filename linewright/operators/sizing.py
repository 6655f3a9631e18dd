"""Size checks before a broadcast, and reliable cuts of a plan's lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder of ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="linewright-checkpoint-")
    sc.setCheckpointDir(shared)


def settle(df: DataFrame) -> DataFrame:
    """Compute once and keep the result in the checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _row_bytes(df: DataFrame):
    width = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        width = width + 16
    return width


def broadcast_if_small(settled: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the measured size allows it, else leave the join to AQE.

    Pass a settled table of plain columns: its size is read, not its plan run again.
    """
    size = settled.agg(F.coalesce(F.sum(_row_bytes(settled).cast("bigint")), F.lit(0))).first()[0]
    return F.broadcast(settled) if size <= max_bytes else settled
