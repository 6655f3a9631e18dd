"""Short hash of the raw line."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _blake2s(raw: pd.Series) -> pd.Series:
    digest = lambda text: hashlib.blake2s(text.encode("utf-8", "replace"), digest_size=4)
    return raw.map(lambda text: digest(text).hexdigest(), na_action="ignore")


def with_line_hash(lines: DataFrame, kind: str = "sha2") -> DataFrame:
    """Add ``line_sha`` (built in), or ``lh`` with the BLAKE2s hash of the export format.

    Spark has no BLAKE2s, so that one crosses to Python in Arrow batches; ask for it only
    when the export must carry it.
    """
    if kind == "blake2s":
        return lines.withColumn("lh", _blake2s("raw"))
    return lines.withColumn("line_sha", F.expr("left(sha2(raw, 256), 8)"))
