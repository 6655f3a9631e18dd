"""What the corpus operators share: shared folder, word readings, Arrow batches, hashes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NullType

#: Stands for a null id inside joins and orderings; null ids come first.
NULL_ID = -(2**63)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in local mode a temporary one where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="linewright-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(name: str = "doc_id") -> Column:
    """A long that stands for the id; null comes first."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def id_of(key: str) -> Column:
    """The id behind ``id_key``."""
    return F.when(F.col(key) != NULL_ID, F.col(key))


def whole_ids(df: DataFrame, name: str = "doc_id") -> bool:
    """Whether the ids are whole numbers."""
    return isinstance(df.select(name).schema[0].dataType, (IntegralType, NullType))


def any_id(*outputs: str) -> Callable:
    """Lets an operator on docs(doc_id, ...) that knows whole ids only take ids of any type that can be ordered.

    Other ids are ranked in their order by one distributed sort of the distinct ids, so the
    least id stays the least. The operator sees ranks; ``outputs``, the result's columns of
    ids, hold the ids again. Null stays null. Whole ids go straight through.
    """

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operator)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            if whole_ids(docs):
                return operator(docs, *args, **kwargs)
            tag = f"_{uuid.uuid4().hex}_"
            own, rank = f"{tag}id", f"{tag}rank"
            ids = docs.select(F.col("doc_id").alias(own)).where(F.col(own).isNotNull()).distinct()
            # Numbers that grow along the sorted partitions.
            ids = settle(ids.orderBy(own).withColumn(rank, F.monotonically_increasing_id()), "ids")
            ranked = docs.join(ids, F.col("doc_id") == F.col(own), "left").withColumn("doc_id", F.col(rank)).select(docs.columns)
            result = operator(settle(ranked, "ranked"), *args, **kwargs)
            columns = result.columns
            for name in outputs:
                result = result.join(ids, F.col(name) == F.col(rank), "left").withColumn(name, F.col(own)).select(columns)
            return result

        return run

    return wrap


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for a row."""
    return F.transform(F.array(value), body)[0]


#: Bytes of a batch that is worked on at once, unless one row is longer.
PART_BYTES = 4 << 20


def small(batches: Iterator[pa.RecordBatch], most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows, so that a part has ``most`` bytes, or one row."""
    for batch in batches:
        if batch.nbytes <= most or batch.num_rows < 2:
            yield batch
            continue
        each = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                each += np.asarray(pc.fill_null(pc.binary_length(column), 0))
        part = np.cumsum(each + 64) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``fn`` over Arrow batches; it returns the columns of ``schema`` by name."""
    return map_stream(df, lambda batches: (fn(b) for b in batches), schema)


def map_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``fn`` over the batches of a partition; each item it yields is one batch of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(small(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in fields], schema=fields)

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


#: A-Z to a-z, as a table over bytes.
LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
#: Lower case, and every ASCII byte that is no digit or letter to a blank.
ALNUM = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 48 <= x <= 57 or 97 <= x <= 122 else 32 for x in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``[s, s + 1, ... s + l - 1]`` for each pair, one after another."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
