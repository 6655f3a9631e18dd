"""Log files to numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column

from linewright.operators.sizing import broadcast_if_small, settle

GLOB = "*.txt"
LINE_END = r"\r\n|\r|\n"


def _file(by_path: bool) -> list[str]:
    return [
        f"_metadata.file_{'path' if by_path else 'name'} as file",
        "_metadata.file_size as file_size",
        "_metadata.file_modification_time as file_mtime",
    ]


def lines_of_texts(texts: DataFrame, text: str = "value") -> DataFrame:
    """One row per whole file to one row per non-empty line, numbered from 1.

    A byte-order mark at the start is dropped, as Spark's line reader drops it.
    """
    others = [c for c in texts.columns if c != text]
    whole = F.regexp_replace(F.make_valid_utf8(text), "^\ufeff", "")
    return (
        texts.select(*others, F.posexplode(F.split(whole, LINE_END)))
        .where("col <> ''")
        .selectExpr(*others, "cast(pos as bigint) + 1 as line_no", "col as raw")
    )


def read_lines(
    spark: SparkSession, path: str | list[str], *, mode: str = "split", glob: str = GLOB, by_path: bool = False
) -> DataFrame:
    """``file, file_size, file_mtime, line_no, raw`` of every non-empty line.

    ``mode="split"`` reads a file in parallel splits and numbers its lines through the
    line counts of the splits; it takes files of any size. ``mode="whole"`` keeps a file
    in one row, for folders of small files. ``mode="position"`` is one scan without a number:
    ``split_start, place`` order the lines of a file, and blank lines stay, so that
    ``with_line_numbers`` can number the few lines that are reported. All drop a byte-order mark.

    ``file`` is the name of the file, which names its output; ``by_path`` makes it the whole
    path, for folders that hold equal names.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    if mode == "whole":
        return lines_of_texts(reader.text(path, wholetext=True).selectExpr(*_file(by_path), "value"))
    if mode == "position":
        return with_place(_split_lines(reader.text(path), by_path))
    if mode != "split":
        raise ValueError(f"unknown mode: {mode}")
    return _numbered_splits(reader.text(path), by_path)


def _split_lines(text: DataFrame, by_path: bool) -> DataFrame:
    """Lines with the start of their split, blank ones too; batch and stream alike."""
    return text.selectExpr(*_file(by_path), "_metadata.file_block_start as split_start", "make_valid_utf8(value) as raw")


def with_place(lines: DataFrame) -> DataFrame:
    """Add ``place``, which orders the lines of a split. Nothing may have been filtered before."""
    return lines.withColumn("place", F.monotonically_increasing_id())


def _numbered_splits(text: DataFrame, by_path: bool) -> DataFrame:
    """Line numbers as lines of earlier splits plus the place inside the own split.

    The line counts come from a first pass that reads no fields. Both passes must cut and
    place the files alike: the partition is part of the key, and a line without a
    partner fails the job instead of getting a wrong number.
    """
    # The key is 8 bytes of hash and the value one number, so a million splits are a small table.
    placed = text.selectExpr(
        "value",
        *_file(by_path),
        "_metadata.file_path as file_path",
        "_metadata.file_block_start as split_start",
        "xxhash64(_metadata.file_path, _metadata.file_block_start, _metadata.file_block_length, "
        "spark_partition_id()) as split",
        "monotonically_increasing_id() as place",
    )
    earlier = W.partitionBy("file_path").orderBy("split_start").rowsBetween(
        W.unboundedPreceding, -1
    )
    splits = (
        placed.groupBy("file_path", "split_start", "split")
        .agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first_place"))
        .select(
            "split", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first_place") + 1).alias("shift")
        )
    )
    numbered = placed.join(broadcast_if_small(settle(splits)), "split", "left")
    return numbered.selectExpr(
        "file",
        "file_size",
        "file_mtime",
        """case when shift is null
                then raise_error('files were split differently between two passes; fix spark.sql.files.minPartitionNum')
                else place + shift end as line_no""",
        "make_valid_utf8(value) as raw",
    ).where("raw <> ''")


def list_files(
    spark: SparkSession, path: str | list[str], *, glob: str = GLOB, by_path: bool = False, recursive: bool = False
) -> DataFrame:
    """``file, file_size`` of every file, also of those without a line; no content is read.

    ``recursive`` takes the files of all folders below, as a stream does.

    Scans leave out files of no bytes, so names come from the listing that Spark keeps; it
    stays inside the JVM.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    files = reader.option("recursiveFileLookup", recursive).load(path)
    paths = spark.sparkContext._jvm.org.apache.spark.sql.functions.lit(files._jdf.inputFiles())
    listed = spark.range(1).select(F.explode(Column(paths)).alias("path"))
    # As ``_metadata`` spells them: paths encoded, a local one with a single slash, names not
    # encoded. A plus sign stands for itself in a path.
    whole = "regexp_replace(path, '^file:/+', 'file:/')"
    name = "path" if by_path else "url_decode(replace(substring_index(path, '/', -1), '+', '%2B'))"
    sizes = files.selectExpr("_metadata.file_path as path", "length")
    return listed.selectExpr(f"{whole} as path").join(sizes, "path", "left").selectExpr(
        f"{name} as file", "coalesce(length, 0) as file_size"
    )


def smallest_files(
    spark: SparkSession, path: str, n: int, *, glob: str = GLOB
) -> DataFrame:
    """Paths and sizes of the ``n`` smallest files, without reading their content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return smallest(files.selectExpr("path", "length as file_size"), n, "file_size", "path")


def smallest(files: DataFrame, n: int, size: str, name: str) -> DataFrame:
    """The ``n`` smallest rows by size, ties by name. Planned as a top-n per task."""
    return files.orderBy(F.asc(size), F.asc(name)).limit(n)
