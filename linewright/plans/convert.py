"""The whole conversion of a folder of logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from linewright.functions.linehash import with_line_hash
from linewright.operators.payloads import parse_events
from linewright.operators.quality import MAX_BAD_LINES, accepted_events, apply_quarantine, file_status, quality_tables
from linewright.operators.sizing import settle
from linewright.sources.events import write_events
from linewright.sources.lines import list_files, read_lines, smallest_files
from linewright.sources.published import publish


@dataclass
class Conversion:
    """Results of a conversion: all parsed lines, the verdicts, the accepted events."""

    parsed: DataFrame
    status: DataFrame
    accepted: DataFrame


def convert(
    spark: SparkSession,
    source: str,
    staging: str,
    target: str,
    *,
    mode: str = "split",
    fmt: str = "parquet",
    line_hash: str | None = None,
    max_bad_lines: int = MAX_BAD_LINES,
    smallest_n: int | None = None,
    quality: str | None = None,
    by_path: bool = False,
    **options,
) -> Conversion:
    """Parse a folder once into ``staging``, judge its files, publish the good ones.

    The staged Parquet makes the text be parsed a single time: the verdicts then read
    three of its columns, and publishing reads the rest. ``options`` go to
    ``parse_events``. Files without a line are judged and counted too. Names of files must
    differ, or ``by_path`` is set. In ``target`` only the accepted logs are replaced.
    """
    path: str | list[str] = source
    if smallest_n is not None:
        path = [r.path for r in smallest_files(spark, source, smallest_n).collect()]
    files = list_files(spark, path, by_path=by_path)
    if not files.groupBy("file").count().where("count > 1").isEmpty():
        raise ValueError("files of equal name; set by_path=True")
    lines = read_lines(spark, path, mode=mode, by_path=by_path)
    if line_hash:
        lines = with_line_hash(lines, line_hash)
    parse_events(lines, **options).write.mode("overwrite").parquet(staging)
    parsed = spark.read.parquet(staging)
    status = settle(file_status(parsed, max_bad_lines=max_bad_lines, files=files))
    accepted = apply_quarantine(parsed, status)
    write_events(accepted, target, fmt=fmt)
    if quality:
        quality_tables(parsed, status, quality)
    return Conversion(parsed, status, accepted)


def convert_once(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    *,
    max_bad_lines: int = MAX_BAD_LINES,
    line_hash: str | None = None,
    by_path: bool = True,
    even: bool = False,
    quality: str | None = None,
    **options,
) -> Conversion:
    """Judge a folder in a pruned pass, then parse its good logs once and write them once.

    The first pass computes no payload; its result is a row per file. The second one drops
    rejected files by a filter, before they are parsed, and writes by day (``publish``).
    Lines keep ``split_start, place``, which order the lines of a log; ``with_line_numbers``
    numbers those of ``parsed`` that are needed.
    """
    lines = read_lines(spark, source, mode="position", by_path=by_path)
    if line_hash:
        lines = with_line_hash(lines, line_hash)
    parsed = parse_events(lines, **options)
    files = list_files(spark, source, by_path=by_path)
    if not by_path and not files.groupBy("file").count().where("count > 1").isEmpty():
        raise ValueError("files of equal name; set by_path=True")
    status = settle(file_status(parsed, max_bad_lines=max_bad_lines, files=files))
    accepted = accepted_events(parsed, status)
    publish(accepted, status, target, even=even)
    if quality:
        quality_tables(parsed, status, quality)
    return Conversion(parsed, status, accepted)
