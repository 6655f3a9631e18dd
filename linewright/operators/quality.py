"""Line status to file verdicts, quarantine, warnings and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linewright.functions.text import quoted_list
from linewright.operators.routes import COMBATANT
from linewright.operators.running import running_count
from linewright.operators.sizing import BROADCAST_BYTES, broadcast_if_small, settle
from linewright.operators.sketch import member

# Fixed value: a file may hold this many malformed lines.
MAX_BAD_LINES = 1
# Lines of one file that are pre-aggregated together.
RANGE_LINES = 8192
# Why a file is rejected, by kind of its first fault.
REASONS = {
    "fatal": "fatal line",
    "combatant": "malformed combatant",
    "limit": "too many malformed lines",
}


def _range_summary(events: DataFrame, keep: int) -> DataFrame:
    """Per file and range of lines: counts, first fatal line, first bad combatant, and the
    first ``keep`` other malformed lines. A range holds at most ``RANGE_LINES`` lines, so
    its list is bounded; ranges are combined on the map side.

    Events without ``line_no`` are ordered by ``split_start, place``. Their summary also
    counts blank lines, which is all that real numbers need: no line is read again for them.
    """
    numbered = "line_no" in events.columns
    at = F.col("line_no" if numbered else "place")
    split = F.lit(0).cast("bigint") if numbered else F.col("split_start")
    fault = F.struct(at.alias("line_no"), "status_error")
    combatant = F.coalesce(F.col("event") == COMBATANT, F.lit(False))
    malformed = F.col("status") == "malformed"
    ranges = events.groupBy(
        "file", split.alias("split_start"), F.floor(at / RANGE_LINES).alias("line_range")
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(at).alias("first"),
        F.count_if(F.col("status") != "blank").alias("n_lines"),
        *[
            F.count_if(F.col("status") == s).alias(f"n_{s}")
            for s in ("ok", "dropped", "malformed", "fatal")
        ],
        F.min(F.when(F.col("status") == "fatal", fault)).alias("fatal"),
        F.min(F.when(malformed & combatant, fault)).alias("combatant"),
        F.slice(
            F.array_sort(F.collect_list(F.when(malformed & ~combatant, fault))), 1, keep
        ).alias("others"),
    )
    ranges = settle(ranges)
    if numbered:
        return ranges.drop("rows", "first", "split_start")
    moved = lambda x: F.when(
        x.isNotNull(),
        F.struct((x["line_no"] + F.col("shift")).alias("line_no"), x["status_error"].alias("status_error")),
    )
    return ranges.join(_shifts(ranges), ["file", "split_start"]).select(
        "file",
        "line_range",
        *[c for c in ranges.columns if c.startswith("n_")],
        moved(F.col("fatal")).alias("fatal"),
        moved(F.col("combatant")).alias("combatant"),
        F.transform("others", moved).alias("others"),
    )


def _shifts(ranges: DataFrame) -> DataFrame:
    """``file, split_start, shift``: what turns a place into a line number; a row per split."""
    splits = ranges.groupBy("file", "split_start").agg(F.sum("rows").alias("rows"), F.min("first").alias("first"))
    earlier = W.partitionBy("file").orderBy("split_start").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    return splits.select("file", "split_start", (before - F.col("first") + 1).alias("shift"))


def with_line_numbers(reported: DataFrame, events: DataFrame) -> DataFrame:
    """Add ``line_no`` to the lines of ``events`` that are reported.

    ``events`` are all lines with ``file, split_start, place``, blank ones too; only these
    columns are read and counted, one row per split comes out. Lines that have a number keep it.
    """
    if "line_no" in reported.columns:
        return reported
    rows = events.groupBy("file", "split_start").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    shifts = broadcast_if_small(settle(_shifts(rows)))
    joined = reported.join(shifts, ["file", "split_start"])
    return joined.withColumn("line_no", F.col("place") + F.col("shift")).drop("shift", "split_start", "place")


def file_summary(events: DataFrame, keep: int = MAX_BAD_LINES + 1) -> DataFrame:
    """One row per file: its counts, first fatal line, first bad combatant and first ``keep``
    other malformed lines. Summaries of the pieces of a log can be merged."""
    ranges = _range_summary(events, keep)
    counts = [c for c in ranges.columns if c.startswith("n_")]
    totals = ranges.groupBy("file").agg(
        *[F.sum(c).alias(c) for c in counts],
        F.min("fatal").alias("fatal"),
        F.min("combatant").alias("combatant"),
    )
    nth = W.partitionBy("file").orderBy("fault.line_no")
    others = (
        ranges.select("file", F.explode("others").alias("fault"))
        .withColumn("nth", F.row_number().over(nth))
        .where(F.col("nth") <= keep)
        .groupBy("file")
        .agg(F.array_sort(F.collect_list("fault")).alias("others"))
    )
    return totals.join(others, "file", "left").withColumn(
        "others", F.coalesce("others", F.array().cast("array<struct<line_no: bigint, status_error: string>>"))
    )


def file_status(
    events: DataFrame, *, max_bad_lines: int = MAX_BAD_LINES, files: DataFrame | None = None
) -> DataFrame:
    """One row per file: ``ok``, and for a rejected file the reason, line and error.

    ``files`` (column ``file``, as from ``list_files``) adds the files without a line: they
    are good and count no lines.

    The verdict is the earliest of: first fatal line, first malformed combatant line, the
    malformed line after the allowed ones. One pass over the events; what leaves the map
    side is a row per range of lines, and the last step sees at most a few rows per range.
    Events of ``mode="position"`` give the same numbers.
    """
    keep = max_bad_lines + 1
    totals = file_summary(events, keep).withColumn("limit", F.get("others", F.lit(max_bad_lines)))
    counts = [c for c in totals.columns if c.startswith("n_")]
    if files is not None:
        totals = files.select("file").distinct().join(totals, "file", "left")
        totals = totals.fillna(0, subset=counts)
    first = F.least(
        *[
            F.when(
                F.col(kind).isNotNull(),
                F.struct(
                    F.col(f"{kind}.line_no").alias("line_no"),
                    F.lit(reason).alias("reason"),
                    F.col(f"{kind}.status_error").alias("error"),
                ),
            )
            for kind, reason in REASONS.items()
        ]
    )
    return totals.select(
        "file",
        first.isNull().alias("ok"),
        first["reason"].alias("reason"),
        first["line_no"].alias("reject_line"),
        first["error"].alias("error"),
        *counts,
    )


def rejected_files(status: DataFrame) -> DataFrame:
    """``file, reject_line`` of the rejected files, settled and sized for a broadcast."""
    bad = status.where(~F.col("ok")).select("file", "reject_line")
    return broadcast_if_small(settle(bad))


def apply_quarantine(events: DataFrame, status: DataFrame) -> DataFrame:
    """Good events of the accepted files: the rest of a rejected file is dropped whole."""
    bad = rejected_files(status).select("file")
    return events.where(F.col("status") == "ok").join(bad, "file", "left_anti")


def accepted_events(events: DataFrame, status: DataFrame, *, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``apply_quarantine`` as a filter: no join, and no event is shuffled at any number of rejected files.

    ``status`` must hold every file of ``events``. Only where the filter itself would take
    more than ``max_bytes`` is it left to the join.
    """
    names = lambda rows: rows.select(F.col("file").alias("name"))
    rejected = member(names(status.where(~F.col("ok"))), names(status.where("ok")), max_bytes)
    if rejected is None:
        return apply_quarantine(events, status)
    return events.where(~rejected(F.col("file"))).where(F.col("status") == "ok")


def seen_lines(events: DataFrame, status: DataFrame) -> DataFrame:
    """Events up to the rejecting line of their file, as later lines are never read."""
    return (
        events.join(rejected_files(status), "file", "left")
        .where("reject_line is null or line_no <= reject_line")
        .drop("reject_line")
    )


def warning_id(label: str, reason: str, file: str, cols: str) -> str:
    """First 8 hex digits of the MD5 of event, reason, file and sample fields."""
    return f"left(md5(concat_ws('|', {label}, {reason}, {file}, {quoted_list(cols)})), 8)"


def warning_lines(events: DataFrame) -> DataFrame:
    """One row per warning: its id, what it is about, and the start of the raw line."""
    return events.where("warning_label is not null").selectExpr(
        "file",
        "line_no",
        f"{warning_id('warning_label', 'warning_reason', 'file', 'warning_cols')} as warning_id",
        "warning_label as event",
        "warning_message as message",
        "warning_reason as reason",
        f"{quoted_list('warning_cols')} as cols",
        "substring(raw, 1, 500) as sample",
    )


def parse_warnings(warnings: DataFrame) -> DataFrame:
    """Warnings by id: how often and from which line to which."""
    return warnings.groupBy("file", "warning_id", "event", "reason", "cols").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("line_no").alias("first_line"),
        F.max("line_no").alias("last_line"),
    )


def warning_occurrence(warnings: DataFrame) -> DataFrame:
    """Running number of each warning id inside its file."""
    warnings = settle(warnings)
    return running_count(warnings, ["file", "warning_id"], "line_no", "occurrence")


def rejections(status: DataFrame) -> DataFrame:
    """``file, line_no, message`` of each rejected file."""
    message = F.concat_ws(": ", "reason", "error")
    return status.where(~F.col("ok")).select("file", F.col("reject_line").alias("line_no"), message.alias("message"))


def error_rollup(status: DataFrame) -> DataFrame:
    """Messages of the rejected files with their repeat counts."""
    return rejections(status).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


def skipped_lines(events: DataFrame, status: DataFrame) -> DataFrame:
    """Malformed lines that were read and left out: ``file, line_no, error, raw, occurrence``.

    ``occurrence`` is the running number of the error in its file. The line that rejects a
    file is in ``rejections``; later ones are never read.
    """
    bad = with_line_numbers(events.where(F.col("status") == "malformed"), events)
    bad = bad.join(rejected_files(status), "file", "left")
    bad = bad.where("reject_line is null or line_no < reject_line")
    found = settle(bad.select("file", "line_no", F.col("status_error").alias("error"), "raw"))
    return running_count(found, ["file", "error"], "line_no", "occurrence")


def run_summary(status: DataFrame) -> DataFrame:
    """Converted and skipped files, and the lines by status."""
    return status.agg(
        F.count_if("ok").alias("converted"),
        F.count_if(~F.col("ok")).alias("skipped"),
        *[
            F.coalesce(F.sum(f"n_{s}"), F.lit(0)).alias(f"n_{s}")
            for s in ("lines", "ok", "dropped", "malformed", "fatal")
        ],
    )


def quality_tables(events: DataFrame, status: DataFrame, path: str) -> None:
    """Write ``file_status``, ``rejections``, ``skipped_lines`` and ``parse_warnings`` below ``path``."""
    status.write.mode("overwrite").parquet(f"{path}/file_status")
    rejections(status).write.mode("overwrite").parquet(f"{path}/rejections")
    skipped_lines(events, status).write.mode("overwrite").parquet(f"{path}/skipped_lines")
    warned = with_line_numbers(events.where("warning_label is not null"), events)
    warnings = parse_warnings(warning_lines(seen_lines(warned, status)))
    warnings.write.mode("overwrite").parquet(f"{path}/parse_warnings")
