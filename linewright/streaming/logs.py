"""The same transforms over a file-source stream.

The checkpoint of a query is its manifest: a file is taken in once. A file is its path, and it is
read in splits, so its size has no limit and a large one spreads over many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from linewright.operators.header import parse_header
from linewright.operators.payloads import parse_events
from linewright.operators.profile import event_profile
from linewright.operators.quality import MAX_BAD_LINES, REASONS, file_summary
from linewright.operators.sizing import broadcast_if_small, settle
from linewright.sources.lines import GLOB, _split_lines, list_files, with_place

_COUNTS = ("n_lines", "n_ok", "n_dropped", "n_malformed", "n_fatal")
_FAULT = "struct<line_no: bigint, status_error: string>"
PIECE = (
    "file string, log string, rows bigint, "
    + ", ".join(f"{c} bigint" for c in _COUNTS)
    + f", fatal {_FAULT}, combatant {_FAULT}, others array<{_FAULT}>"
)
VERDICT = (
    "log string, ok boolean, reason string, reject_line bigint, error string, pieces bigint, "
    + ", ".join(f"{c} bigint" for c in _COUNTS)
)
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_lines(
    spark: SparkSession, path: str, *, max_files: int | None = None, glob: str = GLOB
) -> DataFrame:
    """Lines of arriving files with their path and the start of their split, blank lines too."""
    reader = spark.readStream.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _split_lines(reader.load(path), by_path=True)


def stream_events(spark: SparkSession, path: str, *, max_files: int | None = None, **options) -> DataFrame:
    """Parsed events of arriving files, append mode, no state. Blank lines have status ``blank``."""
    return parse_events(stream_lines(spark, path, max_files=max_files), **options)


def _trigger(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_gated(
    events: DataFrame,
    target: str,
    checkpoint: str,
    *,
    log: str = "file",
    source: str | None = None,
    max_bad_lines: int = MAX_BAD_LINES,
    available_now: bool = True,
) -> StreamingQuery:
    """Take arriving files in: their events, and a summary of each file for the gate.

    ``log`` is an expression over ``file`` for the log that a file is a piece of; by default
    a file is a log. A micro-batch writes ``data/batch=N`` once and then ``pieces/batch=N``,
    a row per file; a repeated batch replaces itself. With ``source``, the folder that is
    streamed, files without a byte are pieces too, though no stream sees them.

    Verdicts come from ``start_verdicts``; ``read_gated`` shows the good events.
    """
    spark = events.sparkSession

    def take_in(batch: DataFrame, batch_id: int) -> None:
        with_place(batch).withColumn("log", F.expr(log)).write.mode("overwrite").parquet(f"{target}/data/batch={batch_id}")
        staged = spark.read.parquet(f"{target}/data/batch={batch_id}")
        rows = staged.groupBy("file", "log").agg(F.count(F.lit(1)).alias("rows"))
        pieces = file_summary(staged, max_bad_lines + 1).join(rows, "file")
        wanted = spark.createDataFrame([], PIECE)
        if source is not None:
            empty = list_files(spark, source, by_path=True, recursive=True).where("file_size = 0")
            known = _folder(spark, f"{target}/pieces", PIECE).where(f"batch < {batch_id} and rows = 0").select("file")
            new = empty.select("file").join(known, "file", "left_anti").withColumn("log", F.expr(log))
            wanted = new.select("file", "log", *[F.lit(0).cast("bigint").alias(c) for c in ("rows", *_COUNTS)])
        pieces.unionByName(wanted, allowMissingColumns=True).select(*spark.createDataFrame([], PIECE).columns).write.mode(
            "overwrite"
        ).parquet(f"{target}/pieces/batch={batch_id}")

    return _trigger(events.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint), available_now)


def _folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of batches, which may not be there yet."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], f"{schema}, batch bigint")
    return spark.read.schema(f"{schema}, batch bigint").parquet(path)


class Gate(StatefulProcessor):
    """State of a log: counts, and the faults that decide. At most ``keep`` malformed lines are kept."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle) -> None:
        self.state = handle.getValueState("log", "rows bigint, pieces bigint, counts string, faults string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, pieces, counts, faults = 0, 0, dict.fromkeys(_COUNTS, 0), {"fatal": [], "combatant": [], "others": []}
        if self.state.exists():
            total, pieces, c, f = self.state.get()
            counts, faults = json.loads(c), json.loads(f)
        arrived = pd.concat(list(rows)).sort_values("file", kind="stable")
        for piece in arrived.to_dict("records"):
            # Lines of earlier pieces come first.
            found = lambda x: [total + int(x["line_no"]), x["status_error"]]
            for kind in ("fatal", "combatant"):
                if isinstance(piece[kind], dict):
                    faults[kind] = min(faults[kind] or found(piece[kind]), found(piece[kind]))
            others = piece["others"] if piece["others"] is not None else []
            faults["others"] = (faults["others"] + [found(x) for x in others])[: self.keep]
            for c in _COUNTS:
                counts[c] += int(piece[c])
            total, pieces = total + int(piece["rows"]), pieces + 1
        self.state.update((total, pieces, json.dumps(counts), json.dumps(faults)))
        limit = faults["others"][self.keep - 1] if len(faults["others"]) >= self.keep else []
        first = min(((*at, reason) for at, reason in zip((faults["fatal"], faults["combatant"], limit), REASONS.values()) if at), key=lambda x: x[0], default=None)
        line, error, reason = first or (None, None, None)
        yield pd.DataFrame(
            {
                "log": [key[0]], "ok": [first is None], "reason": [reason], "reject_line": pd.array([line], "Int64"),
                "error": [error], "pieces": [pieces], **{c: [counts[c]] for c in _COUNTS},
            }
        )

    def close(self) -> None:
        pass


def start_verdicts(
    spark: SparkSession, target: str, checkpoint: str, *, max_bad_lines: int = MAX_BAD_LINES, available_now: bool = True
) -> StreamingQuery:
    """Verdicts over the pieces of ``start_gated``, with the state of each log kept between batches.

    A log whose pieces arrive over several batches is judged as one: the verdict after its
    last piece is the one of the whole log. Each change goes to ``verdicts/batch=N``.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    pieces = spark.readStream.schema(PIECE).parquet(f"{target}/pieces")
    verdicts = pieces.groupBy("log").transformWithStateInPandas(
        statefulProcessor=Gate(max_bad_lines + 1), outputStructType=VERDICT, outputMode="Update", timeMode="None"
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/verdicts/batch={batch_id}")

    writer = verdicts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now)


def read_verdicts(spark: SparkSession, target: str) -> DataFrame:
    """The newest verdict of every log."""
    seen = _folder(spark, f"{target}/verdicts", VERDICT)
    columns = [c for c in seen.columns if c != "batch"]
    return seen.groupBy("log").agg(F.max_by(F.struct(*columns), "batch").alias("v")).select("v.*")


def read_gated(spark: SparkSession, target: str) -> DataFrame:
    """Good events of the logs that are accepted by now.

    What is left out is a row per rejected log, and per log with a piece that no verdict
    holds yet: those wait, whole, for their verdict.
    """
    verdicts = read_verdicts(spark, target).select("log", "ok", "pieces")
    pieces = _folder(spark, f"{target}/pieces", PIECE).groupBy("log").agg(F.count(F.lit(1)).alias("n"))
    blocked = pieces.join(verdicts, "log", "left").where("ok is null or not ok or pieces < n").select("log")
    data = spark.read.parquet(f"{target}/data").where("status = 'ok'")
    return data.join(broadcast_if_small(settle(blocked)), "log", "left_anti")


def stream_profile(spark: SparkSession, path: str, **options) -> DataFrame:
    """Running event profile; use output mode ``complete``. State is a row per event type."""
    return event_profile(parse_header(stream_lines(spark, path).where("raw <> ''"), **options))


_PROFILE = "event string, n bigint, min_fields int, max_fields int"


def start_profile(spark: SparkSession, path: str, target: str, checkpoint: str, *, available_now: bool = True, **options) -> StreamingQuery:
    """Running profile in update mode: each batch writes only the event types that changed.

    ``read_profile`` takes the newest row of each type. A batch that is repeated after a
    restart replaces itself, so nothing is counted twice.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    changed = stream_profile(spark, path, **options).writeStream.outputMode("update")
    return _trigger(changed.foreachBatch(keep).option("checkpointLocation", checkpoint), available_now)


def read_profile(spark: SparkSession, target: str) -> DataFrame:
    """The profile after the newest finished batch."""
    seen = _folder(spark, target, _PROFILE)
    newest = F.max_by(F.struct("n", "min_fields", "max_fields"), "batch").alias("p")
    return seen.groupBy("event").agg(newest).select("event", "p.*")
