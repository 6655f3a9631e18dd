"""Token counts of documents in flat, unindexed token files.

A flat file is token numbers of a fixed width on end; a document ends at an end-of-document
number. There is no index, so documents are found by a scan: each file is cut in blocks without
regard to documents, numpy searches a block for the separator in one step, and a prefix scan
over the blocks' lengths and separators gives the place of each separator in its file and the
start of the document that a block's first separator ends. The scan has two levels, runs of
``RUN`` blocks and then the runs, so a file of any size needs no more than a file's runs in one
task. Only separators leave their block.

``flatten`` makes such files from texts, one for each input partition, as a table of blocks in
the shared folder; the ids of the documents that end in a block are a column of their own,
which the scan does not read. ``read_flat`` reads raw files of the same form.

A null text is an empty document: a separator alone, 0 tokens. Tokens after the last separator
of a file are a document that is not closed. Ids may be null or repeat; each row is a document.
A file without tokens has no documents. Other columns do not matter. Empty tables give no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import any_id, map_stream, settle, table, texts_of

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How texts are cut before merging (a fixed value of the vocabulary).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50_256
#: Bytes of a block, and blocks of a run.
BLOCK = 1 << 16
RUN = 1024


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def tokenizer(ranks: dict[bytes, int], pattern: str = PATTERN):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def flatten(docs: DataFrame, path: str = RANKS, end: int = END, block: int = BLOCK) -> DataFrame:
    """``file, block, tokens, doc_ids``: texts as flat files of 2-byte numbers, settled."""
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    if max(max(shared.value.values(), default=0), end) >= 1 << 16:
        raise ValueError("token numbers must fit in two bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = tokenizer(shared.value).encode_to_numpy
        name, number = f"part-{TaskContext.get().partitionId():06d}", 0
        rest, ids = b"", []  # bytes without a block so far; (place of the separator, doc_id)
        stop = np.array([end], "<u2").tobytes()
        for batch in batches:
            parts, size = [rest], len(rest)
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                own = encode(text.decode("utf-8", "replace"), disallowed_special=()).astype("<u2").tobytes() + stop
                parts.append(own)
                size += len(own)
                ids.append((size - len(stop), doc))
            data = b"".join(parts)
            whole = len(data) // block
            if whole:
                cut = [[] for _ in range(whole + 1)]
                for at, doc in ids:
                    cut[at // block].append((at, doc))
                yield {"file": [name] * whole, "block": range(number, number + whole), "tokens": [data[k * block : (k + 1) * block] for k in range(whole)], "doc_ids": [[d for _, d in c] for c in cut[:-1]]}
                number += whole
                ids = [(at - whole * block, doc) for at, doc in cut[-1]]
            rest = data[whole * block :]
        if rest:
            yield {"file": [name], "block": [number], "tokens": [rest], "doc_ids": [[d for _, d in ids]]}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return settle(map_stream(rows, run, "file string, block long, tokens binary, doc_ids array<long>"), "tokens")


def read_flat(spark: SparkSession, paths: str | list[str], width: int = 2, block: int = BLOCK) -> DataFrame:
    """``file, block, tokens`` of raw files; large ones are read in parallel.

    A block's length divides its file's, since that is what Spark's reader of fixed-length
    records needs; a length without a good divisor makes small blocks, not wrong ones.
    """
    files = spark.read.format("binaryFile").load(paths).where("length > 0").select("path", "length").collect()  # names and lengths only
    parts = [spark.createDataFrame([], "file string, block long, tokens binary")]
    for path, length in files:
        if length % width:
            raise ValueError(f"{path} is no file of {width}-byte numbers")
        n = length // width
        size = width * next(d for d in range(min(n, block // width), 0, -1) if n % d == 0)
        records = spark.sparkContext.newAPIHadoopFile(
            path, "org.apache.spark.input.FixedLengthBinaryInputFormat", "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.BytesWritable",
            conf={"org.apache.spark.input.FixedLengthBinaryInputFormat.recordLength": str(size)},
        )
        parts.append(spark.createDataFrame(records.map(lambda x, path=path: (path, x[0], bytes(x[1]))), "file string, block long, tokens binary"))
    return reduce(DataFrame.unionByName, parts)


def separators(blocks: DataFrame, end: int = END, width: int = 2) -> DataFrame:
    """``file, block, n, found``: tokens of each block, and the places of separators in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            arrays = [np.frombuffer(x, f"<u{width}") for x in texts_of(batch.column("tokens"))]
            found = [np.flatnonzero(x == end) for x in arrays]
            yield {"file": batch.column("file"), "block": batch.column("block"), "n": [len(x) for x in arrays], "found": found}

    return map_stream(blocks.select("file", "block", "tokens"), run, "file string, block long, n long, found array<long>")


def documents(blocks: DataFrame, end: int = END, width: int = 2) -> DataFrame:
    """``file, ordinal, start, n_tokens, closed, block, place``: every document of flat files.

    ordinal counts the documents of a file, start is in tokens; block and place tell the
    separator: its block and its number there.
    """
    seen = separators(blocks, end, width).withColumn("run", F.floor(F.col("block") / RUN))
    seen = settle(seen.withColumn("many", F.size("found").cast("long")).withColumn("last", F.get("found", F.size("found") - 1)), "separators")
    # Level one: what is before a block in its run. Level two: what is before the run.
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sofar = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    seen = seen.withColumn("tokens_before", sofar("n", inside)).withColumn("docs_before", sofar("many", inside))
    seen = seen.withColumn("end", F.col("tokens_before") + F.col("last"))
    seen = seen.withColumn("end_before", F.max("end").over(inside))
    runs = seen.groupBy("file", "run").agg(F.sum("n").alias("n"), F.sum("many").alias("many"), F.max("end").alias("end"))
    across = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_tokens", sofar("n", across)).withColumn("run_docs", sofar("many", across))
    runs = runs.withColumn("run_end", F.max(F.col("run_tokens") + F.col("end")).over(across))
    base = seen.join(runs.select("file", "run", "run_tokens", "run_docs", "run_end"), ["file", "run"])
    base = base.select(
        "file", "block", "n", "found", (F.col("run_tokens") + F.col("tokens_before")).alias("base"), (F.col("run_docs") + F.col("docs_before")).alias("first"),
        F.coalesce(F.col("run_tokens") + F.col("end_before"), F.col("run_end"), F.lit(-1)).alias("before"),
    )
    ends = F.transform("found", lambda x: x + F.col("base"))
    spans = F.transform(ends, lambda e, k: F.struct(F.when(k == 0, F.col("before") + 1).otherwise(F.get(F.col("found"), k - 1) + F.col("base") + 1).alias("start"), e.alias("end")))
    closed = base.select("file", "block", "first", F.posexplode(spans).alias("place", "span"))
    closed = closed.select("file", (F.col("first") + F.col("place")).alias("ordinal"), "span.start", (F.col("span.end") - F.col("span.start")).alias("n_tokens"), F.lit(True).alias("closed"), "block", "place")
    whole = base.groupBy("file").agg(F.sum("n").alias("n"), F.sum(F.size("found")).alias("ordinal"), F.max(F.greatest("before", F.coalesce(F.get("found", F.size("found") - 1) + F.col("base"), F.lit(-1)))).alias("before"))
    open_ = whole.where("n > before + 1").select("file", "ordinal", (F.col("before") + 1).alias("start"), (F.col("n") - F.col("before") - 1).alias("n_tokens"), F.lit(False).alias("closed"), F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("place"))
    return closed.unionByName(open_)


@any_id("doc_id")
def token_counts(docs: DataFrame, path: str = RANKS, end: int = END, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_tokens, file, ordinal, start`` of every row of docs, by a scan of their flat files."""
    flat = flatten(docs, path, end, block)
    ids = flat.select("file", "block", F.posexplode("doc_ids").alias("place", "doc_id"))
    return documents(flat, end).where("closed").join(ids, ["file", "block", "place"]).select("doc_id", "n_tokens", "file", "ordinal", "start")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"))
