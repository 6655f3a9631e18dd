"""Removal of repeated word sequences by compaction of a De Bruijn graph.

Every window of ``window`` words is an edge of the graph. Edges are never shuffled one by one:
consecutive windows whose least k-mer (by hash) is the same one, the anchor, form a piece of a
nonbranching path, and a piece is one row. Equal windows have equal anchors at equal places, so
windows can only be equal within one anchor. Then, by Spark joins:

1. anchors that occur once are dropped;
2. equal pieces are compacted to one path, with the coordinates of its first place; every
   other place of it is repeated as a whole;
3. an anchor with several paths is a branch. There, and only in the first place of each path,
   single windows are compared; their text is read again at the coordinates.

Stretches that touch, and whose sources advance with them, are joined to long spans.

Sequences are identified by 128 bits: two hashes computed apart. A hot anchor is counted on the
map side, and its join can be split. Documents with a third of all words need no more than
themselves in one task.

A word is removed if a window that covers it has a word sequence that also starts earlier: in a
smaller doc_id, or in the same document before. Words: runs of characters other than space and
0x09 to 0x0D, unchanged. Null and empty texts, and texts shorter than a window, lose nothing. A
null doc_id is before all others. doc_id and text (by 64 bits of hash) name a document: rows
equal in both are one document, do not repeat one another, and come out as often as they go in.
Other rows of one doc_id, or without one, are documents of their own, in the order of that hash.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import any_id, id_key, id_of, map_stream, mix, ranges, settle, small, table, texts_of

WINDOW = 20
_ONE = np.uint64(0x9E3779B97F4A7C15)
_TWO = np.uint64(0xC2B2AE3D27D4EB4F)


def anchor_length(window: int) -> int:
    return 8 if window >= 16 else max(1, window // 2)


class Words:
    """64-bit word hashes, kept for words met again, up to a bound."""

    class _Known(dict):
        def __missing__(self, word: bytes) -> int:
            found = self[word] = xxhash.xxh64_intdigest(word)
            return found

    def __init__(self, most: int = 1 << 20):
        self.known, self.most = self._Known(), most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def grams(x: np.ndarray, n: int, by: np.uint64 = _ONE) -> np.ndarray:
    """Hash of the ``n`` words from each place on; one shorter for each word after the first."""
    powers = {1: x}
    size = 1
    while size * 2 <= n:
        half = powers[size]
        powers[size * 2] = mix(half[: len(half) - size] * by + half[size:])
        size *= 2
    out, done = powers[size], size
    while done < n:
        while size > n - done:
            size //= 2
        out = mix(out[: len(out) - size] * by + powers[size][done : done + len(out) - size])
        done += size
    return out


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Place of the least of ``n`` values from each place on, the leftmost of equal ones."""
    best, size = np.arange(len(x)), 1
    while size < n:
        step = min(size, n - size)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(x[right] < x[left], right, left)
        size += step
    return best


def pieces(texts: list[bytes], words: Words, window: int) -> tuple[np.ndarray, ...]:
    """anchor, path, text, start, windows of each piece; start counts words of its text."""
    split = [t.split() for t in texts]
    n = np.array([len(w) for w in split], np.int64)
    begin = np.cumsum(n) - n
    many = np.maximum(n - window + 1, 0)
    at = ranges(begin, many)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    x = words([w for ws in split for w in ws])
    k = anchor_length(window)
    mers = grams(x, k)
    anchor = _least(mers, window - k + 1)[at]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    size = np.diff(np.append(first, len(at)))
    start = at[first]
    # The first and the last window cover the whole piece.
    whole = grams(x, window, _TWO)
    path = mix(whole[start] * _ONE + mix(whole[start + size - 1] + size.astype(np.uint64)))
    text = np.searchsorted(begin, start, "right") - 1
    return mers[anchor[first]].view(np.int64), path.view(np.int64), text, start - begin[text], size


def text_hash() -> Column:
    """Tells texts of one doc_id apart."""
    return F.xxhash64(F.col("text").cast("string"))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(id_key().alias("key"), text_hash().alias("hash"), F.col("text").cast("string").alias("text"))


def piece_table(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``anchor, path, key, hash, start, n``: the pieces of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words = Words()
        for batch in batches:
            anchor, path, text, start, n = pieces(texts_of(batch.column("text")), words, window)
            yield {"anchor": anchor, "path": path, "key": np.asarray(batch.column("key"))[text], "hash": np.asarray(batch.column("hash"))[text], "start": start, "n": n}

    return map_stream(_rows(docs), run, "anchor long, path long, key long, hash long, start int, n int")


def _single_windows(docs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """``one, two, key, hash, start``: the windows that begin in places(key, hash, start, n), read from the texts."""
    own = places.groupBy("key", "hash").agg(F.collect_list(F.struct("start", "n")).alias("places"))  # bounded by one document

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words = Words()
        for batch in batches:
            found = {"one": [], "two": [], "key": [], "hash": [], "start": []}
            for key, hash_, text, places_ in zip(batch.column("key").to_pylist(), batch.column("hash").to_pylist(), texts_of(batch.column("text")), batch.column("places")):
                x = words(text.split())
                if len(x) < window:
                    continue
                at = ranges(np.asarray(places_.values.field("start")), np.asarray(places_.values.field("n")))
                at = at[at <= len(x) - window]
                found["one"].append(grams(x, window, _ONE)[at].view(np.int64))
                found["two"].append(grams(x, window, _TWO)[at].view(np.int64))
                found["key"].append(np.full(len(at), key))
                found["hash"].append(np.full(len(at), hash_))
                found["start"].append(at)
            yield {name: np.concatenate([np.empty(0, np.int64), *parts]) for name, parts in found.items()}

    return map_stream(_rows(docs).join(own, ["key", "hash"]), run, "one long, two long, key long, hash long, start int")


def repeated_places(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key, hash, start, n, from_key, from_hash, from_start``: ``n`` words that also start earlier, and where they do first.

    Places may overlap; each is ``window`` words or more.
    """
    if window < 2:
        raise ValueError("a window has two words or more")
    all_ = piece_table(docs, window)
    # Settled, as Spark splits a hot key of a join only if both sides come straight from an exchange.
    often = settle(all_.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor"), "anchors")
    some = settle(all_.join(often, "anchor"), "pieces")
    source = [F.col(f"first.{n}").alias(f"from_{n}") for n in ("key", "hash", "start")]
    paths = some.groupBy("anchor", "path").agg(F.min(F.struct("key", "hash", "start", "n")).alias("first"))
    paths = settle(paths.select("anchor", "path", *source, "first.n"), "paths")
    earlier = F.struct("from_key", "from_hash", "from_start") < F.struct("key", "hash", "start")
    whole = some.join(paths.drop("n"), ["anchor", "path"]).where(earlier)
    whole = whole.select("key", "hash", "start", (F.col("n") + (window - 1)).alias("n"), "from_key", "from_hash", "from_start")
    branch = settle(paths.groupBy("anchor").agg(F.count("*").alias("ways")).where("ways > 1").select("anchor"), "branches")
    places = paths.join(branch, "anchor").select(F.col("from_key").alias("key"), F.col("from_hash").alias("hash"), F.col("from_start").alias("start"), "n")
    single = settle(_single_windows(docs, places, window), "windows")
    firsts = single.groupBy("one", "two").agg(F.min(F.struct("key", "hash", "start")).alias("first"), F.count("*").alias("times")).where("times > 1")
    firsts = settle(firsts.select("one", "two", *source), "firsts")
    alone = single.join(firsts, ["one", "two"]).where(earlier).select("key", "hash", "start", F.lit(window).alias("n"), "from_key", "from_hash", "from_start")
    return whole.unionByName(alone)


@any_id("doc_id", "from_doc_id")
def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, start, n, from_doc_id, from_start``: long repeated spans in words.

    Places of one document that touch and whose source places advance with them are one span.
    """
    found = repeated_places(docs, window).withColumn("shift", F.col("start") - F.col("from_start"))
    lane = Window.partitionBy("key", "hash", "from_key", "from_hash", "shift").orderBy("start")
    ends = found.withColumn("end", F.max(F.col("start") + F.col("n")).over(lane.rowsBetween(Window.unboundedPreceding, -1)))
    runs = ends.withColumn("run", F.sum(F.when(F.col("start") <= F.col("end"), 0).otherwise(1)).over(lane))
    spans = runs.groupBy("key", "hash", "from_key", "from_hash", "shift", "run").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("end"), F.min("from_start").alias("from_start"))
    return spans.select(id_of("key").alias("doc_id"), "start", (F.col("end") - F.col("start")).alias("n"), id_of("from_key").alias("from_doc_id"), "from_start")


def _with_places(docs: DataFrame, window: int) -> tuple[DataFrame, str]:
    """docs with the places to remove, null where there are none, and that column's name, which is none of docs."""
    tag = f"_{uuid.uuid4().hex}_"
    key, hash_, name = f"{tag}key", f"{tag}hash", f"{tag}places"
    # A set, as rows that are one document all find the same places.
    places = repeated_places(docs, window).groupBy("key", "hash").agg(F.collect_set(F.struct("start", "n")).alias(name))
    places = settle(places.withColumnsRenamed({"key": key, "hash": hash_}), "removed")
    return docs.withColumns({key: id_key(), hash_: text_hash()}).join(places, [key, hash_], "left").drop(key, hash_), name


def _kept(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """Row, words and kept words of each row."""
    at = batch.schema.get_field_index
    for row, (text, places) in enumerate(zip(texts_of(batch.column(at("text"))), batch.column(at(name)))):
        words = text.split()
        if not places.is_valid:
            yield row, words, words
            continue
        start = np.asarray(places.values.field("start"))
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, np.minimum(start, len(words)), 1)
        np.add.at(change, np.minimum(start + np.asarray(places.values.field("n")), len(words)), -1)
        yield row, words, [words[k] for k in np.flatnonzero(np.cumsum(change)[: len(words)] == 0).tolist()]


@any_id("doc_id")
def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without repeated words; all columns.

    A text that loses nothing stays as it is; in others the kept words are joined by one space,
    and ``n_chars``, where there is such a number, is their length. A document that loses all
    its words is left out.
    """
    names = docs.columns
    found, places = _with_places(docs, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            at = batch.schema.get_field_index
            texts, stay = batch.column(at("text")).to_pylist(), np.ones(batch.num_rows, bool)
            chars = batch.column(at("n_chars")).to_pylist() if "n_chars" in names else None
            for row, words, kept in _kept(batch, places):
                if len(kept) < len(words):
                    texts[row] = b" ".join(kept).decode("utf-8", "replace")
                    stay[row] = bool(kept)
                    if chars:
                        chars[row] = len(texts[row])
            new = {"text": texts, "n_chars": chars}
            columns = [pa.array(new[n], type=batch.schema.field(n).type) if new.get(n) is not None else batch.column(at(n)) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(stay))

    return found.mapInArrow(run, docs.schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and a digest of the kept ones of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found = [(len(w), len(w) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for _, w, k in _kept(batch, places)]
            yield {"doc_id": batch.column("doc_id"), **{name: [f[k] for f in found] for k, name in enumerate(("n_words", "n_removed", "kept_sha256"))}}

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, places = _with_places(docs, WINDOW)
    return map_stream(found, run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


OP2_SQL = r"""
WITH own AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS sequence FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS s FROM own)),
repeated AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY sequence ORDER BY doc_id NULLS FIRST, s) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, s + k AS place, true AS gone FROM repeated, (SELECT unnest(range(20)) AS k)),
each AS (SELECT doc_id, words[place] AS word, place FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS place FROM own)),
kept AS (SELECT doc_id, count(gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone IS NULL) AS kept
  FROM each LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM own LEFT JOIN kept USING (doc_id)
"""
