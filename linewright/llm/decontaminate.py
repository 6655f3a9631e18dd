"""Benchmark decontamination with suffix arrays over the training documents.

Each Arrow batch of documents is a shard. Its words become numbers of the benchmark's
vocabulary (0: a word no item has, and the end of each document), and its suffixes are sorted.
Suffixes that do not share their first words with any item cannot match and get no place in the
array. All suffixes of all items are then searched at once: an interval of the array for each,
narrowed word by word with binary searches until it is empty, which gives the longest verbatim
match and every place of it. The shards need no shuffle, since a document is in one shard.

The benchmark is read in blocks of bounded size, so what goes to the executors does not grow
with it; more blocks mean more passes.

Words: A-Z lower-cased, then runs of digits, letters a-z and non-ASCII characters. A window is
``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
Null and empty texts have no words, hit nothing and are kept. A null item_id reads as an empty
one; rows with one item_id are one item. Rows of equal doc_id and text come out as often as
they go in. An empty benchmark hits nothing. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, any_id, id_key, id_of, map_batches, ranges, small, table, texts_of

WINDOW = 10
#: Bytes of benchmark text in one pass over the documents on average; twice that at most, unless
#: one item alone is longer.
BLOCK_BYTES = 16 << 20


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """Blocks of (item_id, text) that hold each item once; an empty benchmark gives one empty block."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("binary").alias("text")).where("text is not null")
    size = F.length("text") + F.length("id") + 16
    total = items.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    while n > 1:
        part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
        worst = items.groupBy(part.alias("part")).agg(F.sum(size).alias("bytes"), F.countDistinct("id", "text").alias("items"))
        if not worst.where((F.col("bytes") > 2 * block_bytes) & (F.col("items") > 1)).limit(1).count():
            break
        n *= 2
    for k in range(n):  # one block at a time is on the driver
        yield [(r.id, bytes(r.text)) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).distinct().collect()]


class Probe:
    """The items of a block as one row of word numbers, with what the search needs."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        numbers, item, last, starts, ends, short = [0], [], 0, [], [], window
        index = {name: k for k, name in enumerate(self.names)}
        for name, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text.translate(ALNUM).split()]
            if not words:
                continue
            starts.append(np.arange(len(numbers), len(numbers) + len(words)))
            ends.append(np.full(len(words), len(numbers) + len(words)))
            item.append(np.full(len(words), index[name]))
            numbers += [*words, 0]
            short = min(short, len(words))
            last = max(last, len(words))
        join = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        self.numbers = np.array(numbers, np.int64)
        self.starts, self.ends, self.item, self.longest = join(starts), join(ends), join(item), last
        first = np.array([s[0] for s in starts for _ in s], np.int64)
        self.need = np.minimum(window, self.ends - first)
        #: Words that any match has at least; one or two of them select the suffixes to sort.
        self.prefix = min(2, short)
        self.pairs = np.unique(self.codes(self.numbers, self.starts))

    def codes(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        base = len(self.vocabulary) + 1
        return numbers[at] if self.prefix < 2 else numbers[at] * base + numbers[np.minimum(at + 1, len(numbers) - 1)]


def suffix_array(numbers: np.ndarray, starts: np.ndarray, depth: int, top: int) -> np.ndarray:
    """``starts`` in the order of their suffixes up to ``depth`` words; 0 ends a suffix.

    numbers: at most ``top``, and 0 at its end. Sorted a few words at a time; after each step
    only suffixes that still tie go on.
    """
    width = max(1, 62 // max(1, top.bit_length()))
    order, at, group = starts.copy(), np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for done in range(0, depth, width):
        key, alive = np.zeros(len(at), np.int64), np.ones(len(at), bool)
        for d in range(done, done + width):
            word = np.where(alive, numbers[np.minimum(order[at] + d, len(numbers) - 1)], 0)
            alive &= word != 0
            key = (key << top.bit_length()) | word
        rank = np.lexsort((key, group))
        order[at] = order[at[rank]]
        key, alive = key[rank], alive[rank]
        new = np.ones(len(at), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(new) - 1
        tied = (np.bincount(group, minlength=1)[group] > 1) & alive
        at, group = at[tied], group[tied]
        if not len(at):
            break
    return order


def _bound(numbers: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray, right: bool) -> np.ndarray:
    """First place in [low, high) whose word at ``depth`` is not below (right: is above) ``word``."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        there = numbers[np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, len(numbers) - 1)]
        go = open_ & ((there <= word) if right else (there < word))
        low = np.where(go, middle + 1, low)
        high = np.where(open_ & ~go, middle, high)
    return low


def search(numbers: np.ndarray, order: np.ndarray, probe: Probe) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each suffix of the items: longest match in words, and its interval of ``order`` at ``need`` words."""
    n = len(probe.starts)
    longest = np.zeros(n, np.int64)
    at_low, at_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.arange(n)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    depth = 0
    while len(live):
        word = probe.numbers[probe.starts[live] + depth]
        low, high = _bound(numbers, order, low, high, depth, word, False), _bound(numbers, order, low, high, depth, word, True)
        depth += 1
        on = low < high
        live, low, high = live[on], low[on], high[on]
        longest[live] = depth
        whole = probe.need[live] == depth
        at_low[live[whole]], at_high[live[whole]] = low[whole], high[whole]
        on = probe.starts[live] + depth < probe.ends[live]
        live, low, high = live[on], low[on], high[on]
    return longest, at_low, at_high


class Shard:
    """Suffix array of the documents of one batch, and the matches of the items in it."""

    def __init__(self, texts: list[bytes], probe: Probe):
        self.probe = probe
        get = probe.vocabulary.get
        words = [t.translate(ALNUM).split() for t in texts]
        self.n_words = np.array([len(w) for w in words], np.int64)
        self.begin = np.cumsum(self.n_words + 1) - self.n_words - 1
        self.numbers = np.zeros(int((self.n_words + 1).sum()) + 1, np.int64)
        for w, b in zip(words, self.begin.tolist()):
            self.numbers[b : b + len(w)] = [get(x, 0) for x in w]
        known = np.flatnonzero(self.numbers)
        if probe.prefix > 1:
            known = known[self.numbers[known + 1] != 0]
        if len(probe.pairs):
            codes = probe.codes(self.numbers, known)
            place = np.minimum(np.searchsorted(probe.pairs, codes), len(probe.pairs) - 1)
            known = known[probe.pairs[place] == codes]
        else:
            known = known[:0]
        self.order = suffix_array(self.numbers, known, probe.longest, len(probe.vocabulary))
        self.longest, self.low, self.high = search(self.numbers, self.order, probe)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of windows in the shard, and the suffix of an item each matches."""
        n = self.high - self.low
        suffix = np.repeat(np.arange(len(n)), n)
        return self.order[ranges(self.low, n)] if len(suffix) else np.empty(0, np.int64), suffix

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, place, "right") - 1


def _hits(batch: pa.RecordBatch, probe: Probe) -> dict:
    shard = Shard(texts_of(batch.column("text")), probe)
    place, suffix = shard.windows()
    change = np.zeros(len(shard.numbers) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + probe.need[suffix], -1)
    hit = np.cumsum(change) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    doc = shard.document(begin)
    spans: list[list] = [[] for _ in range(batch.num_rows)]
    for d, b, e in zip(doc.tolist(), (begin - shard.begin[doc]).tolist(), (end - begin).tolist()):
        spans[d].append({"start": b, "n": e})
    items: list[list[str]] = [[] for _ in range(batch.num_rows)]
    base = max(1, len(probe.names))
    for code in np.unique(shard.document(place) * base + probe.item[suffix]).tolist():
        items[code // base].append(probe.names[code % base])
    return {"key": batch.column("key"), "same": batch.column("same"), "n_words": shard.n_words, "spans": spans, "items": items}


@any_id("doc_id")
def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every row: the hit stretches of words and the items found."""
    rows = docs.select(id_key().alias("key"), F.xxhash64("text").alias("same"), F.col("text").cast("string").alias("text"))
    schema = "key long, same long, n_words long, spans array<struct<start: int, n: int>>, items array<string>"
    parts = []
    for items in blocks(benchmark, block_bytes):
        probe = docs.sparkSession.sparkContext.broadcast(Probe(items, window))
        parts.append(map_batches(rows, lambda b, probe=probe: _hits(b, probe.value), schema))
    if len(parts) == 1:
        return parts[0].select(id_of("key").alias("doc_id"), "n_words", "spans", "items")
    all_ = parts[0]
    for part in parts[1:]:
        all_ = all_.unionByName(part)
    # Blocks meet by document. Equal rows are counted once for each block.
    met = all_.groupBy("key", "same", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), (F.count("*") / len(parts)).cast("int").alias("times")
    )
    # Stretches that overlap become one, in the order of their starts.
    last = lambda acc: F.element_at(acc, -1)
    grown = lambda acc, s: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last(acc)["start"].alias("start"), (F.greatest(last(acc)["start"] + last(acc)["n"], s["start"] + s["n"]) - last(acc)["start"]).alias("n"))))
    none = F.array().cast("array<struct<start: int, n: int>>")
    merged = F.aggregate(F.array_sort("spans"), none, lambda acc, s: F.when((F.size(acc) > 0) & (F.coalesce(F.get(acc, F.size(acc) - 1)["start"] + F.get(acc, F.size(acc) - 1)["n"], F.lit(-1)) >= s["start"]), grown(acc, s)).otherwise(F.concat(acc, F.array(s))))
    met = met.withColumn("spans", merged).withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return met.select(id_of("key").alias("doc_id"), "n_words", "spans", "items")


def _longest(batch: pa.RecordBatch, probe: Probe) -> dict:
    shard = Shard(texts_of(batch.column("text")), probe)
    place, suffix = shard.windows()
    # A match is told at its leftmost word only.
    first = shard.numbers[place - 1] != probe.numbers[probe.starts[suffix] - 1]
    first |= (place == 0) | (shard.numbers[place - 1] == 0)
    place, suffix = place[first], suffix[first]
    n, live = probe.need[suffix].copy(), np.arange(len(place))
    while len(live):
        here, there = place[live] + n[live], probe.starts[suffix[live]] + n[live]
        same = (shard.numbers[here] == probe.numbers[there]) & (shard.numbers[here] != 0)
        live = live[same]
        n[live] += 1
    doc = shard.document(place)
    keys = np.asarray(batch.column("key"))
    return {"key": keys[doc], "item_id": [probe.names[k] for k in probe.item[suffix].tolist()], "doc_start": place - shard.begin[doc], "n": n, "item_start": probe.starts[suffix] - np.array([probe.starts[np.searchsorted(probe.ends, e, "left")] for e in probe.ends[suffix].tolist()], np.int64)}


@any_id("doc_id")
def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, doc_start, item_start, n``: every longest verbatim match of a window or more, with its places in words."""
    rows = docs.select(id_key().alias("key"), F.col("text").cast("string").alias("text"))
    found = None
    for items in blocks(benchmark, block_bytes):
        probe = docs.sparkSession.sparkContext.broadcast(Probe(items, window))
        part = map_batches(rows, lambda b, probe=probe: _longest(b, probe.value), "key long, item_id string, doc_start int, n int, item_start int")
        found = part if found is None else found.unionByName(part)
    return found.select(id_of("key").alias("doc_id"), "item_id", "doc_start", "item_start", "n")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that hold no window of any item; all columns, no shuffle."""
    for items in blocks(benchmark, block_bytes):
        probe = docs.sparkSession.sparkContext.broadcast(Probe(items, window))

        def clean(batches: Iterator[pa.RecordBatch], probe=probe) -> Iterator[pa.RecordBatch]:
            for batch in small(batches):
                shard = Shard(texts_of(batch.column(batch.schema.get_field_index("text"))), probe.value)
                place, _ = shard.windows()
                keep = np.ones(batch.num_rows, bool)
                keep[shard.document(place)] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its hit words and the benchmark items found in it."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["n"]), F.lit(0))
    ids = F.concat_ws(",", F.array_sort("items"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


_WORDS_SQL = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP7_SQL = f"""
WITH own AS (SELECT doc_id, {_WORDS_SQL} AS words FROM documents),
items AS (SELECT item_id::VARCHAR AS item, words, least(len(words), 10) AS n FROM (SELECT item_id, {_WORDS_SQL} AS words FROM benchmark) WHERE len(words) > 0),
probes AS (SELECT DISTINCT item, n, array_to_string(words[s:s + n - 1], ' ') AS sequence FROM (SELECT item, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM items)),
windows AS (SELECT doc_id, n, s, array_to_string(words[s:s + n - 1], ' ') AS sequence
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM own, (SELECT DISTINCT n FROM items) WHERE len(words) >= n)),
found AS (SELECT doc_id, item, s, n FROM windows JOIN probes USING (n, sequence)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM own LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
