"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is cut into words with their leading blanks, as no piece of a model may cross that cut
(checked when the model is loaded). A word's segmentation starts from its characters. An agenda
holds the merges of neighbours that the model knows; the best one is taken, the leftmost of
equals, again and again. Merge-dropout skips a candidate for good if a hash, keyed by seed,
doc_id, place of the word, word and the three bounds of the candidate, falls below ``dropout``.
So each occurrence of a word is drawn on its own, and can be made again anywhere. Dropout 0 is
the model's own encoding. Its merges are kept for words met again. A skipped candidate that was
never taken changes nothing, so up to the first skipped one of these merges an occurrence goes
the same way: they are replayed at once, and the agenda starts there.

Short words are segmented many at once in numpy, longer ones with a heap; both follow the same
agenda. Characters that the model lacks, and a literal lower one eighth block, which stands for
a blank inside pieces, become byte pieces, so decoding gives back the text byte for byte.

The model's file is a parameter and read on the driver; its tables, whose size is the
vocabulary's, are broadcast. A null text has null ids and no pieces, an empty one no ids. A
null doc_id counts as one id. Ids have any type; those that are no whole numbers are drawn by hash. Repeated rows get equal ids. Other columns do not matter.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_key, map_stream, mix, ranges, table, whole_ids

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 7
#: Characters of a word up to which it is segmented with others in numpy.
SHORT = 48

_MASK = (1 << 64) - 1
_BLANK = "▁"
_WORD = re.compile(rb" *[^ \n]+| +|\n")
_A, _B, _C = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


class Model:
    """A vocabulary as tables: characters, merges, and the bytes of each piece."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        n = own.get_piece_size()
        names = [own.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (own.is_byte(i) or own.is_control(i) or own.is_unknown(i) or own.is_unused(i))]
        for i in plain:
            if "\n" in names[i] and len(names[i]) > 1 or _BLANK in names[i][1:] and names[i].strip(_BLANK):
                raise ValueError(f"piece {names[i]!r} crosses a word's start")
        ids = {names[i]: i for i in plain}
        self.size = n
        self.byte = np.array([i for _, i in sorted((int(names[i][3:5], 16), i) for i in range(n) if own.is_byte(i))])
        if len(self.byte) != 256:
            raise ValueError("the model has no byte pieces")
        self.char = np.full(0x110000, -1)
        self.chars = {" " if name == _BLANK else name: i for name, i in ids.items() if len(name) == 1}
        for c, i in self.chars.items():
            self.char[ord(c)] = i
        self.text = [b""] * n
        for i in plain:
            self.text[i] = names[i].replace(_BLANK, " ").encode()
        for b, i in enumerate(self.byte.tolist()):
            self.text[i] = bytes([b])
        merges = sorted((ids[x[:k]] * n + ids[x[k:]], i) for x, i in ids.items() for k in range(1, len(x)) if x[:k] in ids and x[k:] in ids)
        # A table of pairs by hash, at most an eighth full; a taken slot's pair goes to the next one.
        self.shift = 64 - (8 * len(merges) + 1).bit_length()
        self.pairs, self.merged = np.full(1 << 64 - self.shift, -1, np.int64), np.full(1 << 64 - self.shift, -1, np.int32)
        for (pair, i), at in zip(merges, self.slot(np.array([a for a, _ in merges], np.int64)).tolist()):
            while self.pairs[at] >= 0:
                at = (at + 1) % len(self.pairs)
            self.pairs[at], self.merged[at] = pair, i
        # Rank of pieces by score: the lower, the sooner merged; equal scores rank equal.
        scores = np.array([own.get_score(i) for i in range(n)])
        _, order = np.unique(-scores, return_inverse=True)
        self.rank = order.astype(np.int32)

    def slot(self, pair: np.ndarray) -> np.ndarray:
        """Where the search for a pair begins."""
        return ((pair.view(np.uint64) * np.uint64(_A)) >> np.uint64(self.shift)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of two neighbours, or -1; numbers from ``size`` on are characters without a piece."""
        inside = (left >= 0) & (left < self.size) & (right >= 0) & (right < self.size)
        pair = np.where(inside, left.astype(np.int64) * self.size + right, -2)
        at = self.slot(pair)
        found = self.pairs[at]
        out = np.where(found == pair, self.merged[at], -1)
        open_ = np.flatnonzero((found != pair) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.pairs)
            found = self.pairs[at[open_]]
            hit = open_[found == pair[open_]]
            out[hit] = self.merged[at[hit]]
            open_ = open_[(found != pair[open_]) & (found >= 0)]
        return out


def _skips(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether merge-dropout skips the candidates."""
    if dropout <= 0:
        return np.zeros(len(key), bool)
    u = np.uint64
    place = start.astype(u) * u(_A) + middle.astype(u) * u(_B) + end.astype(u) * u(_C)
    return mix(key ^ mix(place)) < u(min(int(dropout * 2**64), _MASK))


def segment_heap(model: Model, symbols: list[int], key: int, dropout: float) -> list[int]:
    """Pieces of one word by a heap; for words of any length."""
    n = len(symbols)
    piece, after, before, end = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple] = []

    def offer(lefts: list[int]) -> None:
        lefts = [i for i in lefts if i >= 0 and after[i] < n]
        if not lefts:
            return
        at = np.array(lefts)
        rights = np.array([after[i] for i in lefts])
        new = model.merge(np.array([piece[i] for i in lefts]), np.array([piece[i] for i in rights.tolist()]))
        ends = np.array([end[i] for i in rights.tolist()])
        good = (new >= 0) & ~_skips(np.full(len(at), key, np.uint64), at, rights, ends, dropout)
        for i, r, e, x in zip(at[good].tolist(), rights[good].tolist(), ends[good].tolist(), new[good].tolist()):
            heapq.heappush(agenda, (int(model.rank[x]), i, r, e, x))

    offer(list(range(n - 1)))
    gone = bytearray(n)
    while agenda:
        _, i, r, e, x = heapq.heappop(agenda)
        if gone[i] or gone[r] or after[i] != r or end[r] != e:
            continue
        piece[i], end[i], after[i] = x, e, after[r]
        gone[r] = 1
        if after[i] < n:
            before[after[i]] = i
        offer([before[i], i])
    return [piece[i] for i in range(n) if not gone[i]]


def segment_many(model: Model, symbols: np.ndarray, length: np.ndarray, key: np.ndarray, dropout: float, bound: np.ndarray | None = None, taken: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of many words, one row each, filled with -1; and their numbers.

    ``bound`` tells where each symbol starts and the last one ends, if some are merged already.
    ``taken`` takes row, start, middle, end and piece of the merges, in their order.
    """
    out, out_length = symbols.copy(), length.copy()
    n, width = symbols.shape
    if bound is None:
        bound = np.broadcast_to(np.arange(width + 1), (n, width + 1))
    rows, sym, own, keys, size = np.arange(n), symbols, bound, key, length
    top = np.int32(2**31 - 1)
    rank, merged = np.full((n, max(0, width - 1)), top, np.int32), np.full((n, max(0, width - 1)), -1, np.int32)

    def offer(i: np.ndarray, j: np.ndarray) -> None:
        """Candidates j of rows i, whose places hold none."""
        new = model.merge(sym[i, j], sym[i, j + 1])
        known = np.flatnonzero(new >= 0)
        i, j, new = i[known], j[known], new[known]
        if dropout > 0:
            stay = np.flatnonzero(~_skips(keys[i], own[i, j], own[i, j + 1], own[i, j + 2], dropout))
            i, j, new = i[stay], j[stay], new[stay]
        rank[i, j], merged[i, j] = model.rank[new], new

    offer(*np.nonzero(np.arange(width - 1)[None, :] < (length - 1)[:, None]))
    while width > 1 and len(rows):
        best = rank.argmin(axis=1)
        on = rank[np.arange(len(rows)), best] < top
        if not on.all():
            done = ~on
            out[rows[done], :width], out_length[rows[done]] = sym[done], size[done]
            rows, sym, own, keys, size, rank, merged, best = rows[on], sym[on], own[on], keys[on], size[on], rank[on], merged[on], best[on]
        at = np.arange(len(rows))
        new = merged[at, best]
        if taken is not None:
            taken.append(np.stack([rows, own[at, best], own[at, best + 1], own[at, best + 2], new]))
        # Take the right neighbour out; every row loses one place.
        stay = np.ones((len(rows), width + 1), bool)
        stay[at, best + 1] = False
        own, sym = own[stay].reshape(len(at), width), sym[stay[:, :-1]].reshape(len(at), width - 1)
        stay = stay[:, 1:-1]
        rank, merged = rank[stay].reshape(len(at), width - 2), merged[stay].reshape(len(at), width - 2)
        width, size = width - 1, size - 1
        sym[at, best] = new
        before, after = np.flatnonzero(best > 0), np.flatnonzero(best < size - 1)
        i, j = np.concatenate([before, after]), np.concatenate([best[before] - 1, best[after]])
        rank[i, j] = top
        offer(i, j)
    out[rows, :width], out_length[rows] = sym, size
    return out, out_length


class Encoder:
    """Encodes texts; the undropped segmentations of words met before are kept, up to a bound."""

    def __init__(self, model: Model, dropout: float = DROPOUT, seed: int = SEED, most: int = 600_000):
        self.model, self.dropout, self.seed, self.most = model, dropout, seed, most
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        #: Of each word: a hash, its symbols, its pieces, and the merges of its undropped segmentation in order.
        self.hash = np.empty(0, np.uint64)
        self.symbols, self.begin, self.length = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.store, self.start, self.size = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.met, self.met_start, self.met_size = np.empty((4, 0), np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts on end, and the number of ids of each."""
        if len(self.known) > self.most:
            self.clear()
        words: list[bytes] = []
        n = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                found = _WORD.findall(b" " + text)
                n[k] = len(found)
                words += found
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self._add(new)
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        start, size, store = self.start[at], self.size[at], self.store
        if self.dropout > 0:
            row = np.repeat(mix(np.asarray(keys).astype(np.int64).view(np.uint64) ^ np.uint64(self.seed & _MASK)), n)
            key = mix(self.hash[at] + mix(row + ranges(np.zeros(len(n), np.int64), n).astype(np.uint64)))
            same = self._same(at, key)
            dropped = np.flatnonzero(same >= 0)
            own, start[dropped], size[dropped] = self._segment(at[dropped], key[dropped], self.dropout, same[dropped])
            start[dropped] += len(store)
            store = np.concatenate([store, own])
        ids = store[ranges(start, size)]
        ends = np.concatenate([[0], np.cumsum(size)])
        upto = np.concatenate([[0], np.cumsum(n)])
        return ids, ends[upto[1:]] - ends[upto[:-1]]

    def _same(self, at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """How many merges of the undropped segmentation come before the first skipped one; -1 if none is. Long words start anew."""
        out = np.where(self.length[at] > SHORT, 0, -1)
        for a in range(0, len(at), 1 << 15):
            part = at[a : a + (1 << 15)]
            times = self.met_size[part]
            of = np.repeat(np.arange(len(part)), times)
            skipped = np.flatnonzero(_skips(key[a + of], *self.met[:3, ranges(self.met_start[part], times)], self.dropout))
            of, first = np.unique(of[skipped], return_index=True)
            out[a + of] = skipped[first] - (np.cumsum(times) - times)[of]
        return out

    def _add(self, words: list[bytes]) -> None:
        """Take in new words with their undropped segmentation."""
        model, first = self.model, len(self.length)
        texts = [w.decode("utf-8", "surrogateescape") for w in words]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        # A character without a piece stands as its code point from ``size`` on.
        symbols = np.where(model.char[points] >= 0, model.char[points], points + model.size)
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, self.seed & _MASK) for w in words), np.uint64, len(words))
        self.hash = np.concatenate([self.hash, hashes])
        self.begin = np.concatenate([self.begin, len(self.symbols) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.symbols = np.concatenate([self.symbols, symbols.astype(np.int32)])
        # Words that always count as varied need no undropped segmentation.
        need = np.flatnonzero((length <= SHORT) | (self.dropout <= 0))
        start, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        met: list | None = [] if self.dropout > 0 else None
        own, start[need], size[need] = self._segment(first + need, hashes[need], 0, taken=met)
        self.start, self.size = np.concatenate([self.start, len(self.store) + start]), np.concatenate([self.size, size])
        self.store = np.concatenate([self.store, own])
        found = np.concatenate([np.empty((5, 0), np.int64), *(met or [])], axis=1)
        found = found[:, np.argsort(found[0], kind="stable")]
        times = np.zeros(len(words), np.int64)
        times[need] = np.bincount(found[0], minlength=len(need))
        self.met_start = np.concatenate([self.met_start, self.met.shape[1] + np.cumsum(times) - times])
        self.met_size = np.concatenate([self.met_size, times])
        self.met = np.concatenate([self.met, found[1:].astype(np.int32)], axis=1)

    def _replay(self, word: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words on end after their first merges, and where in its word each starts."""
        begin, length = self.begin[word], self.length[word]
        symbols, place = self.symbols[ranges(begin, length)], ranges(np.zeros(len(word), np.int64), length)
        if not same.any():
            return symbols, place
        start, middle, _, piece = self.met[:, ranges(self.met_start[word], same)]
        base = np.repeat(np.cumsum(length) - length, same)
        symbols[base + start] = piece  # of repeated places the last one holds, which is the last merge
        left = np.ones(len(symbols), bool)
        left[base + middle] = False
        return symbols[left], place[left]

    def _segment(self, word: np.ndarray, key: np.ndarray, dropout: float, same: np.ndarray | None = None, taken: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words by number, on end in any order; where those of each start, and how many they are.

        ``same`` counts the merges that are known to hold.
        """
        model, begin, length = self.model, self.begin[word], self.length[word]
        same = np.zeros(len(word), np.int64) if same is None else same
        left = length - same
        start, size, low, upto, store = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64), 0, 0, [np.empty(0, np.int32)]

        def keep(part: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
            nonlocal upto
            ids, n = self._bytes(ids, n)
            start[part], size[part] = upto + np.cumsum(n) - n, n
            upto += len(ids)
            store.append(ids.astype(np.int32))

        for width in (2, 3, 4, 6, 8, 10, 12, 16, 24, SHORT):
            pick = np.flatnonzero((left > low) & (left <= width) & (length <= SHORT))
            low = width
            for part in np.array_split(pick, -(-len(pick) // 8_000)) if len(pick) else ():
                inside = np.arange(width + 1)[None, :] < left[part][:, None]
                rows, bound = np.full((len(part), width), -1, np.int32), np.zeros((len(part), width + 1), np.int64)
                rows[inside[:, :-1]], bound[inside] = self._replay(word[part], same[part])
                bound[np.arange(len(part)), left[part]] = length[part]
                own: list | None = [] if taken is not None else None
                ids, n = segment_many(model, rows, left[part], key[part], dropout, bound, own)
                keep(part, ids[np.arange(width)[None, :] < n[:, None]], n)
                if taken is not None:
                    taken.extend(np.concatenate([part[x[:1]], x[1:]]) for x in own)
        for k in np.flatnonzero(length > SHORT).tolist():
            own = segment_heap(model, self.symbols[begin[k] : begin[k] + length[k]].tolist(), int(key[k]), dropout)
            keep(np.array([k]), np.array(own), np.array([len(own)]))
        return np.concatenate(store), start, size

    def _bytes(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as byte pieces."""
        model = self.model
        if len(lack := np.flatnonzero(ids >= model.size)):
            raw = [chr(x - model.size).encode("utf-8", "surrogateescape") for x in ids[lack].tolist()]
            times = np.ones(len(ids), np.int64)
            times[lack] = [len(x) for x in raw]
            n = np.add.reduceat(times, np.cumsum(n) - n)
            wide = np.repeat(ids, times)
            wide[wide >= model.size] = model.byte[list(b"".join(raw))]
            ids = wide
        return ids, n


def decode(model: Model, ids: np.ndarray) -> bytes:
    """The text of ids; the blank that encoding put before it is taken off."""
    return b"".join(map(model.text.__getitem__, ids.tolist()))[1:]


def _id(docs: DataFrame) -> tuple[Column, str]:
    """The id and its type; whole numbers are longs."""
    kind = "long" if whole_ids(docs) else docs.select("doc_id").schema[0].dataType.simpleString()
    return F.col("doc_id").cast(kind), kind


def encode(docs: DataFrame, path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``doc_id, n_pieces, ids, lossless`` for every row; each row is decoded again to tell lossless."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = shared.value
        encoder = Encoder(model, dropout, seed)
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            for at in range(0, batch.num_rows, 1000):  # a bounded part at once
                raw = column.slice(at, 1000).to_pylist()
                keys = batch.column("key").slice(at, 1000)
                ids, n = encoder.encode([x or b"" for x in raw], np.asarray(keys))
                ends = np.concatenate([[0], np.cumsum(n)])
                lossless = [x is None or decode(model, ids[a:b]) == x for x, a, b in zip(raw, ends[:-1].tolist(), ends[1:].tolist())]
                offsets = pa.array(ends, pa.int32(), mask=np.array([x is None for x in raw] + [False]))
                yield {"doc_id": batch.column("doc_id").slice(at, 1000), "n_pieces": n, "ids": pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), "lossless": lossless}

    own, kind = _id(docs)
    key = id_key() if kind == "long" else F.xxhash64("doc_id")
    rows = docs.select(own.alias("doc_id"), key.alias("key"), F.col("text").cast("string").alias("text"))
    return map_stream(rows, run, f"doc_id {kind}, n_pieces long, ids array<int>, lossless boolean")


def decode_ids(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = [decode(shared.value, np.asarray(x.values)).decode("utf-8", "surrogateescape") if x.is_valid else None for x in batch.column("ids")]
            yield {"doc_id": batch.column("doc_id"), "text": texts}

    own, kind = _id(encoded)
    rows = encoded.select(own.alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return map_stream(rows, run, f"doc_id {kind}, text string")


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document under merge-dropout, and whether they decode to its text."""
    return encode(table(spark, sf_dir, "documents"))
