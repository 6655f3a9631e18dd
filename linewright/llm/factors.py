"""A quality classifier: a factorisation machine over words, structure and metadata.

A text has sparse features x. The score is a logistic function of

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

with vectors v of ``RANK`` numbers, so every two features interact through a low-rank product. The
double sum is never formed: it equals half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), which
is linear in the features of a text.

Features are hashed words (A-Z lower-cased, runs of digits, letters and non-ASCII characters),
weighted by the square root of their share, so texts of all lengths weigh alike; structure, as bins
of the text's statistics (length, words a line, length of words, shares of capitals, digits, each
punctuation mark, repeated words and repeated lines); and metadata, the declared number of
characters against the real one. Label, language, source and id of a document are never features.

Training reads at most ``SAMPLE_ROWS`` labelled rows, those with the least keyed hash, whole texts
of them, so that its input on the driver is bounded at any number of rows. The ``FEATURES`` features
that tell the labels apart best take part. Scoring covers every whole text.

A null text is an empty one; it has structure features of its own, so it gets a score too. A score is
the same for equal text and declared length. Rows without a label of 0 or 1 are not trained on; ids
labelled both 0 and 1 neither, and a repeated row counts once. Without labels of both kinds every
score is the share of label 1, or 0 without labels. Very long texts are read whole. Repeated rows come
out as often as they go in; other columns do not matter. Empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, map_stream, settle, table, texts_of

SAMPLE_ROWS = 20_000
FEATURES = 4096
BITS = 16
RANK = 8
EPOCHS = 12
SEED = 23

#: Weight of a structure feature; there are some tens in a text.
_SIDE = 0.3
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KEPT_WORDS = 1 << 19


def _share(name: str, part: float, whole: float) -> str:
    """A bin of a share: none, then by powers of two."""
    return f"{name}:0" if part <= 0 or whole <= 0 else f"{name}:{int(np.log2(part / whole) * 2) - 1}"


def _size(name: str, n: float) -> str:
    return f"{name}:{int(np.log2(n + 1) * 2)}"


def structure(text: bytes, words: list[bytes], declared: int | None) -> list[str]:
    """The structure and metadata features of a text."""
    lines = [x for x in (y.strip() for y in text.split(b"\n")) if x]
    n, size = len(words), len(text)
    seen = Counter(words)
    spread = np.bincount(np.frombuffer(text, np.uint8), minlength=256).tolist()  # of bytes
    chars = size - sum(spread[128:192])
    found = [
        _size("words", n),
        _size("letters", sum(map(len, words)) / n if n else 0),
        _size("per-line", n / len(lines) if lines else 0),
        _share("repeated", n - len(seen), n),
        _share("commonest", max(seen.values(), default=0), n),
        _share("lines", len(lines) - len(set(lines)), len(lines)),
        _share("capitals", sum(spread[65:91]), size),
        _share("digits", sum(spread[48:58]), size),
        _share("stops", spread[46] + spread[33] + spread[63], n),
        "declared:none" if declared is None else _size("declared", abs(declared - chars)),
    ]
    found += [_share(f"mark{m}", spread[m], n) for m in _MARKS if spread[m]]
    return found


class Reader:
    """Texts to sparse features; the numbers of words are kept, up to a bound."""

    def __init__(self, bits: int = BITS):
        self.bits, self.known = bits, {}

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > _KEPT_WORDS:
            known.clear()
        for w in [w for w in set(words) if w not in known]:
            known[w] = xxhash.xxh64_intdigest(w, SEED) >> (64 - self.bits)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def __call__(self, texts: list[bytes], declared: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, feature and value of each feature that is there, by text and feature."""
        shift = 64 - self.bits
        rows, numbers, values = [], [], []
        for k, (text, n) in enumerate(zip(texts, declared)):
            words = text.translate(ALNUM).split()
            number, times = np.unique(self._numbers(words), return_counts=True)
            side = np.array([xxhash.xxh64_intdigest(s, SEED + 1) >> shift for s in structure(text, words, n)], np.int64)
            numbers += [number, side]
            values += [np.sqrt(times / max(1, len(words))), np.full(len(side), _SIDE)]
            rows.append(np.full(len(number) + len(side), k))
        empty = [np.empty(0, np.int64)]
        return np.concatenate(rows or empty), np.concatenate(numbers or empty), np.concatenate(values or [np.empty(0)])


@dataclass
class Machine:
    """Weights of all features; those that do not take part have zeros."""

    bias: float
    weight: np.ndarray
    vectors: np.ndarray
    bits: int = BITS

    def __post_init__(self):
        self.squares = (self.vectors**2).sum(axis=1)
        self.used = (self.weight != 0) | (self.squares != 0)

    def logits(self, row: np.ndarray, number: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """By the sum-of-squares identity, in time linear in the features."""
        some = self.used[number]
        row, number, value = row[some], number[some], value[some]
        sums = np.stack([np.bincount(row, value * self.vectors[number, f], n) for f in range(self.vectors.shape[1])])
        linear = np.bincount(row, value * self.weight[number], n)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=0) - np.bincount(row, value**2 * self.squares[number], n))

    def scores(self, texts: list[bytes], declared: list[int | None], reader: Reader) -> np.ndarray:
        logits = self.logits(*reader(texts, declared), len(texts))
        return np.round(1 / (1 + np.exp(-np.clip(logits, -50, 50))), 9)


def constant(share: float, bits: int = BITS) -> Machine:
    """The same score for every text."""
    bias = float(np.log(share / (1 - share))) if 0 < share < 1 else 50.0 if share >= 1 else -50.0
    return Machine(bias, np.zeros(1 << bits), np.zeros((1 << bits, RANK)), bits)


def fit(row: np.ndarray, number: np.ndarray, value: np.ndarray, label: np.ndarray, bits: int = BITS, rank: int = RANK, epochs: int = EPOCHS) -> Machine:
    """Adam steps on the logistic loss, in batches of texts; features that aren't given keep zeros.

    row is not falling; the same numbers give the same machine.
    """
    use, column = np.unique(number, return_inverse=True)
    n, size, rng = len(label), len(use), np.random.default_rng(SEED)
    batch = min(256, max(16, n // 32))  # enough steps also for few texts
    share = float(label.mean())
    theta = np.zeros((size + 1, 1 + rank))  # weight and vector of each feature; the last row holds the bias
    theta[:size, 1:] = rng.normal(0, 0.05, (size, rank))
    theta[size, 0] = np.log(share / (1 - share))
    first = np.searchsorted(row, np.arange(n + 1))
    m, v, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        rate = 0.05 * 0.5 ** (epoch / 4)
        for at in range(0, n, batch):
            texts = order[at : at + batch]
            sizes = first[texts + 1] - first[texts]
            places = np.repeat(first[texts] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            r, c, x = np.repeat(np.arange(len(texts)), sizes), column[places], value[places]
            scaled = theta[c, 1:] * x[:, None]
            sums = np.stack([np.bincount(r, scaled[:, f], len(texts)) for f in range(rank)], axis=1)
            pairs = 0.5 * ((sums**2).sum(axis=1) - np.bincount(r, (scaled**2).sum(axis=1), len(texts)))
            logits = theta[size, 0] + np.bincount(r, theta[c, 0] * x, len(texts)) + pairs
            pull = (1 / (1 + np.exp(-np.clip(logits, -50, 50))) - label[texts]) / len(texts)
            g = pull[r] * x
            grad = np.zeros_like(theta)
            grad[:size, 0] = np.bincount(c, g, size)
            for f in range(rank):
                grad[:size, 1 + f] = np.bincount(c, g * (sums[r, f] - scaled[:, f]), size)
            grad[:size] += 1e-4 * theta[:size] / max(1, n // batch)
            grad[size, 0] = pull.sum()
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    weight, vectors = np.zeros(1 << bits), np.zeros((1 << bits, rank))
    weight[use], vectors[use] = theta[:size, 0], theta[:size, 1:]
    return Machine(float(theta[size, 0]), weight, vectors, bits)


def telling(good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int, most: int) -> np.ndarray:
    """Places of the features whose shares in good and bad texts differ most, by a z-score; at least 3 texts hold each."""
    share = (good + bad) / (n_good + n_bad)
    spread = np.sqrt(np.maximum(share * (1 - share) * (1 / n_good + 1 / n_bad), 1e-12))
    z = np.abs(good / n_good - bad / n_bad) / spread
    some = np.flatnonzero(good + bad >= 3)
    return np.sort(some[np.argsort(-z[some], kind="stable")[:most]])


def _rows(docs: DataFrame) -> DataFrame:
    declared = F.col("n_chars").try_cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), declared.alias("declared"))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, features: int = FEATURES, bits: int = BITS) -> Machine:
    """Fit on at most ``rows`` rows of docs(doc_id, text[, n_chars]) with a label in labels(doc_id, quality)."""
    context = docs.sparkSession.sparkContext
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"), F.max("quality").alias("most"))
    # The least keyed hashes: the same rows in any order of the input. At most ``rows``, so they are broadcast.
    picked = known.where("label = most").select("doc_id", "label").orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(rows)
    chosen = settle(_rows(docs).join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id", "text", "declared"]).select("text", "declared", "label"), "rated")
    kinds = dict(chosen.groupBy("label").count().collect())
    if len(kinds) < 2:
        return constant(float(next(iter(kinds), 0)), bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        reader, held = Reader(bits), np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            row, number, _ = reader(texts_of(batch.column("text")), batch.column("declared").to_pylist())
            np.add.at(held, (np.asarray(batch.column("label"))[row], number), 1)
        some = np.flatnonzero(held.any(axis=0))
        yield {"feature": some, "bad": held[0, some], "good": held[1, some]}

    # At most 2^bits rows whatever the corpus.
    held = map_stream(chosen, count, "feature int, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).orderBy("feature").toPandas()
    best = telling(held["good"].to_numpy(), held["bad"].to_numpy(), kinds[1], kinds[0], features)
    use = np.zeros(1 << bits, bool)
    use[held["feature"].to_numpy()[best]] = True
    shared = context.broadcast(use)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        reader = Reader(bits)
        for batch in batches:
            row, number, value = reader(texts_of(batch.column("text")), batch.column("declared").to_pylist())
            some = shared.value[number]
            row, number, value = row[some], number[some].astype("<i4"), value[some].astype("<f4")
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            cut = lambda x: [x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield {"numbers": cut(number), "values": cut(value), "label": batch.column("label")}

    # At most rows * features numbers.
    sample = map_stream(chosen, gather, "numbers binary, values binary, label int").toPandas()
    sample = sample.sort_values(["numbers", "values", "label"], kind="stable")  # the same sums in any order of the input
    number = np.frombuffer(b"".join(sample["numbers"]), "<i4").astype(np.int64)
    value = np.frombuffer(b"".join(sample["values"]), "<f4").astype(np.float64)
    row = np.repeat(np.arange(len(sample)), [len(x) // 4 for x in sample["numbers"]])
    return fit(row, number, value, sample["label"].to_numpy(np.float64), bits)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, score`` for every row of docs(doc_id, text[, n_chars]); the id keeps its type."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        reader = Reader(shared.value.bits)
        for batch in batches:
            found = shared.value.scores(texts_of(batch.column("text")), batch.column("declared").to_pylist(), reader)
            yield {"doc_id": batch.column("doc_id"), "score": found}

    return map_stream(_rows(docs), run, f"doc_id {kind}, score double")


def held_out(name: str = "doc_id") -> Column:
    """Rows never trained on: crc32 of the id as text is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs, train(docs, labels.where(~held_out())))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
