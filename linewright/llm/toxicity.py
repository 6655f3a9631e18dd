"""Toxicity by multiple-instance learning.

A document is a bag of sentences, and its score is a leaky noisy-or: toxic unless the leak stays
shut and every sentence is clean. A sentence's score is what its features add to a plain
sentence's rate, a logistic function of their weights; a plain sentence scores 0, so length alone
never makes a text toxic. The leak is one rate per document, fitted apart, for what no sentence
explains. Only documents are labelled; training fits the sentence scores through the noisy-or, so
sentences that offend are found without a label of their own. Sentences scored below ``FLOOR``
count as clean, so that weak hints don't add up over a very long text.

Features are hashed words (A-Z lower-cased, runs of digits, letters and non-ASCII characters)
and their first bytes, since many languages inflect at the end; each counts once in a sentence.
Features that do not tell the labels apart are left out by a z-score. Sentences end at
``. ! ?`` or a line break. Label, language, source and id of a document are never features.

Training reads at most ``SAMPLE_ROWS`` labelled rows, those with the least keyed hash, so that
its input on the driver is bounded at any number of rows. It covers every sentence of these:
sentences without a telling feature score 0 and need not be sent. Scoring covers every sentence
of every whole text.

A null text is an empty one; without a sentence its score is the leak. A score is the same for equal
texts. Rows without a label of 0 or 1 are not trained on; ids labelled both 0 and 1 neither,
and a repeated row counts once. Without labels of both kinds every score is 0. Repeated rows
come out as often as they go in; other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, any_id, id_key, id_of, map_batches, map_stream, settle, small, table, texts_of, whole_ids

SAMPLE_ROWS = 20_000
BITS = 18
ROUNDS = 60
SEED = 11
FLOOR = 0.2

_STOP = re.compile(rb"[.!?\n]+")


#: Features of a word: the word and its first bytes, by number of bytes.
PREFIXES = (3, 4, 5, 6, 8)
WIDTH = 1 + len(PREFIXES)


class Hasher:
    """Feature numbers of words; most words are met again, so they are kept, up to a bound.

    ``rows`` has a row for each word: its features, or -1 where it is no longer than a prefix.
    """

    def __init__(self, weight: np.ndarray | None = None, bits: int = BITS, most: int = 1 << 19):
        self.weight, self.bits, self.most = weight, bits, most
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.rows = np.empty((1024, WIDTH), np.int32)
        #: Whether any feature of the word has a weight.
        self.weighs = np.zeros(1024, bool)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """The row of each word; rows hold until the next call."""
        known = self.known
        if len(known) > self.most:
            self.clear()
            known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            at, shift = len(known), 64 - self.bits
            hash_ = lambda x: xxhash.xxh64_intdigest(x, SEED) >> shift
            found = np.array([[hash_(w), *(hash_(w[:n] + b"*") if len(w) > n else -1 for n in PREFIXES)] for w in new], np.int32)
            known.update(zip(new, range(at, at + len(new))))
            if at + len(new) > len(self.rows):
                more = max(len(new), len(self.rows))
                self.rows = np.concatenate([self.rows, np.empty((more, WIDTH), np.int32)])
                self.weighs = np.concatenate([self.weighs, np.zeros(more, bool)])
            self.rows[at : at + len(new)] = found
            if self.weight is not None:
                self.weighs[at : at + len(new)] = ((self.weight[found] != 0) & (found >= 0)).any(axis=1)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def split(texts: list[bytes], hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row of each word, its sentence, and the text of each sentence; sentences without a word have no place."""
    words: list[bytes] = []
    sizes: list[int] = []
    of_text: list[int] = []
    for k, text in enumerate(texts):
        for sentence in _STOP.split(text):
            found = sentence.translate(ALNUM).split()
            if found:
                words += found
                sizes.append(len(found))
                of_text.append(k)
    return hasher(words), np.repeat(np.arange(len(sizes)), sizes), np.array(of_text, np.int64)


def expand(rows: np.ndarray, sentence: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """The features of words, each once in a sentence, and their sentences."""
    numbers = hasher.rows[rows]
    code = ((sentence[:, None] << hasher.bits) | numbers)[numbers >= 0]
    code = np.unique(code)
    return code & ((1 << hasher.bits) - 1), code >> hasher.bits


def _log_clean(logit):
    """Logarithm of 1 less the logistic function."""
    return -np.logaddexp(0, np.clip(logit, -50, 50))


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    bits: int = BITS
    leak: float = 0.0

    def hasher(self) -> Hasher:
        return Hasher(self.weight, self.bits)

    def sentences(self, texts: list[bytes], hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
        """Score of each sentence, and the text it is of."""
        rows, sentence, of_text = split(texts, hasher)
        some = hasher.weighs[rows]
        numbers, sentence = expand(rows[some], sentence[some], hasher)
        total = np.bincount(sentence, self.weight[numbers], len(of_text))
        score = -np.expm1(np.minimum(_log_clean(total + self.bias) - _log_clean(self.bias), 0))
        return np.where(score < FLOOR, 0, score), of_text

    def documents(self, texts: list[bytes], hasher: Hasher) -> np.ndarray:
        score, of_text = self.sentences(texts, hasher)
        clean = np.bincount(of_text, np.log1p(-np.minimum(score, 1 - 1e-12)), len(texts))
        return np.round(-np.expm1(clean + np.log1p(-self.leak)), 9)


def telling(toxic: np.ndarray, all_: np.ndarray, share: float) -> np.ndarray:
    """Features that stand in toxic documents more often than chance, by a z-score.

    toxic and all_: documents that hold each feature; share: of toxic documents.
    """
    z = (toxic - share * all_) / np.sqrt(np.maximum(all_ * share * (1 - share), 1e-9))
    return np.flatnonzero((z >= 4) & (toxic >= 4))


def fit(numbers: np.ndarray, sentence: np.ndarray, bag: np.ndarray, label: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> Model:
    """Adam steps on the leaky noisy-or likelihood of the bags, with a penalty on squares of weights.

    numbers and sentence: each feature once in a sentence; bag: of each sentence; label: of each
    bag. Sentences without a feature may be left out. Features that aren't given keep the weight 0.
    """
    use, column = np.unique(numbers, return_inverse=True)
    n_sentences, n_bags = len(bag), len(label)
    # The weights, then the logits of a plain sentence's rate and of the leak.
    theta = np.concatenate([np.zeros(len(use)), [-4.0, -4.0]])
    m, v = np.zeros(len(theta)), np.zeros(len(theta))
    some = np.bincount(sentence, minlength=n_sentences) > 0
    for step in range(1, rounds + 1):
        b, leak = theta[-2:]
        z = np.bincount(sentence, theta[column], n_sentences) + b
        part = np.where(some, np.minimum(_log_clean(z) - _log_clean(b), 0), 0)
        clean = np.exp(np.bincount(bag, part, n_bags) + _log_clean(leak))
        # d log-likelihood / d log(clean) is -clean / (1 - clean) in toxic bags, 1 in others.
        pull = np.where(label == 1, clean / np.maximum(1 - clean, 1e-9), -1.0)
        rate, plain, own = (1 / (1 + np.exp(-np.clip(x, -50, 50))) for x in (z, b, leak))
        # Below a plain sentence's rate nothing is left to pull.
        g = np.where(some & (z >= b), pull[bag], 0)
        grad = np.append(np.bincount(column, (g * rate)[sentence], len(use)) / n_bags - 1e-5 * theta[:-2], [(g * (rate - plain)).sum() / n_bags, pull.sum() * own / n_bags])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    weight = np.zeros(1 << bits)
    weight[use] = theta[:-2]
    return Model(weight, float(theta[-2]), bits, float(1 / (1 + np.exp(-theta[-1]))))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model:
    """Fit on at most ``rows`` rows of docs(doc_id, text) with a label in labels(doc_id, toxic)."""
    context = docs.sparkSession.sparkContext
    kind = "long" if whole_ids(docs) else docs.select("doc_id").schema[0].dataType
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast(kind).alias("key")).agg(F.min("toxic").alias("label"), F.max("toxic").alias("most")).where("label = most")
    # The least keyed hashes: the same rows in any order of the input.
    picked = known.select("key", "label").orderBy(F.xxhash64("key", F.lit(SEED)), "key").limit(rows)
    # Bounded by ``rows``, so it is broadcast.
    chosen = docs.select(F.col("doc_id").cast(kind).alias("key"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "key").dropDuplicates(["key", "text"])
    chosen = settle(chosen.select("text", "label"), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hasher, held = Hasher(bits=bits), np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            word, sentence, of_text = split(texts_of(batch.column("text")), hasher)
            numbers, doc = expand(word, of_text[sentence], hasher)
            np.add.at(held, (np.asarray(batch.column("label"))[doc], numbers), 1)
        some = np.flatnonzero(held.any(axis=0))
        yield {"feature": some, "clean": held[0, some], "toxic": held[1, some]}

    # At most 2^bits rows whatever the corpus.
    held = map_stream(chosen, count, "feature int, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    kinds = dict(chosen.groupBy("label").count().collect())
    if len(kinds) < 2:
        return Model(np.zeros(1 << bits), -50.0, bits)
    use = np.zeros(1 << bits)
    feature = held["feature"].to_numpy()
    use[feature[telling(held["toxic"].to_numpy(), (held["clean"] + held["toxic"]).to_numpy(), kinds[1] / sum(kinds.values()))]] = 1
    shared = context.broadcast(use)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hasher = Hasher(shared.value, bits)
        for batch in batches:
            out, n = [], []
            for text in texts_of(batch.column("text")):
                word, sentence, _ = split([text], hasher)
                numbers, sentence = expand(word[hasher.weighs[word]], sentence[hasher.weighs[word]], hasher)
                numbers, sentence = numbers[use_ := shared.value[numbers] > 0], sentence[use_]
                some, sentence = np.unique(sentence, return_inverse=True)
                out.append(((sentence << bits) | numbers).astype("<i8").tobytes())
                n.append(len(some))
            yield {"features": out, "n": n, "label": batch.column("label")}

    # Bounded by ``rows``.
    sample = map_stream(chosen, gather, "features binary, n int, label int").toPandas()
    sample = sample.sort_values(["features", "n", "label"], kind="stable")  # sums in any order of the input alike
    n = sample["n"].to_numpy(np.int64)
    codes = [np.frombuffer(x, "<i8") for x in sample["features"]]
    code = np.concatenate([*codes, np.empty(0, np.int64)])
    first = np.repeat(np.cumsum(n) - n, [len(x) for x in codes])
    return fit(code & ((1 << bits) - 1), (code >> bits) + first, np.repeat(np.arange(len(n)), n), sample["label"].to_numpy(np.int64), bits)


@any_id("doc_id")
def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hasher = shared.value.hasher()
        for batch in batches:
            yield {"key": batch.column("key"), "score": shared.value.documents(texts_of(batch.column("text")), hasher)}

    rows = docs.select(id_key().alias("key"), F.col("text").cast("string").alias("text"))
    return map_stream(rows, run, "key long, score double").select(id_of("key").alias("doc_id"), "score")


@any_id("doc_id")
def offending(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``doc_id, sentence, score, text``: the sentences scored ``least`` or more; sentences count from 0, those without a word left out."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch.column("text"))
        values, of_text = shared.value.sentences(texts, shared.value.hasher())
        first = np.searchsorted(of_text, np.arange(len(texts)))
        hit = np.flatnonzero(values >= least)
        pieces = {k: [s for s in _STOP.split(texts[k]) if s.translate(ALNUM).split()] for k in set(of_text[hit].tolist())}
        place = hit - first[of_text[hit]]
        return {
            "key": np.asarray(batch.column("key"))[of_text[hit]], "sentence": place, "score": values[hit],
            "text": [pieces[k][i].decode("utf-8", "replace") for k, i in zip(of_text[hit].tolist(), place.tolist())],
        }

    rows = docs.select(id_key().alias("key"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, "key long, sentence int, score double, text string").select(id_of("key").alias("doc_id"), "sentence", "score", "text")


def reject(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs whose score is below ``least``; all columns, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = shared.value.hasher()
        for batch in small(batches):
            texts = texts_of(batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array(shared.value.documents(texts, hasher) < least))

    return docs.mapInArrow(run, docs.schema)


def fold(name: str = "doc_id") -> Column:
    """crc32 of the id as text modulo 5; fold 0 is held out of training."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % 5


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score; rows of fold 0 are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs, train(docs, labels.where(fold() != 0)))
    return scored.select("doc_id", (F.coalesce(fold(), F.lit(-1)) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
