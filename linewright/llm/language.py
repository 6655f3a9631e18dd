"""Language ID by Bayesian evidence fusion.

Four kinds of evidence are fused, the first two as independent given the language, so their
log-likelihoods are added to the log of the prior:

text    naive Bayes over hashed byte trigrams of words, counted over all labelled documents
markup  the language that the page declares, P(declared | language) from labelled pages
suffix  P(language | suffix) of the host's suffix, smoothed towards the whole table's shares
host    P(language | host), smoothed towards that; from grouped aggregation

The most specific of host, suffix and whole table is the prior. A host has one suffix, so the
suffix counts in the prior alone and not as a likelihood beside it.

Counts of labelled pages are smoothed, so evidence never seen with a language only makes it less
likely. The text's trigrams depend on each other, so its log-likelihood is divided by
``1 + length / TEMPER``, which keeps long texts from drowning everything else.

The text model has ``2 ** BITS`` columns for each language and languages are few, so what is
broadcast does not grow with the corpus; host counts do, and are joined.

A null or empty text, missing markup, a null url and unknown values give no evidence. Equal rows
come out as often as they go in. A null language labels nothing. Without any labels every
language is null. Ties go to the language that comes first in the alphabet. Other columns do not
matter. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, map_stream, mix, settle, table, texts_of
from .urls import host_of, path_of, suffix_of

BITS = 16
TEMPER = 200.0
#: Pseudo-counts: of a trigram, of declared markup and suffixes, and of a parent's share.
SMOOTH, FLAT, STRENGTH = 0.5, 1.0, 20.0
#: Most languages; bounds the model.
MAX_LANGUAGES = 1_000


def trigrams(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams inside words, with a blank at both ends, and the number of them of each text."""
    lines = [b" " + b" ".join(t.translate(LOWER).split()) + b" " for t in texts]
    n = np.array([len(x) for x in lines], np.int64)
    x = np.frombuffer(b"".join(lines), np.uint8).astype(np.uint64)
    if len(x) < 3:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    code = (x[:-2] << np.uint64(16)) | (x[1:-1] << np.uint64(8)) | x[2:]
    text = np.repeat(np.arange(len(texts)), n)
    inside = (text[2:] == text[:-2]) & (x[1:-1] != 32)
    code = mix(code[inside]) >> np.uint64(64 - bits)
    return code.astype(np.int64), np.bincount(text[:-2][inside], minlength=len(texts))


class Model:
    """Log-likelihoods of trigrams by language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        share = counts + SMOOTH
        self.log = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """A row per text, a column per language: tempered log-likelihood, 0 without text."""
        code, n = trigrams(texts)
        text = np.repeat(np.arange(len(texts)), n)
        out = np.empty((len(texts), len(self.languages)))
        for k, log in enumerate(self.log):
            out[:, k] = np.bincount(text, log[code], len(texts))
        return out / (1 + n / TEMPER)[:, None]


def train_text(docs: DataFrame) -> Model:
    """The text model from every row of docs(text, lang) that has a language."""
    known = docs.where("lang is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own: dict[str, np.ndarray] = {}
        for batch in batches:
            languages = batch.column("lang").to_pylist()
            names, which = np.unique(languages, return_inverse=True)
            code, n = trigrams(texts_of(batch.column("text")))
            found = np.bincount((np.repeat(which, n) << BITS) | code, minlength=len(names) << BITS).reshape(len(names), -1)
            for name, row in zip(names.tolist(), found):
                own[name] = own.get(name, 0) + row
        for name, row in own.items():
            some = np.flatnonzero(row)
            yield {"lang": [name] * (len(some) + 1), "code": np.append(some, -1), "n": np.append(row[some], 0)}

    counted = map_stream(known, count, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    counted = settle(counted, "trigrams")
    languages = sorted(r.lang for r in counted.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # At most 2^BITS rows a language, whatever the corpus.
    counts = np.zeros((len(languages), 1 << BITS))
    found = counted.where("code >= 0").toPandas()
    counts[np.searchsorted(languages, found["lang"].to_numpy()) if len(found) else [], found["code"].to_numpy()] = found["n"].to_numpy()
    return Model(languages, counts)


def shown_text(html: Column) -> Column:
    """The text of a page: no comments, scripts or styles, tags to blanks."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>|&#?\w+;", " ")


def declared(html: Column) -> Column:
    """The language that ``<html lang=...>`` declares, without region, in lower case; null if none."""
    found = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def identify(pages: DataFrame, labels: DataFrame, docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``page_id, lang, probability, text_lang, declared`` of every row of pages(page_id, url, html).

    labels: page_id, lang, of some pages; docs: text, lang, to train the text model. ``keep``
    names columns of pages to hand on; none may be called as a column made here.
    """
    model = train_text(docs)
    if not model.languages:
        return pages.select("page_id", *keep, *(F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("probability", "double"), ("text_lang", "string"), ("declared", "string"))))
    languages = model.languages
    shared = pages.sparkSession.sparkContext.broadcast(model)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    host = host_of(F.col("url"))
    rows = pages.select("page_id", *keep, F.nullif(host, F.lit("")).alias("host"), F.nullif(suffix_of(host), F.lit("")).alias("suffix"), declared(html).alias("declared"), shown_text(html).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            score = shared.value.score(texts_of(batch.column("text")))
            yield {c: batch.column(c) for c in ("page_id", *keep, "host", "suffix", "declared")} | {"text": score.tolist()}

    kinds = dict(rows.dtypes)
    read = settle(map_stream(rows, run, ", ".join(f"{c} {kinds[c]}" for c in ("page_id", *keep)) + ", host string, suffix string, declared string, text array<double>"), "evidence")
    known = labels.where(F.col("page_id").isNotNull() & F.col("lang").isin(languages)).groupBy("page_id").agg(F.min("lang").alias("label"), F.max("lang").alias("other")).where("label = other").select("page_id", "label")
    # One row per host, suffix, declared language and label: all that follows comes from it.
    seen = settle(read.join(known, "page_id").groupBy("host", "suffix", "declared", "label").agg(F.count("*").alias("n")), "labelled")
    count = lambda c: F.array(*(F.sum(F.when(F.col("label") == x, F.col(c)).otherwise(0)).cast("double") for x in languages))
    total = [x or 0.0 for x in seen.agg(count("n").alias("n")).first().n]
    whole = F.array(*(F.lit((x + FLAT) / (sum(total) + FLAT * len(languages))) for x in total))
    by_suffix = _shrink(seen.where("suffix is not null").groupBy("suffix").agg(count("n").alias("n")).withColumn("parent", whole), "suffix")
    by_host = seen.where("host is not null").groupBy("host", "suffix").agg(count("n").alias("n")).join(by_suffix.withColumnRenamed("share", "parent"), "suffix")
    by_host = _shrink(by_host, "host")
    told = _likelihood(seen, "declared", count, total)
    # Suffixes and declared languages are few, hosts are many; Spark sizes each join.
    fused = read.join(by_host, "host", "left").join(by_suffix.withColumnRenamed("share", "suffix_share"), "suffix", "left").join(told, "declared", "left")
    prior = F.transform(F.coalesce("share", "suffix_share", whole), lambda x: F.log(x))
    add = lambda a, b: F.zip_with(a, F.coalesce(b, F.array(*[F.lit(0.0)] * len(languages))), lambda x, y: x + y)
    logs = add(add(prior, F.col("text")), F.col("declared_log"))
    fused = fused.select("page_id", *keep, "declared", "text", logs.alias("logs"))
    names = F.array(*(F.lit(x) for x in languages))
    best = lambda c: F.get(names, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    mass = F.aggregate(F.transform("logs", lambda x: F.exp(x - F.array_max("logs"))), F.lit(0.0), lambda a, x: a + x)
    said = F.exists("text", lambda x: x != 0)
    return fused.select("page_id", *keep, best(F.col("logs")).alias("lang"), (1 / mass).alias("probability"), F.when(said, best(F.col("text"))).alias("text_lang"), "declared")


def _shrink(counted: DataFrame, key: str) -> DataFrame:
    """``key, share``: counts n smoothed towards the share of the parent."""
    total = F.aggregate("n", F.lit(0.0), lambda a, x: a + x)
    return counted.select(key, F.zip_with("n", "parent", lambda x, p: (x + STRENGTH * p) / (total + STRENGTH)).alias("share"))


def _likelihood(seen: DataFrame, value: str, count, total: list[float]) -> DataFrame:
    """``value, value_log``: log P(value | language), values smoothed alike."""
    kinds = seen.agg(F.countDistinct(value)).first()[0] + 1
    own = seen.where(F.col(value).isNotNull()).groupBy(value).agg(count("n").alias("n"))
    parts = [F.log((F.get("n", k) + FLAT) / (t + FLAT * kinds)) for k, t in enumerate(total)]
    return own.select(value, F.array(*parts).alias(f"{value}_log"))


def held_out(number: str = "page_id") -> Column:
    """Rows that op3 does not learn from: crc32 of the id as text modulo 5 is 0."""
    return F.coalesce(F.crc32(F.col(number).cast("string").cast("binary")) % 5, F.lit(0)) == 0


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its language; documents of fold 0, and the pages that show them, are not learnt from.

    A page shows the document whose number ends its path's second part; that document's
    language labels the page. ``held_out``: a page of a document of fold 0; a page without a
    document goes by its own id.
    """
    pages, docs = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    number = F.nullif(F.regexp_extract(path_of(F.col("url")), r"^/[a-z]+/([0-9]{1,18})", 1), F.lit("")).cast("long")
    own = pages.withColumn("doc_id", number).withColumn("held_out", F.when(F.col("doc_id").isNull(), held_out()).otherwise(held_out("doc_id")))
    labels = own.where("not held_out").select("page_id", "doc_id").join(docs.select("doc_id", "lang"), "doc_id").select("page_id", "lang")
    found = identify(own.select("page_id", "url", "html", "held_out"), labels, docs.where(~held_out("doc_id")), keep=("held_out",))
    return found.select("page_id", "held_out", "lang", F.round("probability", 9).alias("probability"), "text_lang", "declared")
