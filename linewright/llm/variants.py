"""Spelling variants grouped by PartEnum signatures.

Words are counted over whole texts. Two words are near if they differ by one inserted, deleted or
replaced code point. The letters of a word are a multiset, seen as a binary vector with a place for
the first, second, ... of each letter; near words of one length have vectors at a Hamming distance
of at most two, words of unequal length at a distance of one. The letters are dealt into ``PARTS``
parts. Vectors that differ in at most k places agree on all but k parts, so enumerating the
selections of PARTS - k parts gives exact signatures: two such words share at least one. A signature
also holds the length. Words are joined on equal signatures and each pair verified by its edit
distance, so nothing is lost and nothing wrong is kept.

The parts are balanced by the letters' counts. A signature that more than ``HOT`` words share, such
as words of the same letters, is refined: one edit leaves the first or the second half of a word as
it was, so the half that is kept goes into two finer signatures.

A word's form is its near word with the most occurrences, if that has at least twice the word's own;
following forms ends at the root. Forms at least double, so a chain is shorter than 63 and pointer
doubling takes at most 6 rounds.

Null and empty texts have no words. A null id counts as an empty one. Repeated rows count each time.
Texts and words may have any length: a word is one value in one row. Other columns do not matter. An
empty table gives no rows. Text that is no UTF-8 has replacement characters, which end a word.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, map_stream, settle, table, texts_of

PARTS = 6
HOT = 64
LEAST_LETTERS = 5
LEAST_TIMES = 3
#: One of so many occurrences loses a letter.
DAMAGE = 97

_RUN = re.compile("[a-zÀ-ÿ]+")
#: Words that are counted together in a task before they are handed on.
_HELD = 1 << 18


def damaged(doc_id: bytes, counts: Counter, damage: int = DAMAGE) -> Iterator[tuple[str, int]]:
    """The words of one document with their counts; where the keyed hash says so, without one letter."""
    start = zlib.crc32(doc_id + b":")
    for word, n in counts.items():
        h = zlib.crc32(word.encode(), start)
        if h % damage == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES, damage: int = DAMAGE) -> DataFrame:
    """``word, n`` over docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(texts_of(batch.column("id")), texts_of(batch.column("text"))):
                found = Counter(_RUN.findall(text.translate(LOWER).decode("utf-8", "replace")))
                for word, n in damaged(doc_id, found, damage):
                    if len(word) >= least_letters:
                        total[word] += n
                if len(total) > _HELD:
                    yield {"word": list(total), "n": list(total.values())}
                    total = Counter()
        yield {"word": list(total), "n": list(total.values())}

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("string").alias("text"))
    return map_stream(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_times)


def _deal(words: DataFrame, parts: int) -> list[str]:
    """The letters of each part: by falling count, there and back again. No more rows than the alphabet has letters."""
    counted = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter != ''").groupBy("letter").count()
    order = sorted(counted.collect(), key=lambda r: (-r["count"], r["letter"]))
    dealt = [""] * parts
    for k, row in enumerate(order):
        turn, at = divmod(k, parts)
        dealt[parts - 1 - at if turn % 2 else at] += row["letter"]
    return dealt


def _enumerate(seen: list[Column], leave: int, *others: Column) -> list[Column]:
    """A signature for each selection of all parts but ``leave``."""
    return [F.xxhash64(F.lit(k), F.lit(leave), *others, *chosen) for k, chosen in enumerate(itertools.combinations(seen, len(seen) - leave))]


def signatures(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``word, n, role, sig``: role 0 for words of one length, 1 the shorter and 2 the longer of unequal ones."""
    dealt = _deal(words, parts)
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    each = words.select("word", "n", F.char_length("word").alias("size"), letters.alias("letters"))
    # A part's places of the vector: the sorted letters without those of the other parts.
    names = [f"part{k}" for k in range(parts)]
    for k, name in enumerate(names):
        rest = "".join(d for j, d in enumerate(dealt) if j != k)
        each = each.withColumn(name, F.translate("letters", rest, "") if rest else F.col("letters"))
    seen = [F.col(n) for n in names]
    tagged = lambda role, sigs: [F.struct(F.lit(role).alias("role"), s.alias("sig")) for s in sigs]
    found = (
        tagged(0, _enumerate(seen, 2, F.col("size")))
        + tagged(1, _enumerate(seen, 1, F.col("size")))
        + tagged(2, _enumerate(seen, 1, F.col("size") - 1))
    )
    return each.select("word", "n", F.inline(F.array(*found)))


def _refined(rows: DataFrame) -> DataFrame:
    """Two finer signatures: the first half, and what follows it (behind the letter that a longer word has more)."""
    size = F.char_length("word") - (F.col("role") == 2).cast("int")
    half = F.floor(size / 2).cast("int")
    skip = half + (F.col("role") == 2).cast("int")
    kept = [F.substring("word", F.lit(1), half), F.substring("word", skip + 1, F.char_length("word"))]
    return rows.select("word", "n", "role", F.explode(F.array(*(F.xxhash64("sig", F.lit(k), x) for k, x in enumerate(kept)))).alias("sig"))


def near_pairs(words: DataFrame, parts: int = PARTS, hot: int = HOT) -> DataFrame:
    """``word, n, near, near_n``: each word of words(word, n) with each of its near words."""
    rows = settle(signatures(words, parts), "signatures")
    crowded = settle(rows.groupBy("sig").count().where(F.col("count") > hot).select("sig"), "crowded")
    rows = rows.join(crowded, "sig", "left_anti").select("word", "n", "role", "sig").unionByName(_refined(rows.join(crowded, "sig", "left_semi")))
    rows = settle(rows, "signed")
    left = rows.where("role < 2").select("sig", "role", "word", "n")
    right = rows.where("role != 1").select("sig", F.col("role").alias("near_role"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = left.join(right, "sig").where("(role = 0 and near_role = 0 and word < near) or (role = 1 and near_role = 2)")
    found = settle(found.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n").distinct(), "near")
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every row of forms(word, form)."""
    now = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = settle(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = ahead.select("word", "root")
        if ahead.where("moved").isEmpty():
            return now


def group(words: DataFrame, parts: int = PARTS, hot: int = HOT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of words(word, n); words are distinct."""
    words = settle(words, "words")
    pairs = near_pairs(words, parts, hot)
    best = pairs.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = best.select("word", "n_near", *(F.when(-F.col("best.less") >= 2 * F.col("n"), c).alias(a) for a, c in (("form", F.col("best.near")), ("form_n", -F.col("best.less")))))
    named = settle(named, "forms")
    out = words.join(named, "word", "left").join(roots(named.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequent words of ``documents`` with their forms and roots."""
    return group(count_words(table(spark, sf_dir, "documents")))


#: Near words by another road: equal patterns with one letter masked, and words with one left out.
OP13_SQL = r"""
WITH RECURSIVE crc_steps AS (
  SELECT b, 0 AS step, b AS c FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE step < 8),
crc AS (SELECT list(c ORDER BY b) AS steps FROM crc_steps WHERE step = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents WHERE text IS NOT NULL),
counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed, run, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(
    flatten(list_transform(string_split(keyed, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)),
    lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM counted, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
masked AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS pattern FROM cuts),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS pattern FROM cuts),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM masked a JOIN masked b USING (pattern) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.pattern = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.pattern = b.word),
near_counts AS (SELECT word, count(*) AS n_near FROM pairs GROUP BY word),
forms AS (
  SELECT word, near AS form, near_n AS form_n FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1 AND near_n >= 2 * n),
chain AS (
  SELECT word, word AS root FROM words
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root),
ends AS (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms))
SELECT w.word, f.form, e.root, w.n, coalesce(c.n_near, 0) AS n_near, f.form_n
FROM words w JOIN ends e USING (word) LEFT JOIN forms f USING (word) LEFT JOIN near_counts c USING (word)
"""
