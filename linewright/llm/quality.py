"""Quality rules with risk-controlled cutoffs.

Every text gets counts and from them one value per rule. A rule rejects a text whose value is
above the rule's cutoff. The cutoffs of all rules are tightened together, along one fixed
sequence of levels from the loosest on, and a stratum (a language) gets one level. It is chosen
on the holdout, which is every labelled good text that passes the base rule; nothing else learns
from the labels. A level is allowed while an exact binomial test rejects that the union of all
rules loses a share of ``alpha`` of good texts or more. The first level that fails ends the
sequence (fixed-sequence testing, which needs no correction along the levels, nor over the
rules, as their union is tested); the level of each test is ``delta / strata``, which corrects
for all strata (Bonferroni). So with probability ``1 - delta`` no stratum loses more than
``alpha`` of its good texts to the rules. Where the labels of a stratum do not suffice its rules
stay off; with four strata 86 good texts without a loss are the least.

Everything is Spark expressions. Counts of words and of 3-word windows are taken inside each
row, so texts are not shuffled. The binomial tail is summed from the largest term down; the
terms left out are far below the rounding of a double.

Words: runs of characters other than space and 0x09 to 0x0D. A null text has no words. Null
languages are a stratum. An id that is labelled twice counts if all its labels agree; null ids
are not labelled. Repeated rows come out, and count among the labelled, as often as they go in.
Other columns do not matter. Without labels only the base rule rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, settle, table

ALPHA = 0.05
DELTA = 0.05
_BLANKS = " \t\n\x0b\x0c\r"

LEVELS = 20
#: Rules with their cutoff at each level; a value above the cutoff rejects.
GRIDS: dict[str, list[float]] = {
    "symbols": [x / 100 for x in (300, 200, 150, 100, 75, 50, 40, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2, 1)],
    "dup_lines": [(95 - 5 * j) / 100 for j in range(LEVELS)],
    "repeats": [(20 - j) / 40 for j in range(LEVELS)],
    "long_words": [(80 - 3 * j) / 4 for j in range(LEVELS)],
    "short_words": [-(4 + j) / 4 for j in range(LEVELS)],
}


def _covered(places: Column) -> Column:
    """Words in windows of three that start at the places, which are in order."""
    step = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last"))
    return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), step, lambda acc: acc["n"])


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that the text holds twice or more."""

    def found(hashes: Column) -> Column:
        twice = lambda s: F.exists(F.sequence(F.lit(1), F.size(s) - 1), lambda j: F.get(s, j) == F.get(s, j - 1))

        def places(s: Column) -> Column:
            same = lambda x, other: F.coalesce(other["h"] == x["h"], F.lit(False))
            of = F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
            return _covered(F.sort_array(F.transform(of, lambda x: x["i"])))

        ordered = lambda: let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places)
        return F.when(let(F.sort_array(hashes), twice), ordered()).otherwise(0)

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, 0).otherwise(let(hashes, found))


def _word_counts(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _repeat_words(words).cast("long").alias("n_repeat_words"),
    )


def _line_counts(lines: Column) -> Column:
    return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, lang`` and the counts of every row of docs(doc_id, text, lang)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = F.btrim(text, F.lit(_BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\x09-\\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(_BLANKS)) != "")
    found = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), let(words, _word_counts).alias("w"), let(lines, _line_counts).alias("l"),
        F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    return found.select("doc_id", "lang", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    """The value of each rule; 0 words give 0."""
    share = lambda x, of: F.coalesce(F.try_divide(F.col(x), F.col(of)), F.lit(0.0))
    return {
        "symbols": share("n_symbols", "n_words"), "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"),
        "long_words": share("word_chars", "n_words"), "short_words": -share("word_chars", "n_words"),
    }


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1, by Stirling's series from x + 8 on."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    down = F.log(x)
    for k in range(1, 8):
        down = down + F.log(x + k)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - down


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial of n trials at p; for k up to n * p the sum is exact, above it is 1."""
    top = log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    # Each term is the one above it times i / (n - i + 1) * (1 - p) / p; they fall like a
    # Gaussian at least, so 40 + 12 * sqrt(k) terms leave out less than 1e-30.
    terms = F.least(k, F.ceil(40 + 12 * F.sqrt(k))).cast("int")
    steps = F.when(terms < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), terms))
    ratio = lambda i: (k - i + 1) / (n - k + i) * ((1 - p) / p)
    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")), lambda acc, i: F.struct((acc["sum"] + acc["term"] * ratio(i)).alias("sum"), (acc["term"] * ratio(i)).alias("term")), lambda acc: acc["sum"])
    return F.when(k > n * p, 1.0).otherwise(F.exp(top + F.log(total)))


def _level() -> Column:
    """The first level that rejects a text; ``LEVELS`` if none does."""
    first = lambda v, grid: let(v, lambda x: F.size(F.filter(F.array(*(F.lit(float(c)) for c in grid)), lambda c: x <= c)))
    return F.least(*(first(v, GRIDS[r]) for r, v in rule_values().items()))


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum, good, level`` and a column per rule: its cutoff; null where the rules are off.

    labels: doc_id, quality (1 good). A row per stratum that has good labelled texts.
    """
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("least"), F.max("quality").alias("most")).where("least = 1 and most = 1").select("doc_id")
    held = measured.where(~base_failed()).join(good, "doc_id").select(_stratum(), _level().alias("first"))
    # At most LEVELS + 1 rows a stratum.
    counts = settle(held.groupBy("stratum", "first").agg(F.count("*").cast("double").alias("n")), "holdout")
    lost = [F.sum(F.when(F.col("first") <= j, F.col("n")).otherwise(0.0)) for j in range(LEVELS)]
    tested = settle(counts.groupBy("stratum").agg(F.sum("n").alias("good"), F.array(*lost).alias("lost")), "losses")
    level = delta / max(1, tested.count())
    passes = F.transform("lost", lambda k: binomial_at_most(k, F.col("good"), alpha) <= level)
    # Places count from 1: the first that fails, 0 for none.
    last = let(F.array_position(passes, False), lambda stop: F.when(stop == 0, LEVELS - 1).when(stop > 1, (stop - 2).cast("int")))
    chosen = tested.select("stratum", "good", last.alias("level"))
    return chosen.select("*", *(F.get(F.array(*(F.lit(float(c)) for c in grid)), F.col("level")).alias(f"cut_{r}") for r, grid in GRIDS.items()))


def _stratum() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("stratum")


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The counts of every row, base_failed, the rules that reject it, and kept."""
    measured = settle(measure(docs), "measured")
    cuts = settle(cutoffs(measured, labels, alpha, delta), "cutoffs")
    if cuts.count() <= 10_000:
        cuts = F.broadcast(cuts)  # a row per language, counted just before
    each = measured.withColumn("stratum", _stratum()).join(cuts, "stratum", "left")
    rejects = F.array_compact(F.array(*(F.when(v > F.col(f"cut_{r}"), F.lit(r)) for r, v in rule_values().items())))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return each.select("doc_id", *counts, base_failed().alias("base_failed"), rejects.alias("rejected_by")).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    found = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("rejected_by", F.concat_ws(",", "rejected_by"))


OP6_SQL = r"""
WITH own AS (SELECT doc_id, lang, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS n_symbols FROM documents),
thirds AS (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, third) AS times FROM (
  SELECT doc_id, s, array_to_string(words[s:s + 2], ' ') AS third FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS s FROM own))),
repeats AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(s, s + 3)) AS place FROM thirds WHERE times > 1) GROUP BY doc_id),
base AS (SELECT doc_id, '=' || lang AS stratum, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM own LEFT JOIN repeats USING (doc_id)),
judged AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
levels AS (SELECT j, ([3, 2, 1.5, 1, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01]::DOUBLE[])[j + 1] AS symbols_cut,
    (95 - 5 * j) / 100 AS dup_lines_cut, (20 - j) / 40 AS repeats_cut, (80 - 3 * j) / 4 AS long_words_cut, -(4 + j) / 4 AS short_words_cut FROM range(20) t(j)),
valued AS MATERIALIZED (SELECT doc_id, coalesce(stratum, '') AS stratum, base_failed, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_lines, coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeats,
    coalesce(word_chars / nullif(n_words, 0), 0) AS long_words, -coalesce(word_chars / nullif(n_words, 0), 0) AS short_words FROM judged),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1),
counted AS MATERIALIZED (SELECT stratum, j, count(*) AS n, count(*) FILTER (WHERE symbols > symbols_cut OR dup_lines > dup_lines_cut OR repeats > repeats_cut
    OR long_words > long_words_cut OR short_words > short_words_cut) AS k
  FROM valued JOIN good USING (doc_id), levels WHERE NOT base_failed GROUP BY ALL),
tested AS (SELECT *, CASE WHEN k > n * 0.05 THEN 1 ELSE list_sum([
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95)) FOR i IN range(0, k + 1)]) END
    <= 0.05 / (SELECT count(DISTINCT stratum) FROM counted) AS passes FROM counted),
cuts AS (SELECT stratum, max(j) AS j FROM (
  SELECT *, min(CASE WHEN passes THEN 1000000 ELSE j END) OVER (PARTITION BY stratum) AS stop FROM tested) WHERE j < stop GROUP BY stratum),
found AS (SELECT valued.*, concat_ws(',', CASE WHEN symbols > symbols_cut THEN 'symbols' END, CASE WHEN dup_lines > dup_lines_cut THEN 'dup_lines' END,
    CASE WHEN repeats > repeats_cut THEN 'repeats' END, CASE WHEN long_words > long_words_cut THEN 'long_words' END, CASE WHEN short_words > short_words_cut THEN 'short_words' END) AS rejected_by
  FROM valued LEFT JOIN (SELECT stratum, levels.* FROM cuts JOIN levels USING (j)) USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rejected_by, NOT base_failed AND rejected_by = '' AS kept
FROM found
"""
