"""Quality counts and cutoffs against brute-force versions."""

import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from linewright.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeat = {i + d for i, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeat), len(lines)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def test_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in Q.measure(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


ODD = [None, "", " \n\t ", "one", "a b", "a b c", "a b c a b c", "a a a a a", "x\n\nx\n x\nx", "  lead and trail \r\n", "# * $ % & | < > ü 🎉", "\x0b\x0cw\x0b", "a b c\nz a b c q a b", "  nbsp em"]


def test_odd_texts(spark):
    rows = [(i if i else None, t, None if i % 3 else "en", 1, "x") for i, t in enumerate(ODD)] + [(5, ODD[5], "en", 1, "x")]
    rows.append((99, "deep sea blue " * 4000, "en", 1, "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, stratum string")
    got = sorted((str(r.doc_id), *(r[c] for c in COUNTS)) for r in Q.measure(docs).collect())
    assert got == sorted((str(i), *brute(t)) for i, t, *_ in rows)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 1), (3, 0)], "doc_id long, quality int")
    out = Q.judge(docs, labels).collect()
    assert len(out) == len(rows) and all(not r.kept for r in out)
    assert Q.judge(docs.limit(0), labels.limit(0)).collect() == []


def test_binomial(spark):
    cases = [(k, n) for n in (1, 5, 40, 300, 2000) for k in (0, 1, 3, 8, 20, 25) if k <= n]
    df = spark.createDataFrame([(float(k), float(n)) for k, n in cases], "k double, n double")
    for p in (Fraction(1, 100), Fraction(1, 10)):
        got = df.select(Q.binomial_at_most(F.col("k"), F.col("n"), float(p)).alias("x")).collect()
        for (k, n), r in zip(cases, got):
            exact = float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
            assert r.x == pytest.approx(exact, rel=1e-9) if k <= n * p else r.x == 1.0
    big = spark.range(1).select(Q.binomial_at_most(F.lit(9.97e6), F.lit(1e9), 0.01).alias("x")).first().x
    assert 0 < big < 1


def brute_level(texts, level, alpha=Fraction(1, 20)):
    """The last level before the first at which the union of the rules may lose too much."""
    last = None
    for j in range(Q.LEVELS):
        lost = 0
        for n, chars, symbols, dup, repeat, lines in map(brute, texts):
            value = {"symbols": symbols / n, "dup_lines": dup / lines, "repeats": repeat / n, "long_words": chars / n, "short_words": -chars / n}
            lost += any(value[r] > grid[j] for r, grid in Q.GRIDS.items())
        n = len(texts)
        if lost > n * alpha or float(sum(comb(n, i) * alpha**i * (1 - alpha) ** (n - i) for i in range(lost + 1))) > level:
            break
        last = j
    return last


def test_levels_by_hand(spark):
    """Two strata with known shares of symbols and word lengths; the third has one text too few."""
    rows, labels = [], []
    for i in range(700):
        text = " ".join(f"wo{i}x{k}" for k in range(60)) + (" ####" * (i % 23) if i % 40 == 0 else "") + (f" {'y' * i}" if i % 50 == 1 else "")
        rows.append((i, text, "en" if i < 400 else "fr" if i < 615 else "de"))
        labels.append((i, 1))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")
    cuts = {r.stratum: r for r in Q.cutoffs(Q.measure(docs), labels).collect()}
    want = {g: brute_level([t for _, t, x in rows if x == g], 0.05 / 3) for g in ("en", "fr", "de")}
    assert {g: cuts[f"={g}"].level for g in want} == want and want["en"] and want["fr"]
    assert cuts["=en"].good == 400 and cuts["=en"].cut_symbols == Q.GRIDS["symbols"][want["en"]]
    few = {r.stratum: r for r in Q.cutoffs(Q.measure(docs), labels.where("doc_id < 465")).collect()}
    assert few["=fr"].level is None and all(few["=fr"][f"cut_{r}"] is None for r in Q.GRIDS)
    out = Q.judge(docs, labels).collect()
    assert 0 < sum(not r.kept for r in out) <= 0.05 * 700


def test_rules_reject_on_the_table(spark):
    got = Q.op6_quality(spark, "/root/testdata/sf0.01").where("rejected_by != '' and not base_failed").collect()
    assert got and not any(r.kept for r in got)
    assert all(set(r.rejected_by.split(",")) <= set(Q.GRIDS) for r in got)


def test_false_rejections_on_the_table(spark):
    got = Q.op6_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = got.join(labels, "doc_id").where("quality = 1 and not base_failed").collect()
    assert sum(not r.kept for r in good) <= 0.05 * len(good)
