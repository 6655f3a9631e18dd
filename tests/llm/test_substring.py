"""Removal of repeated word sequences against a brute-force version."""

import hashlib
import random

import numpy as np
import pytest

from linewright.llm import substring as S


def brute(rows, window):
    """doc_id, kept words per row."""
    first = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    split = [(t or "").encode().split() for _, t in rows]
    for i in order:
        for s in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][s : s + window]), (rows[i][0], s))
    out = []
    for (doc, _), words in zip(rows, split):
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] != (doc, s):
                gone.update(range(s, s + window))
        out.append((doc, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def test_whole_table(spark):
    got = {r.doc_id: tuple(r) for r in S.op2_substring_dedup(spark, "/root/testdata/sf0.001").collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = {d: (d, n, g, hashlib.sha256(k).hexdigest()) for d, n, g, k in brute(rows, 20)}
    assert got == want and any(x[2] for x in want.values())


def random_rows(seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcde") for _ in range(rng.randint(3, 30))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))]
            if words and rng.random() < 0.3:
                words[rng.randrange(len(words))] = "z"
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [2, 5, 16])
def test_random_texts(spark, window):
    rows = random_rows(window)
    docs = spark.createDataFrame([(i, t, "x", len(t)) for i, t in rows], "doc_id long, text string, path string, n_chars int")
    out = S.dedup(docs, window)
    assert out.columns == docs.columns
    texts = dict(rows)
    want = {d: (k.decode() if g else texts[d]) for d, _, g, k in brute(rows, window) if k or not g}
    got = out.collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_spans_have_their_source(spark):
    rows = random_rows(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = {d: t.split() for d, t in rows}
    spans = S.repeated_spans(docs, 6).collect()
    assert spans
    for r in spans:
        assert r.n >= 6 and (r.from_doc_id, r.from_start) < (r.doc_id, r.start)
        assert words[r.doc_id][r.start : r.start + r.n] == words[r.from_doc_id][r.from_start : r.from_start + r.n]


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(None, long), (1, None), (2, ""), (3, long), (4, "x " * 3000), (5, "short"), (5, "short"), (6, long + " tail"), (6, long + " tail")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key int")
    got = sorted(((r.doc_id, r.text) for r in S.dedup(docs).collect()), key=str)
    want = [(None, long), (1, None), (2, ""), (4, "x"), (5, "short"), (5, "short"), (6, "tail"), (6, "tail")]
    assert got == sorted(want, key=str)


def test_texts_of_one_id_are_documents_of_their_own(spark):
    """Rows without an id, or of one id, share neither places nor order unless their texts are equal."""
    words = lambda w, n=30: " ".join(f"{w}{k}" for k in range(n))
    for doc in (None, 7):
        rows = [(doc, words("a")), (doc, words("b")), (doc, words("b")), (doc, words("c") + " " + words("c")), (doc, words("d", 60)), (9, words("d", 25) + " end")]
        got = sorted(((r.doc_id, r.text) for r in S.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
        want = [(doc, words("a")), (doc, words("b")), (doc, words("b")), (doc, words("c")), (doc, words("d", 60)), (9, "end")]
        assert got == sorted(want, key=str)
        both = [(doc, words("e") + " x"), (doc, words("e") + " y")]
        got = [r.text for r in S.dedup(spark.createDataFrame(both, "doc_id long, text string")).collect()]
        assert sorted(got) in (sorted(["x", words("e") + " y"]), sorted([words("e") + " x", "y"]))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.dedup(docs).collect() == [] and S.repeated_spans(docs).collect() == []


def test_grams_and_least():
    x = np.random.default_rng(0).integers(0, 9, 200).astype(np.uint64)
    for n in (1, 2, 3, 7, 8, 13, 20):
        g = S.grams(x, n)
        assert len(g) == 200 - n + 1
        same = {}
        for i in range(len(g)):
            assert same.setdefault(tuple(x[i : i + n]), g[i]) == g[i]
        assert len(set(g.tolist())) == len(same)
        assert S._least(x, n).tolist() == [i + int(np.argmin(x[i : i + n])) for i in range(len(g))]
