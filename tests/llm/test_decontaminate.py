"""Decontamination against a brute-force version."""

import hashlib
import re

import numpy as np
import pytest

from linewright.llm import decontaminate as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    """(doc_id, n_words, n_hit, item ids) per row."""
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= ids
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def flat(df):
    return sorted(((r.doc_id, r.n_words, sum(s.n for s in r.spans), tuple(sorted(r["items"]))) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 3000])
def test_whole_tables(spark, block_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert any(x[2] for x in want)
    assert flat(D.contamination(docs, bench, block_bytes=block_bytes)) == want
    clean = sorted(r.doc_id for r in D.decontaminate(docs, bench, block_bytes=block_bytes).collect())
    assert clean == sorted(x[0] for x in want if not x[2])


def test_query_digest(spark):
    got = D.op7_decontaminate(spark, "/root/testdata/sf0.001").where("n_items > 1 or n_items = 1").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    want = {d: i for d, _, _, i in brute([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in bench])}
    assert all(r.items_sha256 == hashlib.sha256(",".join(want[r.doc_id]).encode()).hexdigest() for r in got)


ODD_DOCS = [(1, "x " * 3 + "A-b c! d e f g h i j k l m " + "y z"), (2, None), (3, ""), (None, "short one here"), (4, "short one"), (4, "short one"), (5, "a a a a a a a a a a a a a a"), (6, "Straße ÄÖ b c d e f g h i"), (7, "solo"), (8, "q " * 5000 + "short one q")]
ODD_ITEMS = [(1, "a b c d e f g h i j k l m"), (2, "short one"), (None, "solo"), (3, None), (4, ""), (5, "a a a a a a a a a a a"), (5, "straße ÄÖ b c d e f g h i"), (10, "a b c d e f g h i j zz")]


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 150])
def test_odd_rows(spark, block_bytes):
    docs = spark.createDataFrame([(i, t, 7) for i, t in ODD_DOCS], "doc_id long, text string, n_words int")
    items = spark.createDataFrame([(i, t, "e") for i, t in ODD_ITEMS], "item_id long, text string, spans string")
    assert flat(D.contamination(docs, items, block_bytes=block_bytes)) == brute(ODD_DOCS, ODD_ITEMS)
    kept = D.decontaminate(docs, items, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((x[0] for x in brute(ODD_DOCS, ODD_ITEMS) if not x[2]), key=str)


def test_longest_matches(spark):
    docs = spark.createDataFrame(ODD_DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ODD_ITEMS, "item_id long, text string")
    got = {tuple(r) for r in D.matches(docs, items).where("doc_id = 1").collect()}
    assert got == {(1, "1", 3, 0, 13), (1, "10", 3, 0, 10)}


def test_suffix_array():
    rng = np.random.default_rng(1)
    numbers = np.append(rng.integers(0, 4, 400), 0)
    starts = np.flatnonzero(numbers)

    def suffix(p):
        end = p + int(np.flatnonzero(numbers[p:] == 0)[0])
        return tuple(numbers[p:end])

    order = D.suffix_array(numbers, starts, 400, 3)
    keys = [suffix(p) for p in order]
    assert keys == sorted(keys) and sorted(order) == starts.tolist()


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame(ODD_DOCS, "doc_id long, text string")
    assert D.contamination(docs, items).collect() == []
    assert flat(D.contamination(full, items)) == brute(ODD_DOCS, [])
    assert D.decontaminate(full, items).count() == len(ODD_DOCS)
