"""Token counts by separator scan against counting each text by itself."""

import random

import numpy as np
import pytest

from linewright.llm import tokens as T


def brute(data, end):
    """(start, n, closed) of each document of one flat file."""
    out, start = [], 0
    for i, x in enumerate(data):
        if x == end:
            out.append((start, i - start, True))
            start = i + 1
    return out + ([(start, len(data) - start, False)] if start < len(data) else [])


@pytest.mark.parametrize("run", [2, 1024])
def test_blocks_are_stitched(spark, run, monkeypatch):
    monkeypatch.setattr(T, "RUN", run)
    rng = random.Random(run)
    rows, want = [], []
    for k in range(12):
        data = [rng.choice([0, 1, 2, 9]) if k % 3 else rng.choice([1, 2]) for _ in range(rng.choice([0, 1, 7, 40, 200]))]
        cuts = sorted(rng.sample(range(len(data) + 1), min(len(data), rng.randint(0, 9))))
        edges = [0, *cuts, len(data)]
        rows += [(f"f{k}", b, np.array(data[x:y], "<u2").tobytes(), "x") for b, (x, y) in enumerate(zip(edges, edges[1:]))]
        want += [(f"f{k}", o, *d) for o, d in enumerate(brute(data, 9))]
    rng.shuffle(rows)
    blocks = spark.createDataFrame(rows, "file string, block long, tokens binary, n string")
    got = sorted((r.file, r.ordinal, r.start, r.n_tokens, r.closed) for r in T.documents(blocks, end=9).collect())
    assert got == sorted(want)
    assert T.documents(blocks.limit(0)).collect() == []


def test_whole_table(spark):
    encode = T.tokenizer(T.load_ranks()).encode_ordinary
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in T.op8_tokens(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r.doc_id: len(encode(r.text)) for r in docs.collect()}


def test_odd_rows(spark):
    encode = T.tokenizer(T.load_ranks()).encode_ordinary
    rows = [(None, "a b", "x"), (1, None, "y"), (2, "", "z"), (3, "same", "q"), (3, "same", "q"), (4, "many words " * 9000, "r"), (5, "<|endoftext|>", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, file string")
    got = sorted(((r.doc_id, r.n_tokens) for r in T.token_counts(docs, block=64).collect()), key=str)
    assert got == sorted(((i, len(encode(t or ""))) for i, t, _ in rows), key=str)
    assert T.token_counts(docs.limit(0)).collect() == []


def test_raw_files(spark, tmp_path):
    rng = np.random.default_rng(3)
    data = {}
    for name, n in (("a.bin", 10_007), ("b.bin", 4096), ("c.bin", 0), ("d.bin", 5)):
        data[name] = rng.integers(0, 50, n).astype("<u2")
        data[name].tofile(tmp_path / name)
    found = T.documents(T.read_flat(spark, str(tmp_path), block=512), end=7).collect()
    for name, x in data.items():
        got = sorted((r.ordinal, r.start, r.n_tokens, r.closed) for r in found if r.file.endswith(name))
        assert got == [(o, *d) for o, d in enumerate(brute(x.tolist(), 7))]
