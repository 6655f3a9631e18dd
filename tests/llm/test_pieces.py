"""SentencePiece encoding: the model's own library without dropout, exact round trips with it."""

import numpy as np
import pytest

from linewright.llm import pieces as P

ODD = ["", " ", "a\nb", " a", "x" * 300 + " the " * 5, "é ①\x00\t  z", "🎉" * 60, "▁ low ▁▁block", "<0x41> <s></s>", "\n\n  \n", "end  "]


@pytest.fixture(scope="module")
def model():
    return P.Model()


def spread(ids, n):
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_no_dropout_is_the_model(spark):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = P.encode(docs, dropout=0).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.ids == own.encode(r.text, num_threads=1) and r.lossless for r in rows)


def test_odd_texts_without_dropout(model):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    texts = [t for t in ODD if "▁" not in t]
    got = spread(*P.Encoder(model, 0).encode([t.encode() for t in texts], np.arange(len(texts))))
    assert got == [own.encode(t) for t in texts]


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_round_trip(model, dropout):
    raw = [*(t.encode() for t in ODD), b"\xff\xfe bad \xc3"]
    got = spread(*P.Encoder(model, dropout).encode(raw, np.arange(len(raw))))
    assert [P.decode(model, np.array(g, np.int64)) for g in got] == raw


def test_many_and_heap_agree(model):
    rng = np.random.default_rng(2)
    for dropout in (0, 0.1, 0.4):
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 24))) for _ in range(300)]
        symbols = [[model.chars[c] for c in w] for w in words]
        keys = rng.integers(0, 2**63, len(words)).astype(np.uint64)
        rows = np.full((len(words), 24), -1)
        for r, s in zip(rows, symbols):
            r[: len(s)] = s
        ids, n = P.segment_many(model, rows, np.array([len(s) for s in symbols]), keys, dropout)
        assert [i[:k].tolist() for i, k in zip(ids, n)] == [P.segment_heap(model, s, int(k), dropout) for s, k in zip(symbols, keys)]


def test_seeds_and_places_vary(model):
    text = [b"wonderful encoding of understandable sentences " * 40]
    one = P.Encoder(model, 0.3, seed=1).encode(text, np.array([5]))[0].tolist()
    assert one == P.Encoder(model, 0.3, seed=1).encode(text, np.array([5]))[0].tolist()
    assert one != P.Encoder(model, 0.3, seed=2).encode(text, np.array([5]))[0].tolist()
    parts = P.Encoder(model, 0.3, seed=1).encode([b"wonderful"] * 60, np.arange(60))
    assert len({tuple(x) for x in spread(*parts)}) > 1
    # What was met before makes no difference.
    other = P.Encoder(model, 0.3, seed=1, most=3)
    other.encode([b"some other words of a batch"], np.array([1]))
    assert one == other.encode(text, np.array([5]))[0].tolist()


def test_each_occurrence_is_drawn_on_its_own(model):
    """A word of one possible merge stays apart in its share of places, over documents and inside one."""
    # " z" can only be merged once; so its share of unmerged places is the dropout.
    whole = P.Encoder(model, 0).encode([b"z"], np.arange(1))[0].tolist()
    assert len(whole) == 1
    for seed in range(6):
        ids, n = P.Encoder(model, 0.1, seed=seed).encode([b"z"] * 20_000, np.arange(20_000))
        assert 0.09 < (n == 2).mean() < 0.11
        assert 0.09 < (P.Encoder(model, 0.1, seed=seed).encode([b"z z" + b" z" * 9998], np.arange(1))[1][0] - 10_000) / 10_000 < 0.11
    # All occurrences as the agenda of their own key has them, begun at the word's characters.
    texts = [b"wonderful encoding of understandable sentences " * 30]
    for dropout in (0.05, 0.3):
        e = P.Encoder(model, dropout)
        e.encode(texts, np.array([3]))
        at = np.repeat(np.arange(len(e.known)), 200)
        key = P.mix(np.arange(len(at), dtype=np.uint64))
        same = e._same(at, key)
        assert (same < 0).any() and (same == 0).any() and (same > 0).any()
        store, start, size = e._segment(at, key, dropout)
        replayed, start_r, size_r = e._segment(at, key, dropout, np.maximum(same, 0))
        for k, w in enumerate(at.tolist()):
            own = store[start[k] : start[k] + size[k]].tolist()
            symbols = e.symbols[e.begin[w] : e.begin[w] + e.length[w]].tolist()
            assert own == P.segment_heap(model, symbols, int(key[k]), dropout)
            assert own == replayed[start_r[k] : start_r[k] + size_r[k]].tolist()
            if same[k] < 0:
                assert own == e.store[e.start[w] : e.start[w] + e.size[w]].tolist()


def test_rows(spark):
    rows = [(None, "a b", "x"), (1, None, "y"), (2, "", "z"), (3, "same text", "q"), (3, "same text", "q"), (4, "long word" * 3000, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = P.encode(docs).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.lossless for r in out) and len(out) == 6
    assert by[1][0].ids is None and by[1][0].n_pieces == 0 and by[2][0].ids == []
    assert by[3][0] == by[3][1]
    back = sorted(((r.doc_id, r.text) for r in P.decode_ids(P.encode(docs)).collect()), key=str)
    assert back == sorted(((i, t) for i, t, _ in rows), key=str)
    assert P.encode(docs.limit(0)).collect() == []
