"""Multiple-instance toxicity: held-out accuracy, located sentences, odd rows."""

import numpy as np
import pytest

from linewright.llm import toxicity as T


@pytest.fixture(scope="module")
def made(spark):
    """Documents of plain sentences; toxic ones hold one sentence with a bad word, inflected at will."""
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    bad = ["zorkling", "vexxut"]
    docs, labels = [], []
    for i in range(600):
        sentences = [" ".join(rng.choice(vocabulary, 6)) for _ in range(rng.integers(1, 8))]
        toxic = int(i % 4 == 0)
        if toxic:
            sentences.insert(rng.integers(0, len(sentences) + 1), f"{rng.choice(vocabulary)} {bad[i % 3 % 2]}{rng.choice(['', 'en', 'a'])} you")
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_and_located(made):
    docs, labels = made
    model = T.train(docs, labels.where(T.fold() != 0))
    found = T.score(docs, model).join(labels, "doc_id").where(T.fold() == 0).collect()
    assert len(found) > 80 and all((r.score >= 0.5) == bool(r.toxic) for r in found)
    marked = {}
    for r in T.offending(docs, model).collect():
        marked.setdefault(r.doc_id, []).append(r)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for doc, text in texts.items():
        pieces = [p for p in text.split(".") if p.strip()]
        want = [i for i, p in enumerate(pieces) if "zorkling" in p or "vexxut" in p]
        assert [r.sentence for r in marked.get(doc, [])] == want
        assert all(r.text == pieces[r.sentence] for r in marked.get(doc, []))
    assert {r.doc_id for r in T.reject(docs, model).collect()} == {d for d in texts if d % 4}


def test_noisy_or_by_hand():
    """A word of weight log 3 at a plain rate of a half: clean with 1/4 against 1/2, so it scores a half."""
    model = T.Model(np.zeros(1 << T.BITS), 0.0, leak=0.2)
    hasher = T.Hasher()
    model.weight[hasher.rows[hasher([b"bad"])[0]][0]] = np.log(3)
    got = model.documents([b"a b. c d. ... e", b"", b"bad", b"bad x. y. bad", b"fine. " * 30_000], model.hasher())
    assert np.allclose(got, [0.2, 0.2, 1 - 0.8 / 2, 1 - 0.8 / 4, 0.2])


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_length_alone_is_not_toxic(spark, sf):
    """Twenty thousand sentences of clean texts, without and with one that offends; models of both scales."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = T.train(docs, labels)
    known = {r.doc_id: r.toxic for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.where("length(text) > 200").collect() if r.doc_id in known}
    spots = [r for r in T.offending(docs.where("length(text) > 200"), model, 0.8).limit(500).collect() if known.get(r.doc_id) == 1]
    score = dict(zip(texts, model.documents([t.encode() for t in texts.values()], model.hasher())))
    clean = [t for d, t in sorted(texts.items()) if known[d] == 0 and score[d] < 0.2]
    assert len(clean) > 0.95 * sum(known[d] == 0 for d in texts)
    sentences = [x for t in clean for x in t.replace("\n", " ").split(".") if x.strip()]
    long = ". ".join((sentences * (20_000 // len(sentences) + 1))[:20_000])
    simple = "some words. " * 20_000
    offence = spots[0].text
    got = model.documents([x.encode() for x in (long, simple, long + ". " + offence, simple + offence)], model.hasher())
    assert (got[:2] < 0.5).all() and (got[2:] >= 0.5).all()


def test_odd_rows(spark, made):
    model = T.train(*made)
    rows = [(None, "zorkling you", "x"), (1, None, "x"), (2, "", "x"), (3, "fine words", "x"), (3, "fine words", "x"), (4, "plain. " * 4000 + "zorklingen you", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    assert got[1] == got[2] < 0.1 and got[None] >= 0.5 > got[3] and got[4] >= 0.5
    kept = T.reject(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 3]


def test_no_or_contrary_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    for rows in ([], [(1, 0)], [(1, 1), (1, 0)], [(None, 1), (2, None), (1, 7)]):
        model = T.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert [r.score for r in T.score(docs, model).collect()] == [0.0, 0.0]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert T.score(empty, model).collect() == [] and T.offending(empty, model).collect() == []


def test_long_texts_are_trained_on_whole(spark):
    """The model is that of all sentences, also of texts with thousands of them."""
    plain = "some plain words. " * 1500
    rows = [(i, plain + ("zorkling you. " if i % 4 == 0 else "") + plain * (i % 3), int(i % 4 == 0)) for i in range(48)]
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = T.train(made.select("doc_id", "text"), made.select("doc_id", "toxic"))
    hasher = T.Hasher()
    word, sentence, of_text = T.split([t.encode() for _, t, _ in rows], hasher)
    numbers, sentence = T.expand(word, sentence, hasher)
    use = np.isin(numbers, np.flatnonzero(model.weight))
    want = T.fit(numbers[use], sentence[use], of_text, np.array([y for *_, y in rows]))
    assert use.any() and np.allclose(model.weight, want.weight, rtol=1e-4) and np.isclose(model.bias, want.bias, rtol=1e-4)


def test_sample_holds_rare_words(spark):
    """Ten words that stand in four toxic documents each, among 16,000 labelled rows."""
    rare = [f"rare{chr(97 + k)}" for k in range(10)]
    rows = [(i, f"plain words. {rare[i // 40]} here" if i < 400 and i % 10 == 0 else f"plain words {i % 7}", int(i % 10 == 0)) for i in range(16_000)]
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = T.train(made.select("doc_id", "text"), made.select("doc_id", "toxic"))
    hasher = model.hasher()
    found = hasher([w.encode() for w in rare])
    assert hasher.weighs[found].all()


def test_query(spark):
    got = T.op10_toxicity(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    right = [(rows[d].predicted == y) for d, y in labels.items()]
    assert sum(right) > 0.93 * len(right)
