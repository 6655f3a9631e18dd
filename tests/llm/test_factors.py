"""The factorisation machine: its identity, its held-out accuracy, and defined results."""

import random

import numpy as np
import pytest

from linewright.llm.factors import Machine, Reader, constant, fit, held_out, op11_quality_classifier, score, telling, train

SF = "/root/testdata/sf0.01"


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = Machine(0.3, rng.normal(size=32), rng.normal(size=(32, 5)), 5)
    row, number, value = [], [], []
    for k in range(6):
        some = np.sort(rng.choice(32, rng.integers(0, 9), replace=False))
        row += [k] * len(some)
        number += some.tolist()
        value += rng.random(len(some)).tolist()
    row, number, value = np.array(row), np.array(number), np.array(value)
    want = []
    for k in range(6):
        n, x = number[row == k], value[row == k]
        pairs = sum(m.vectors[n[i]] @ m.vectors[n[j]] * x[i] * x[j] for i in range(len(n)) for j in range(i))
        want.append(0.3 + m.weight[n] @ x + pairs)
    assert np.allclose(m.logits(row, number, value, 6), want)


def test_interactions_are_learned():
    """The label is whether exactly one of two features is there: no linear model can tell."""
    rng = np.random.default_rng(1)
    sets = [[0] * bool(k & 1) + [1] * bool(k & 2) + [2] for k in rng.integers(0, 4, 1200)]
    label = np.array([float((0 in s) != (1 in s)) for s in sets])
    row, number = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    m = fit(row, number, np.ones(len(row)), label, bits=2, epochs=40)
    logits = m.logits(row, number, np.ones(len(row)), len(sets))
    assert ((logits > 0) == (label == 1)).mean() > 0.97


def test_held_out_accuracy(spark):
    got = op11_quality_classifier(spark, SF).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    x = got.merge(labels, on="doc_id")
    x = x[x.held_out]
    good, bad = x[x.quality == 1], x[x.quality == 0]
    assert (good.score.to_numpy()[:, None] > bad.score.to_numpy()[None, :]).mean() > 0.97
    assert (x.predicted == x.quality).mean() > 0.9


def test_same_machine_from_rows_in_any_order(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").limit(200), spark.read.parquet(f"{SF}/labels.parquet")
    a = train(docs, labels)
    b = train(docs.orderBy("text").repartition(3), labels.orderBy("quality"))
    assert a.bias == b.bias and (a.weight == b.weight).all() and (a.vectors == b.vectors).all()


def test_strange_rows(spark):
    rng = random.Random(0)
    text = lambda good: " ".join(rng.choice(["calm", "river", "stone"] if good else ["BUY!!", "NOW!!", "$$$"]) for _ in range(30))
    rows = [(f"u{k}", text(k % 2), None if k % 5 == 0 else "7", "x", 1.0) for k in range(80)]
    rows += [(None, None, None, None, None), (None, "", "0", "", 0.0), ("u1", rows[1][1], "7", "x", 1.0), ("long", "calm river " * 200_000, "12", "", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n_chars string, label string, score double")
    labels = spark.createDataFrame([(f"u{k}", k % 2) for k in range(80)] + [("u1", 1), ("u2", 1), ("u3", None), (None, 1), ("long", 5)], "doc_id string, quality int")
    m = train(docs, labels)
    got = score(docs, m).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got if r.doc_id}
    assert by["u1"] > 0.5 > by["u4"] and by["long"] > 0.5
    assert sorted(r.doc_id for r in got if r.doc_id == "u1") == ["u1", "u1"]
    assert [r.held_out for r in docs.where("doc_id is null").select(held_out().alias("held_out")).collect()] == [False, False]


@pytest.mark.parametrize("labels,want", [([], 0.0), ([("a", 1)], 1.0), ([("a", 0)], 0.0), ([("a", 0), ("a", 1)], 0.0)])
def test_one_kind_of_label(spark, labels, want):
    docs = spark.createDataFrame([("a", "some text"), ("b", None)], "doc_id string, text string")
    m = train(docs, spark.createDataFrame(labels, "doc_id string, quality int"))
    assert [r.score for r in score(docs, m).collect()] == pytest.approx([want] * 2)
    assert score(docs.limit(0), m).collect() == []


def test_parts():
    assert constant(0.5).scores([b"x", b""], [1, None], Reader()).tolist() == [0.5, 0.5]
    assert telling(np.array([9, 5, 0, 2]), np.array([0, 5, 9, 0]), 10, 10, 2).tolist() == [0, 2]
