"""Hard negatives against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linewright.llm.negatives import first, mine, prepare, products

SCHEMA = "vec_id long, embedding array<float>, label int, score string, key string"


@pytest.mark.parametrize("top", [0, 1, 200, 2**20, 2**33, 2**62])
def test_products_are_exact(top):
    rng = random.Random(top)
    make = lambda n: [[rng.randint(-top, top) for _ in range(7)] for _ in range(n)]
    a, c = make(5), make(13)
    want = [[max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(p, q)))) for q in c] for p in a]
    assert products(np.array(a, np.int64), np.array(c, np.int64)).tolist() == want


def test_products_of_nothing():
    none = np.zeros((0, 3), np.int64)
    assert products(none, none).shape == (0, 0) and products(np.zeros((2, 0), np.int64), np.zeros((3, 0), np.int64)).tolist() == [[0] * 3] * 2


def test_first_prefers_earlier_ties():
    assert first(np.array([3, 5, 5, 1, 5, 3]), 4).tolist() == [1, 2, 4, 0]
    assert first(np.array([-(2**63), 2**63 - 1]), 3).tolist() == [1, 0]


def brute(rows, n_positive=5, n_negative=10):
    """anchor, positive, rank, negative and scores, straight from the contract."""
    live = []
    for i, vec, label, *_ in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        live.append((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in vec)))
    live = list(dict.fromkeys(live))
    out = []
    for a in live:
        if a[0] % 100:
            continue
        score = lambda r: sum(x * y for x, y in zip(a[2], r[2]))
        best = sorted((r for r in live if r is not a and r[1] == a[1]), key=lambda r: (-score(r), r[0]))[:n_positive]
        for p in best:
            fits = [r for r in live if r[1] != a[1] and 30 * score(p) <= 100 * score(r) <= 90 * score(p)]
            for rank, r in enumerate(sorted(fits, key=lambda r: (-score(r), r[0]))[:n_negative], 1):
                out.append((a[0], p[0], rank, r[0], score(p), score(r)))
    return sorted(out)


def mined(df, **sizes):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = mine(prepare(df, label), F.col("id") % 100 == 0, **sizes)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


@pytest.mark.parametrize("sizes", [{}, {"block": 2, "part": 16}])
def test_against_brute_force(spark, sizes):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 0.5) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(-100, 420):
        k = rng.randrange(4)
        vec = [x + rng.gauss(0, 0.4) for x in centres[k]] if i % 3 else centres[0]  # a third of all rows are alike
        rows.append((i, vec, k if rng.random() < 0.7 else rng.randrange(10), "x", "y"))
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 1, "", ""), (600, [1.0, None], 1, "", ""), (601, [nan], 1, "", ""), (602, [inf, 1.0], 2, None, None), (603, [1.0], None, "", ""), (None, [1.0] * 6, 1, "", "")]
    rows += [(604, [], 2, "", ""), (605, [0.3], 3, "", ""), (606, [0.2] * 8, 3, "", ""), *rows[:5]]
    got = mined(spark.createDataFrame(rows, SCHEMA), **sizes)
    assert got == brute(rows) and len(got) > 100


def test_too_few_rows(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(0, [1.0], 1, "", "")], SCHEMA)) == []
    assert mined(spark.createDataFrame([(100, [1.0], 1, "", ""), (3, [1.0], 1, "", ""), (4, [0.5], 2, "", "")], SCHEMA)) == [(100, 3, 1, 4, 65536, 32768)]


def test_rows_of_one_id(spark):
    """Rows that share an id are rows of their own; the one equal in all counts once."""
    rows = [(100, [1.0], 1, "", ""), (100, [0.5], 1, "", ""), (100, [1.0], 1, "", ""), (5, [0.4], 2, "", "")]
    got = mined(spark.createDataFrame(rows, SCHEMA))
    # floor(256 * 0.4) = 102; both rows are an anchor and the other's positive.
    assert got == [(100, 100, 1, 5, 32768, 13056), (100, 100, 1, 5, 32768, 26112)]
