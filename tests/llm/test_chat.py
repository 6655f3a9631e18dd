"""Chat formatting: folds by hand, exact round trips, and the SQL answer."""

import random

import duckdb

from linewright.llm import chat as C
from linewright.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, seq long, kind string, role string, text string"


def told(spark, events):
    out = C.read(C.render(C.fold(spark.createDataFrame(events, SCHEMA)))).collect()
    return {r.conv_id: [(t.role, t.text, t.loss) for t in r.turns] for r in out}


def test_deltas_edits_regenerations(spark):
    events = [
        (1, 0, 0, "message", "user", "Hi"), (1, 1, 1, "message", "assistant", "He"), (1, 1, 2, "delta", "assistant", "ll"), (1, 1, 3, "delta", "assistant", "o"),
        (2, 0, 0, "message", "user", "Q"), (2, 1, 1, "message", "assistant", "bad"), (2, 1, 2, "delta", "assistant", " answer"), (2, 1, 3, "regenerate", "assistant", "good"), (2, 1, 4, "delta", "assistant", " one"),
        (3, 0, 0, "message", "user", "old"), (3, 1, 1, "message", "assistant", "to old"), (3, 2, 2, "message", "user", "more"), (3, 0, 3, "edit", "user", "new"), (3, 1, 4, "message", "assistant", "to new"),
    ]
    random.Random(1).shuffle(events)
    assert told(spark, events) == {
        1: [("user", "Hi", False), ("assistant", "Hello", True)],
        2: [("user", "Q", False), ("assistant", "good one", True)],
        3: [("user", "new", False), ("assistant", "to new", True)],
    }


def test_hostile_texts_come_back(spark):
    rng = random.Random(4)
    parts = [C.OPEN, C.MIDDLE, C.LOSS, C.CLOSE, "\\", "\\0", "\\1", "\\5", "<s>", "</s>", "[INST]", "[/INST]", "[TEXT]", " ", "\n", "x", "é", "🎉", "<", "s>", "0"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(300)]
    events = [(i // 5, i % 5, i, "message", rng.choice(["user", "assistant", "system", t[:6]]), t) for i, t in enumerate(texts)]
    got = told(spark, events)
    for c, turns in got.items():
        assert turns == [(r, t, r == "assistant") for cc, _, _, _, r, t in events if cc == c]


def test_odd_rows(spark):
    events = [(None, None, None, None, None, None), (None, 0, 0, "message", "user", None), (1, 0, 0, "delta", "user", "only a delta"), (2, 0, 0, "message", "user", "twice"), (2, 0, 0, "message", "user", "twice"), (3, 0, 0, "message", "user", "w " * 30_000)]
    got = told(spark, events)
    assert got == {None: [("", "", False), ("user", "", False)], 1: [("user", "only a delta", False)], 2: [("user", "twice", False)] * 2, 3: [("user", "w " * 30_000, False)]}
    assert told(spark, events[:0]) == {}


def test_query_is_the_sql_answer(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        c = duckdb.connect()
        c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
        cursor = c.execute(ORACLES["op1_chat"])
        names = [d[0] for d in cursor.description]
        want = sorted(map(tuple, cursor.fetchall()))
        got = QUERIES["op1_chat"](spark, sf)
        assert got.columns == names
        assert sorted(map(tuple, got.collect())) == want


def test_streamed_log_folds_to_its_rows(spark):
    """Deltas, edits, regenerations and stale answers, told backwards; nulls, ties, repeated rows, gaps and a long conversation."""
    rng = random.Random(7)
    rows = [(1, 0, "user", "ask"), (1, 1, "assistant", "tell"), (1, 5, "user", "last"), (2, None, None, None), (2, -1, "user", ""), (2, 0, "assistant", "é🎉x"), (2, 0, "assistant", "é🎉x"), (2, 0, "user", "b"), (None, 3, "assistant", "</s>"), (3, 1 << 39, "system", "far")]
    rows += [(4, i, rng.choice(["user", "assistant"]), "x" * rng.randint(0, 7) + str(i)) for i in range(9000)]
    log = C.streamed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in C.read(C.render(C.fold(log))).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    assert got == {c: [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=key)] for c in (1, 2, 3, 4, None)}
