"""Ids that are no whole numbers: the same results as with whole ids of the same order."""

import pytest
from pyspark.sql import functions as F

from linewright.llm import decontaminate, pieces, simhash, substring, tokens, toxicity

SF = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"w{k}" for k in range(60))


def url(i):
    return None if i is None else f"https://a.example/{i:06d}"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    more = [(None, "no id, " + PASSAGE), (None, "again " + PASSAGE), (900_001, PASSAGE + " end"), (900_001, PASSAGE + " end"), (900_002, None), (900_003, "")]
    whole = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string")).repartition(3).cache()
    return whole, whole.withColumn("doc_id", F.format_string("https://a.example/%06d", "doc_id")).withColumn("doc_id", F.when(~F.col("doc_id").endswith("null"), F.col("doc_id"))).cache()


def seen(df, ids=(), to=lambda x: x):
    return sorted(str(tuple(to(r[c]) if c in ids else r[c] for c in df.columns)) for r in df.collect())


def test_same_by_any_id(spark, tables):
    whole, named = tables
    bench, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "labels"))
    model = toxicity.train(whole, labels)
    operators = {
        "near_duplicates": (simhash.near_duplicates, ("doc_id", "component_id")),
        "keep_one": (simhash.keep_one, ("doc_id",)),
        "spans": (substring.repeated_spans, ("doc_id", "from_doc_id")),
        "dedup": (substring.dedup, ("doc_id",)),
        "contamination": (lambda d: decontaminate.contamination(d, bench), ("doc_id",)),
        "matches": (lambda d: decontaminate.matches(d, bench), ("doc_id",)),
        "decontaminate": (lambda d: decontaminate.decontaminate(d, bench), ("doc_id",)),
        "score": (lambda d: toxicity.score(d, model), ("doc_id",)),
        "offending": (lambda d: toxicity.offending(d, model), ("doc_id",)),
        "reject": (lambda d: toxicity.reject(d, model), ("doc_id",)),
        "tokens": (lambda d: tokens.token_counts(d).select("doc_id", "n_tokens"), ("doc_id",)),
        "pieces": (lambda d: pieces.encode(d, dropout=0), ("doc_id",)),
    }
    for name, (operator, ids) in operators.items():
        a, b = operator(whole), operator(named)
        assert a.columns == b.columns and dict(b.dtypes)["doc_id"] == "string", name
        assert seen(a, ids, url) == seen(b), name
    drawn = pieces.encode(named)
    back = pieces.decode_ids(drawn)
    assert seen(back) == seen(named.select("doc_id", "text"))


def test_train_by_any_id(spark, tables):
    whole, named = tables
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    own = labels.withColumn("doc_id", F.format_string("https://a.example/%06d", "doc_id"))
    a, b = toxicity.score(whole, toxicity.train(whole, labels)), toxicity.score(named, toxicity.train(named, own))
    assert seen(a, ("doc_id",), url) == seen(b)


def test_no_rows_and_other_types(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id string, text string")).collect() == []
    rows = spark.createDataFrame([(2.5, "a b c"), (1.5, "a b c"), (None, "x y z q")], "doc_id double, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(rows).collect()} == {(2.5, 1.5), (1.5, 1.5), (None, None)}


def test_clashing_names(spark):
    rows = [(1, PASSAGE, 77, "p", 5), (2, "new " + PASSAGE, 78, "q", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key long, __hash string, __places int")
    out = {r.doc_id: tuple(r) for r in substring.dedup(docs).collect()}
    assert out == {1: rows[0], 2: (2, "new", 78, "q", 6)}
