"""The corpus pipeline stage by stage against brute-force versions."""

import corpus_pipeline as C
from linewright.llm import pieces, toxicity

from . import test_decontaminate as bench
from . import test_simhash as near
from . import test_substring as sub

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = {}
    for name, stage in C.STAGES[:-1]:
        result = C.settle(stage(spark, docs, SF), name)
        assert result.columns == docs.columns
        out[name], before, docs = rows(result), rows(docs), result
        if name == "toxicity":
            scores = {r.doc_id: r.score for r in toxicity.score(spark.read.parquet(f"{SF}/documents.parquet"), toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)).collect()}
            assert out[name] == {d: t for d, t in before.items() if scores[d] < 0.5}
        elif name == "near_duplicates":
            first = near.brute_keep(list(before.items()))
            assert out[name] == {d: t for d, t in before.items() if d in first}
        elif name == "substrings":
            want = {d: (k.decode() if g else before[d]) for d, _, g, k in sub.brute(list(before.items()), 20) if k or not g}
            assert out[name] == want
        else:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            dirty = {d for d, _, hit, _ in bench.brute(list(before.items()), items) if hit}
            assert out[name] == {d: t for d, t in before.items() if d not in dirty}
    last = C.run(spark, SF)
    model = pieces.Model()
    got = last.collect()
    assert {r.doc_id: pieces.decode(model, pieces.np.array(r.ids, int)).decode() for r in got} == out["benchmark"]
    assert all(r.lossless for r in got)


def test_empty_and_odd(spark, tmp_path):
    for name, schema in (("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    odd = [(None, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "a b", None, None, None), (2, "a b", None, None, None), (3, "w " * 3000, "en", "s", 6000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in ([], odd):
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        got = C.run(spark, str(tmp_path)).collect()
        assert sorted(str(r.doc_id) for r in got) == (["2", "3", "None"] if data else [])
