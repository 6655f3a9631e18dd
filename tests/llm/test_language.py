"""Language ID: held-out accuracy, each kind of evidence by itself, odd rows."""

import re
import zlib

import numpy as np

from linewright.llm import language as L


def truth(spark, sf):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    return {r.page_id: docs[int(r.url.split("/")[4].split("?")[0].split("#")[0].split(".")[0])] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    want = truth(spark, sf)
    got = L.op3_language(spark, sf).collect()
    assert len(got) == len(want)
    held = [r for r in got if r.held_out]
    assert len(held) > 30 and sum(r.lang == want[r.page_id] for r in held) >= 0.97 * len(held)
    assert sum(r.text_lang == want[r.page_id] for r in held) >= 0.95 * len(held)
    assert all(0 < r.probability <= 1 for r in got)


EN, FR = "the cat and the dog are in the house with that thing ", "le chat et le chien sont dans la maison avec une chose "


def page(i, url, lang, text):
    return i, url, f"<html{lang and f' lang={lang}'}><script>{EN * 9}</script><body><p>{text}</p></body></html>", "x"


def test_evidence(spark):
    docs = spark.createDataFrame([(EN * 3, "en"), (FR * 3, "fr"), (None, "en"), ("junk", None)], "text string, lang string")
    rows, labels = [], []
    for i in range(60):
        fr = i % 2
        rows.append(page(i, f"http://{'b.fr' if fr else 'a.com'}/{i}", "fr-FR" if fr else "en", (FR if fr else EN) * 2))
        labels.append((i, "fr" if fr else "en"))
    rows += [
        page(100, "http://b.fr/x", "", ""),  # host alone
        page(101, "http://new.fr/x", "", ""),  # suffix alone
        page(102, "http://new.net/x", '"fr"', ""),  # markup alone
        page(103, "http://new.net/x", "", FR),  # text alone
        page(104, "http://b.fr/x", "fr", EN * 20),  # a clear text against the rest
        (105, None, None, "x"), (None, "", "", "x"), (106, "http://a.com/", "<html lang=xx>&amp; no text", "x"), (106, "http://a.com/", "<html lang=xx>&amp; no text", "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, lang string")
    known = spark.createDataFrame([*labels, (100, None), (None, "fr"), (101, "en"), (101, "fr")], "page_id long, lang string")
    out = L.identify(pages, known, docs).collect()
    got = {r.page_id: r for r in out}
    assert len(out) == len(rows)
    assert all(got[i].lang == x for i, x in labels)
    assert [got[i].lang for i in (100, 101, 102, 103)] == ["fr"] * 4 and got[104].lang == "en"
    assert got[102].declared == "fr" and got[102].text_lang is None and got[103].text_lang == "fr"
    assert got[105].probability == got[None].probability and got[105].declared is None


def posterior(model, text, host, said, labelled):
    """P(language) in plain Python; labelled: host, declared, language of every labelled page."""
    names = model.languages
    count = lambda keep: np.array([sum(x[2] == a and bool(keep(x)) for x in labelled) for a in names], float)
    share = (count(lambda x: True) + L.FLAT) / (len(labelled) + L.FLAT * len(names))
    suffix = host.split(".")[-1]
    for keep in (lambda x: x[0] and x[0].split(".")[-1] == suffix, lambda x: x[0] == host):
        n = count(keep)
        if host and n.sum():
            share = (n + L.STRENGTH * share) / (n.sum() + L.STRENGTH)
    logs = np.log(share) + model.score([text.encode()])[0]
    kinds = len({x[1] for x in labelled if x[1]}) + 1
    if said in {x[1] for x in labelled if x[1]}:
        logs += np.log((count(lambda x: x[1] == said) + L.FLAT) / (count(lambda x: True) + L.FLAT * kinds))
    mass = np.exp(logs - logs.max())
    return names[int(logs.argmax())], 1 / mass.sum()


def test_posterior_is_brute_force_and_overrules_short_texts(spark):
    docs = spark.createDataFrame([(EN * 3, "en"), (FR * 3, "fr"), (EN, "en")], "text string, lang string")
    said = {0: "", 1: "fr", 2: "en", 3: "xx"}
    hosts = ["b.fr", "a.com", "c.com", "", "new.fr", "new.net"]
    texts = ["", "house", "maison", "zz", EN, FR * 3]
    rows = [(i, hosts[i % 6] and f"http://{hosts[i % 6]}/{i}", f"<html {said[i // 6 % 4] and 'lang=' + said[i // 6 % 4]}>{texts[i // 24]}</html>") for i in range(144)]
    labels = [(i, "fr" if hosts[i % 6] == "b.fr" or i % 5 == 0 else "en") for i in range(144) if i % 6 < 4]
    seen = [(hosts[i % 6], said[i // 6 % 4], lang) for i, lang in labels]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = L.train_text(docs)
    got = {r.page_id: r for r in L.identify(pages, spark.createDataFrame(labels, "page_id long, lang string"), docs).collect()}
    overruled = 0
    for i, _, _ in rows:
        lang, probability = posterior(model, texts[i // 24], hosts[i % 6], said[i // 6 % 4], seen)
        assert abs(got[i].probability - probability) < 1e-9
        assert got[i].lang == lang or abs(probability - 0.5) < 1e-9
        overruled += got[i].text_lang not in (None, got[i].lang)
    assert overruled > 5
    assert all(got[i].lang == got[i].text_lang for i, _, _ in rows if len(texts[i // 24]) > 50)


def test_held_out_pages_show_unlearnt_documents(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    for r in L.op3_language(spark, sf).select("page_id", "held_out").collect():
        number = re.match(r"[0-9]+", pages[r.page_id].split("/")[4])[0]
        assert r.held_out == (zlib.crc32(number.encode()) % 5 == 0)


def test_nothing_to_learn(spark):
    pages = spark.createDataFrame([page(1, "http://a.com", "en", EN)], "page_id long, url string, html string, x string")
    none = spark.createDataFrame([], "page_id long, lang string")
    assert [r.lang for r in L.identify(pages, none, spark.createDataFrame([], "text string, lang string")).collect()] == [None]
    docs = spark.createDataFrame([(EN, "en"), (FR, "fr")], "text string, lang string")
    assert [r.lang for r in L.identify(pages, none, docs).collect()] == ["en"]
    assert L.identify(pages.limit(0), none, docs).collect() == []


def test_trigrams():
    code, n = L.trigrams([b"ab", b"", b"A b\nab"])
    own = [L.trigrams([x])[0].tolist() for x in (b"ab", b"A b\nab")]
    assert n.tolist() == [2, 0, 4] and code.tolist() == own[0] + own[1]
    assert own[1][2:] == own[0] and len(set(own[0])) == 2 and isinstance(code, np.ndarray)
