"""Sources, sinks, gate, manifest and streams on small folders."""

import json

import pytest
from pyspark.sql import functions as F

import linewright as L
from linewright.operators.running import running_count
from linewright.operators.sizing import broadcast_if_small, settle

A8 = 'Player-1,"Src",0x511,0x0,Creature-2,"Dst",0x10a48,0x0'
T = "4/22 05:27:15.478  "
GOOD = T + f'SPELL_HEAL,{A8},1,"X",0x1,9,1,nil,1'
BAD = T + "SWING_DAMAGE,a,b"
BAD_COMBATANT = T + "COMBATANT_INFO,Player-1,1"
FATAL = T + f'SPELL_CAST_FAILED,{A8},1,"X",0x1'
DROPPED = T + f"SPELL_SUMMON,{A8},1"
SHORT = T + f'SPELL_DRAIN,{A8},1,"X",0x1,10'

FILES = {
    "2024_clean.txt": [GOOD, GOOD],
    "2024_one_bad.txt": [GOOD, BAD, GOOD],
    "2024_two_bad.txt": [BAD, GOOD, BAD, GOOD],
    "2024_combatant.txt": [GOOD, BAD_COMBATANT, BAD],
    "2024_fatal.txt": [BAD, GOOD, FATAL],
    "2024_soft.txt": [DROPPED, DROPPED, SHORT, SHORT, GOOD],
    "2024_late_time.txt": ["4/22 99:27:15.478  COMBATANT_INFO,a", GOOD],
}
VERDICTS = {
    "2024_clean.txt": (True, None),
    "2024_one_bad.txt": (True, None),
    "2024_two_bad.txt": (False, 3),
    "2024_combatant.txt": (False, 2),
    "2024_fatal.txt": (False, 3),
    "2024_soft.txt": (True, None),
    "2024_late_time.txt": (False, 1),
}


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "logs"
    source.mkdir()
    for name, texts in FILES.items():
        (source / name).write_text("\n".join(texts) + "\n")
    (source / "other.log").write_text("not read\n")
    return source


@pytest.mark.parametrize("mode", ["whole", "split"])
def test_read_lines(spark, tmp_path, mode):
    (tmp_path / "a.txt").write_bytes(b"one\r\n\r\ntwo\rthree\n   \n\xff\xe2\x82bad")
    got = L.read_lines(spark, str(tmp_path), mode=mode).orderBy("line_no").collect()
    assert [(r.file, r.line_no, r.raw) for r in got] == [
        ("a.txt", 1, "one"), ("a.txt", 3, "two"), ("a.txt", 4, "three"), ("a.txt", 5, "   "),
        ("a.txt", 6, b"\xff\xe2\x82bad".decode("utf-8", "replace")),
    ]
    assert got[0].file_size == (tmp_path / "a.txt").stat().st_size


def test_split_mode_numbers_lines_across_splits(spark, tmp_path):
    texts = [f"line {i} " + "x" * (i % 97) if i % 13 else "" for i in range(1, 4001)]
    (tmp_path / "big.txt").write_text("\n".join(texts))
    (tmp_path / "small.txt").write_text("\n".join(texts[:50]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = L.read_lines(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 10
        got = {(r.file, r.line_no): r.raw for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = {("big.txt", i): t for i, t in enumerate(texts, 1) if t}
    expected |= {("small.txt", i): t for i, t in enumerate(texts[:50], 1) if t}
    assert got == expected


def test_smallest_files(spark, folder):
    got = [r.path.rsplit("/", 1)[1] for r in L.smallest_files(spark, str(folder), 2).collect()]
    sizes = sorted((p.stat().st_size, p.name) for p in folder.glob("*.txt"))
    assert got == [name for _, name in sizes[:2]]


def test_gate(spark, folder):
    events = L.parse_events(L.read_lines(spark, str(folder)))
    status = L.file_status(events)
    assert {r.file: (r.ok, r.reject_line) for r in status.collect()} == VERDICTS
    total = status.agg(F.sum("n_lines"), F.sum(F.expr("n_ok + n_dropped + n_malformed + n_fatal"))).first()
    assert total[0] == total[1] == sum(map(len, FILES.values()))
    strict = {r.file: r.ok for r in L.file_status(events, max_bad_lines=0).collect()}
    assert strict["2024_one_bad.txt"] is False and strict["2024_clean.txt"] is True
    lenient = {r.file: r.ok for r in L.file_status(events, max_bad_lines=5).collect()}
    assert lenient["2024_two_bad.txt"] is True and lenient["2024_fatal.txt"] is False

    kept = L.apply_quarantine(events, status).groupBy("file").count().collect()
    assert {r.file: r["count"] for r in kept} == {
        "2024_clean.txt": 2, "2024_one_bad.txt": 2, "2024_soft.txt": 3,
    }
    summary = L.run_summary(status).first()
    assert (summary.converted, summary.skipped) == (3, 4)
    messages = {r.message: r.n for r in L.error_rollup(status).collect()}
    assert messages["fatal line: list index out of range"] == 1


def test_warnings(spark, folder):
    import hashlib

    events = settle(L.parse_events(L.read_lines(spark, str(folder))))
    warnings = L.warning_lines(L.seen_lines(events, L.file_status(events)))
    raw = f"DRAIN|>= 3 cols|2024_soft.txt|{['10']}"
    wid = hashlib.md5(raw.encode()).hexdigest()[:8]
    grouped = {r.warning_id: r for r in L.parse_warnings(warnings).collect()}
    assert (grouped[wid].n, grouped[wid].first_line, grouped[wid].last_line) == (2, 3, 4)
    numbered = L.warning_occurrence(warnings).where(F.col("warning_id") == wid)
    assert [(r.line_no, r.occurrence) for r in numbered.orderBy("line_no").collect()] == [(3, 1), (4, 2)]


def test_running_count_with_a_hot_key(spark):
    df = spark.range(3000).selectExpr("id * 7 as pos", "if(id % 3 = 0, 'cold' || id % 50, 'hot') as k")
    got = running_count(df, ["k"], "pos", "n", F.floor(F.col("pos") / 100))
    want = df.selectExpr("pos", "k", "row_number() over (partition by k order by pos) as n")
    rows = lambda d: sorted((r.k, r.pos, r.n) for r in d.collect())
    assert rows(got) == rows(want)


def test_broadcast_follows_the_size(spark):
    table = settle(spark.range(1000).selectExpr("cast(id as string) as k"))
    big = spark.range(10)
    plan = lambda small: big.join(small, big.id == small.k)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(broadcast_if_small(table))
    assert "strategy=broadcast" not in plan(broadcast_if_small(table, max_bytes=100))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_convert(spark, folder, tmp_path, fmt):
    out, staged = str(tmp_path / "out"), str(tmp_path / "staged")
    result = L.convert(
        spark, str(folder), staged, out, fmt=fmt, line_hash="blake2s", quality=str(tmp_path / "q")
    )
    assert result.accepted.count() == 7
    assert spark.read.parquet(str(tmp_path / "q" / "file_status")).count() == len(FILES)
    if fmt == "json":
        made = L.read_events(spark, out + "/file=2024_clean")
        assert [r.asDict() for r in made.select("event", "timestamp").distinct().collect()] == [
            {"event": "SPELL_HEAL", "timestamp": 1713763635.478}
        ]
        assert made.where("lh is not null").count() == 2
        source = L.parse_header(L.read_lines(spark, str(folder))).selectExpr("unix_micros(event_time) as micros")
        assert L.reconcile_summary(source, L.timestamps(made), "micros").first().asDict() == {
            "missing_left": 0, "missing_right": 0, "equal": True,
        }
    else:
        assert spark.read.parquet(out).where("file = '2024_soft.txt'").count() == 3


def test_convert_smallest(spark, folder, tmp_path):
    result = L.convert(
        spark, str(folder), str(tmp_path / "s"), str(tmp_path / "o"), smallest_n=2, mode="whole"
    )
    assert result.status.count() == 2


def test_json_array_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"timestamp": 1.5, "event": "X"}, {"timestamp": 2.0}]))
    got = L.timestamps(L.read_events(spark, str(tmp_path), array_files=True))
    assert sorted(r.micros for r in got.collect()) == [1500000, 2000000]


LISTING = """<?xml version='1.0' encoding='UTF-8'?><ListBucketResult><Name>logs</Name>
<Contents><Key>0000032d4670450f735dbde7d1fd0c3b</Key><Size>3408912</Size></Contents>
<Contents><Key>00000948a8751f20ef7405c3b3bec537</Key><Size>344519</Size></Contents></ListBucketResult>"""


def test_ingest(spark, tmp_path):
    first, second = "0000032d4670450f735dbde7d1fd0c3b", "00000948a8751f20ef7405c3b3bec537"
    (tmp_path / "page.xml").write_text(LISTING)
    keys = L.read_listing(spark, str(tmp_path / "page.xml"))
    assert sorted(r.key for r in keys.collect()) == [first, second]
    manifest = str(tmp_path / "manifest")
    assert L.read_manifest(spark, manifest).count() == 0
    one = keys.where(F.col("key") == first)
    assert L.update_manifest(spark, manifest, one) is True
    assert L.update_manifest(spark, manifest, one) is False
    fresh = L.new_keys(keys, L.read_manifest(spark, manifest), "http://h/x/")
    assert [(r.key, r.url) for r in fresh.collect()] == [(second, f"http://h/x/{second}")]
    assert L.update_manifest(spark, manifest, keys) is True
    assert [r.key for r in L.read_manifest(spark, manifest).orderBy("key").collect()] == [first, second]
    for text, expected in [('["b", "a"]', ["a", "b"]), ("{}", []), ("[1", []), ("3", [])]:
        (tmp_path / "m.json").write_text(text)
        got = L.read_manifest(spark, str(tmp_path / "m.json"))
        assert sorted(r.key for r in got.collect()) == expected


def test_streams_equal_batch(spark, folder, tmp_path):
    batch = L.parse_events(L.read_lines(spark, str(folder), mode="whole"))
    stream = L.stream_events(spark, str(folder), max_files=2)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    name = F.element_at(F.split("file", "/"), -1)

    def run():
        L.start_gated(stream, out, check).awaitTermination()
        L.start_verdicts(spark, out, check + "-gate").awaitTermination()
        return L.read_gated(spark, out).select(name.alias("file"), "raw", "event")

    want = L.apply_quarantine(batch, L.file_status(batch)).select("file", "raw", "event")
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(run()) == rows(want)

    (folder / "2024_new.txt").write_text(GOOD + "\n")
    assert len(rows(run())) == want.count() + 1

    profile = L.stream_profile(spark, str(folder))
    query = (
        profile.writeStream.outputMode("complete").format("memory").queryName("profile_now")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    expected = L.event_profile(L.parse_header(L.read_lines(spark, str(folder))))
    assert rows(spark.table("profile_now")) == rows(expected)


def test_plans(spark, folder):
    """The gate aggregates before it shuffles, and prunes what a query does not read."""
    lines = L.read_lines(spark, str(folder), mode="whole")
    profile = L.event_profile(L.parse_header(lines))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert "make_timestamp" not in plan.lower()
    picked = L.parse_events(lines).select("event", "n_fields")
    plan = picked._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "damage" not in plan


def test_pages(spark):
    html = '<h1 class="t">Fire <b>Ball</b></h1><span class="strength"> 1.5</span><span class="a agility b">x</span>'
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id int, html string")
    got = [tuple(r) for r in L.extract_page_attributes(pages).orderBy("page_id").collect()]
    assert got == [(1, "Fire Ball", 1.5, None, None), (2, None, None, None, None)]


def test_publishing_loses_nothing(spark, tmp_path):
    """Other runs' logs stay, rejected logs keep older output, empty logs are judged and counted."""
    one, two, out = tmp_path / "one", tmp_path / "two", str(tmp_path / "out")
    one.mkdir(), two.mkdir()
    (one / "2024_a.txt").write_text(GOOD + "\n" + GOOD + "\n")
    (one / "2024_b.txt").write_text(GOOD + "\n")
    (two / "2024_c.txt").write_text(GOOD + "\n")
    (two / "2024_empty.txt").write_text("")
    (two / "2024_blank.txt").write_text("\n\n\n")
    L.convert(spark, str(one), str(tmp_path / "s1"), out)
    second = L.convert(spark, str(two), str(tmp_path / "s2"), out, quality=str(tmp_path / "q"))
    counts = lambda: {r.file: r["count"] for r in spark.read.parquet(out).groupBy("file").count().collect()}
    assert counts() == {"2024_a.txt": 2, "2024_b.txt": 1, "2024_c.txt": 1}
    summary = L.run_summary(second.status).first()
    assert (summary.converted, summary.skipped, summary.n_lines) == (3, 0, 1)
    assert {r.file: (r.ok, r.n_lines) for r in second.status.collect()}["2024_empty.txt"] == (True, 0)
    assert spark.read.parquet(str(tmp_path / "q" / "skipped_lines")).count() == 0
    (one / "2024_a.txt").write_text("no log line\nnor this\n")
    (one / "2024_b.txt").write_text((GOOD + "\n") * 3)
    third = L.convert(spark, str(one), str(tmp_path / "s3"), out)
    assert counts() == {"2024_a.txt": 2, "2024_b.txt": 3, "2024_c.txt": 1}
    assert [r.file for r in L.rejections(third.status).collect()] == ["2024_a.txt"]


def test_equal_names_in_two_folders(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "2024_same.txt").write_text(GOOD + "\n")
    folders = [str(tmp_path / n) for n in ("x", "y")]
    with pytest.raises(ValueError, match="equal name"):
        L.convert(spark, folders, str(tmp_path / "s"), str(tmp_path / "o"))
    result = L.convert(spark, folders, str(tmp_path / "s"), str(tmp_path / "o"), by_path=True)
    assert result.status.count() == 2 and result.accepted.count() == 2


def test_byte_order_mark_in_every_mode(spark, tmp_path):
    (tmp_path / "2024_bom.txt").write_bytes(b"\xef\xbb\xbf" + GOOD.encode() + b"\n" + GOOD.encode())
    read = lambda mode: sorted((r.line_no, r.raw) for r in L.read_lines(spark, str(tmp_path), mode=mode).collect())
    assert read("whole") == read("split") == [(1, GOOD), (2, GOOD)]
    L.start_gated(L.stream_events(spark, str(tmp_path)), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o" / "data")).where("status = 'ok'").count() == 2


def test_own_prefix_takes_own_suffixes():
    registry = L.RouteRegistry().add_suffix("_WAVE", "aura").add_prefix("PET", "spell")
    assert registry.entries["PET_WAVE"] == ("table", "spell", "aura")
    assert registry.add_suffix("_GLOW", "aura").entries["PET_GLOW"] == ("table", "spell", "aura")
    with pytest.raises(ValueError):
        registry.add_prefix("PET", "line")


def test_entities_of_pages(spark):
    """Names as HTML has them: all of them, with digits, old ones without a semicolon."""
    import html

    texts = [
        "caf&eacute; &uuml;&trade;", "&frac12; &sup2;", "A &amp B", "&ampB &copyright; &notit; &notin;", "&amp;lt; &lt", "&#62 &#x3e;&#233", "&nosuch; &nosuch & &;",
        "&NotEqualTilde; &apos;&bsol;&dollar;&lcub;", "&Eacute &apos x",
    ]
    pages = spark.createDataFrame([(i, f"<h1>{t}</h1>") for i, t in enumerate(texts)], "page_id int, html string")
    got = {r.page_id: r.name for r in L.extract_page_attributes(pages).collect()}
    assert got == {i: html.unescape(t) for i, t in enumerate(texts)}
