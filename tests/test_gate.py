"""Logs by position, the gate as state, publishing once, exact sketches."""

import random

import pytest
from pyspark.sql import functions as F

import linewright as L
from linewright.operators.sketch import member
from tests.test_pipeline import BAD, BAD_COMBATANT, FATAL, FILES, GOOD, VERDICTS


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture
def logs(tmp_path):
    """The usual verdicts, among blank lines, in files of several splits."""
    folder = tmp_path / "logs"
    folder.mkdir()
    rng = random.Random(3)
    for name, texts in FILES.items():
        out = []
        for t in texts:
            out += [GOOD, ""] * rng.randrange(6) + [t] + [""] * rng.randrange(3)
        (folder / name).write_text("\n" * rng.randrange(3) + "\n".join(out) + "\n")
    return folder


def test_positions_give_the_same_verdicts(spark, logs, small_splits):
    numbered = L.parse_events(L.read_lines(spark, str(logs)))
    placed = L.parse_events(L.read_lines(spark, str(logs), mode="position"))
    assert placed.select("split_start").distinct().count() > 3
    assert rows(L.file_status(placed)) == rows(L.file_status(numbered))
    some = placed.where("status in ('malformed', 'fatal')")
    got = L.with_line_numbers(some, placed).select("file", "line_no", "raw")
    assert rows(got) == rows(numbered.where("status in ('malformed', 'fatal')").select("file", "line_no", "raw"))
    status = L.file_status(numbered)
    assert rows(L.skipped_lines(placed, status).select("file", "line_no", "error", "occurrence")) == rows(
        L.skipped_lines(numbered, status).select("file", "line_no", "error", "occurrence")
    )


def test_positions_are_one_scan(spark, logs):
    lines = L.read_lines(spark, str(logs), mode="position")
    text = plan(lines)
    assert text.count("FileScan text") == 1 and "Exchange" not in text and "Join" not in text
    status = L.file_status(L.parse_events(lines))
    assert "value" not in plan(status)


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_membership_is_exact(spark, n):
    inside, outside = [f"bad-{i}" for i in range(n)], [f"good-{i}" for i in range(5000)]
    table = lambda names: spark.createDataFrame([(x,) for x in names], "name string")
    test = member(table(inside), table(outside))
    both = table(inside + outside).select("name", test(F.col("name")).alias("found"))
    assert {r.name for r in both.collect() if r.found} == set(inside)
    assert "Exchange" not in plan(both).split("Subquery")[0]
    assert member(table(inside), table(outside), max_bytes=1) is None or n == 0


def test_quarantine_without_a_join(spark, logs):
    events = L.parse_events(L.read_lines(spark, str(logs), mode="position"))
    status = L.file_status(events)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "0")
    try:
        good = L.accepted_events(events, status)
        main = plan(good).split("Subquery subquery")[0]
        assert "SortMergeJoin" not in main and "Exchange hashpartitioning" not in main and main.count("Join") == plan(events).count("Join")
        want = rows(L.apply_quarantine(events, status).select("file", "raw"))
        assert rows(good.select("file", "raw")) == want
        assert rows(L.accepted_events(events, status, max_bytes=1).select("file", "raw")) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_convert_once(spark, logs, tmp_path, small_splits):
    out, name = str(tmp_path / "out"), F.element_at(F.split("file", "/"), -1).alias("file")
    (logs / "2024_empty.txt").write_text("")
    result = L.convert_once(spark, str(logs), out, quality=str(tmp_path / "q"))
    status = {r.file: (r.ok, r.reject_line is not None) for r in result.status.select(name, "ok", "reject_line").collect()}
    assert status == {k: (ok, not ok) for k, (ok, _) in VERDICTS.items()} | {"2024_empty.txt": (True, False)}
    numbered = L.parse_events(L.read_lines(spark, str(logs)))
    want = L.apply_quarantine(numbered, L.file_status(numbered)).select("file", "raw")
    got = lambda: rows(L.read_published(spark, out).select(name, "raw"))
    assert got() == rows(want)
    assert not [p for p in (tmp_path / "out" / "data").rglob("*") if "file=" in p.name]
    assert len(list((tmp_path / "out" / "data").glob("run=*"))) == 1

    # A log is replaced, another one added, the rest stays; a rejected log keeps its older events.
    clean = logs / "2024_clean.txt"
    more = tmp_path / "more"
    more.mkdir()
    (more / "2024_new.txt").write_text(GOOD + "\n")
    before = len(got())
    L.convert_once(spark, str(more), out, even=True)
    assert len(got()) == before + 1
    n = sum(1 for r in got() if r[0] == "2024_clean.txt")
    clean.write_text((GOOD + "\n") * 40)
    (logs / "2024_one_bad.txt").write_text(BAD + "\n" + BAD + "\n")
    L.convert_once(spark, str(logs), out)
    assert len(got()) == before + 1 - n + 40
    index = {r.file.rsplit("/", 1)[-1]: r.n_ok for r in L.read_index(spark, out).collect()}
    assert index["2024_clean.txt"] == 40 and index["2024_empty.txt"] == 0 and "2024_fatal.txt" not in index


def test_unfinished_run_is_not_seen(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "2024_a.txt").write_text(GOOD + "\n")
    out = str(tmp_path / "out")
    L.convert_once(spark, str(tmp_path / "l"), out)
    lost = spark.read.parquet(out + "/data").drop("run")
    lost.write.partitionBy("day").parquet(out + "/data/run=9999")  # no index was written
    assert L.read_published(spark, out).count() == 1


def take_in(spark, source, out, log="file", **options):
    stream = L.stream_events(spark, str(source), **options)
    L.start_gated(stream, out, out + "-c1", log=log, source=str(source)).awaitTermination()
    L.start_verdicts(spark, out, out + "-c2").awaitTermination()
    return {r.log.rsplit("/", 2)[-2] + "/" + r.log.rsplit("/", 1)[-1]: (r.ok, r.reject_line, r.n_lines, r.pieces) for r in L.read_verdicts(spark, out).collect()}


def test_equal_names_and_empty_logs_on_a_stream(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "2024_same.txt").write_text(f"{GOOD}\n{BAD}\n")
    (tmp_path / "in" / "y" / "2024_empty.txt").write_text("")
    out = str(tmp_path / "out")
    want = {"x/2024_same.txt": (True, None, 2, 1), "y/2024_same.txt": (True, None, 2, 1), "y/2024_empty.txt": (True, None, 0, 1)}
    assert take_in(spark, tmp_path / "in", out, max_files=1) == want
    assert L.read_gated(spark, out).count() == 2
    (tmp_path / "in" / "x" / "2024_late.txt").write_text(f"{FATAL}\n{GOOD}\n")
    assert take_in(spark, tmp_path / "in", out) == want | {"x/2024_late.txt": (False, 1, 2, 1)}
    assert L.read_gated(spark, out).count() == 2


@pytest.mark.parametrize("last,verdict", [(GOOD, (True, None)), (BAD, (False, 7)), (FATAL, (False, 7)), (BAD_COMBATANT, (False, 7))])
def test_log_in_pieces_is_judged_as_one(spark, tmp_path, last, verdict):
    """Three batches; the second fault comes in the third, and its number counts all lines."""
    source, out = tmp_path / "in" / "f", str(tmp_path / "out")
    source.mkdir(parents=True)
    pieces = [[GOOD, "", BAD], [GOOD, GOOD], [GOOD, last, GOOD]]
    log = "regexp_replace(file, '[.]part[0-9]+[.]txt$', '')"
    for k, texts in enumerate(pieces):
        (source / f"2024_a.part{k}.txt").write_text("\n".join(texts) + "\n")
        got = take_in(spark, source.parent, out, log)
        assert got["f/2024_a"] == ((True, None) if k < 2 else verdict) + ([2, 4, 7][k], k + 1)
        assert L.read_gated(spark, out).count() == ([1, 3, 5 if last == GOOD else 0][k] + (last == GOOD and k == 2))
    whole = tmp_path / "whole"
    whole.mkdir()
    (whole / "2024_a.txt").write_text("\n".join(t for p in pieces for t in p) + "\n")
    batch = L.file_status(L.parse_events(L.read_lines(spark, str(whole)))).first()
    assert (batch.ok, batch.reject_line) == verdict


def test_large_log_streams_in_several_tasks(spark, tmp_path, small_splits):
    source, out = tmp_path / "in" / "f", str(tmp_path / "out")
    source.mkdir(parents=True)
    (source / "2024_big.txt").write_text("\n".join([GOOD] * 30 + ["", BAD] + [GOOD] * 30 + [BAD] + [GOOD] * 9) + "\n")
    assert take_in(spark, source.parent, out)["f/2024_big.txt"] == (False, 63, 71, 1)
    data = spark.read.parquet(out + "/data")
    assert data.select("split_start").distinct().count() > 5 and len(list((tmp_path / "out" / "data" / "batch=0").glob("*.parquet"))) > 3


def test_profile_goes_on_after_a_restart(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "p"), str(tmp_path / "c")
    source.mkdir()
    for k, texts in enumerate([[GOOD, BAD], [GOOD, FATAL, ""], [BAD]]):
        (source / f"2024_{k}.txt").write_text("\n".join(texts) + "\n")
        L.start_profile(spark, str(source), out, check).awaitTermination()
        want = L.event_profile(L.parse_header(L.read_lines(spark, str(source))))
        assert rows(L.read_profile(spark, out)) == rows(want)


def test_manifest_grows_by_what_is_new(spark, tmp_path):
    """An update writes the new keys alone; writers at once and a compaction meanwhile lose nothing."""
    from linewright.sources import keys as K

    path = str(tmp_path / "m")
    table = lambda names: spark.createDataFrame([(n,) for n in names], "key string")
    many = [f"{i:032x}" for i in range(20_000)]
    read = lambda: sorted(r.key for r in L.read_manifest(spark, path).collect())
    size = lambda d: sum(p.stat().st_size for p in d.rglob("*.parquet"))
    assert L.update_manifest(spark, path, table(many)) and not L.update_manifest(spark, path, table(many[:9]))
    assert L.update_manifest(spark, path, table([*many[:5], "new"]))
    first, second = sorted((tmp_path / "m").glob("delta-*"))
    assert size(second) < size(first) / 50 and read() == sorted([*many, "new"])

    # Two writers that both saw the manifest before the other's delta.
    for name in ("a", "b"):
        table([name, "both"]).write.parquet(f"{path}/delta-9{name}")
    (tmp_path / "m" / "delta-9c").mkdir()  # a writer that was lost before its end
    assert sorted(set(read())) == sorted([*many, "new", "a", "b", "both"])
    base, deltas = K._parts(spark, path)
    assert base is None and len(deltas) == 4
    assert L.compact_manifest(spark, path) and not L.compact_manifest(spark, path)
    assert read() == sorted([*many, "new", "a", "b", "both"])
    table(["late"]).write.parquet(f"{path}/delta-0late")  # sorts before the merged ones
    assert read() == sorted([*many, "new", "a", "b", "both", "late"])
    assert L.compact_manifest(spark, path, buckets=2) and read() == sorted([*many, "new", "a", "b", "both", "late"])


def test_reconcile_by_digest(spark):
    day = 86_400_000_000
    table = lambda values: spark.createDataFrame([(v,) for v in values], "micros bigint")
    a = [k * day // 4 for k in range(-40, 400)]
    for b in (a, a[::-1], a + a[:3], a[5:], [*a, 7], [], [None, *a]):
        left, right = table(a), table(b)
        assert rows(L.reconcile_by_digest(left, right, "micros")) == rows(L.reconcile(left, right, "micros"))
    same = L.reconcile_by_digest(table(a), table(a[::-1]), "micros")
    assert "Exchange" not in plan(same) and "Scan" not in plan(same).replace("LocalTableScan", "")
    assert L.differing_days(table([*a, None]), table([*a, 5 * day + 1]), "micros").collect() == [(5, 4, 5)]
    logs = spark.createDataFrame([(None, 1), ("x", 1), ("y", 2)], "log string, micros bigint")
    assert rows(L.differing_days(logs, logs.where("log = 'x'"), "micros", ["log"])) == [("y", 0, 1, 0), (None, 0, 1, 0)]


def test_every_family_comes_back(spark):
    """Members, absent or null, of events that the contract's logs do not hold."""
    a8 = 'Player-1,"Src",0x511,0x0,Creature-2,"Dst",0x10a48,0x0'
    texts = [
        f'DAMAGE_SHIELD_MISSED,{a8},1,"X",0x1,ABSORB,nil,0,7,3', f'SPELL_LEECH,{a8},1,"X",0x1,5,3,1,2', f'SPELL_EXTRA_ATTACKS,{a8},1,"X",0x1,2',
        f'SPELL_DISPEL,{a8},1,"X",0x1,55,"Curse",32,BUFF', f'SPELL_INTERRUPT,{a8},1,"X",0x1,66,"Bolt",4', 'ENCOUNTER_START,7,"Boss",16,20', "ARENA_MATCH_END,1,200,1500,1600",
        f"ENVIRONMENTAL_DAMAGE,{a8},Falling,5,-1,1,nil,nil,nil,1,nil,nil", f'SPELL_DRAIN,{a8},1,"X",0x1,10',
    ]
    lines = spark.createDataFrame([("2024_x.txt", i, "4/22 05:27:15.478  " + t) for i, t in enumerate(texts, 1)], "file string, line_no bigint, raw string")
    parsed = L.parse_events(lines)
    exported = spark.createDataFrame(parsed.selectExpr("line_no", f"{L.event_json(parsed)} as value").collect(), "line_no bigint, value string")
    back = {r.line_no: r for r in L.typed_events(exported).collect()}
    names = ["actors", "spell", "damage", "heal", "miss", "energize", "drain", "leech", "extra_attacks", "spell_block", "aura", "aura_broken_spell", "encounter", "arena_end", "error"]
    seen = set()
    for want in parsed.select("line_no", "environmentalType", *names).collect():
        got = back[want.line_no]
        assert got.environmentalType == want.environmentalType
        for n in names:
            w = want[n].asDict() if hasattr(want[n], "asDict") else want[n]
            if isinstance(w, dict):
                w.pop("extra", None)
                seen.add(n)
            g = got[n].asDict() if hasattr(got[n], "asDict") else got[n]
            assert g == w, n
    assert {"miss", "extra_attacks", "encounter", "arena_end", "damage"} <= seen
