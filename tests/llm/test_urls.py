"""URL filters against a version in plain Python, and the SQL answer."""

from collections import defaultdict

import duckdb

from linewright.llm import urls as U
from linewright.llm.queries import ORACLES, QUERIES


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def levels(host):
    parts = host.split(".")
    k = 2 if ".".join(parts[-2:]) in U.SECOND_LEVEL else 1
    return ".".join(parts[-k:]), ".".join(parts[-k - 1 :]), host


def brute(pages, outcomes):
    bad = {}
    for page, x in outcomes:
        if page is not None and x in (0, 1):
            bad[page] = max(bad.get(page, 0), x)
    count = defaultdict(lambda: [0, 0])
    for page, url in pages:
        c = count[split_url(url)[0]]
        if page in bad:
            c[0] += 1
            c[1] += bad[page]
    n, k = (sum(c[i] for c in count.values()) for i in (0, 1))
    mean, out = {(): k / n if n else 0.0}, {}
    for level in range(3):
        groups = defaultdict(lambda: [0, 0])
        for host, c in count.items():
            key = levels(host)[: level + 1]
            groups[key][0] += c[0]
            groups[key][1] += c[1]
        over = under = 0.0
        for key, (n, k) in groups.items():
            p = mean[key[:-1]]
            if n:
                over += n * (k / n - p) ** 2 - p * (1 - p)
                under += (n - 1) * p * (1 - p)
        m = 1 / min(max(over / under if under else 0, 1e-3), 0.5) - 1
        for key, (n, k) in groups.items():
            mean[key] = (k + m * mean[key[:-1]]) / (n + m)
            if level == 2:
                out[key[2]] = mean[key] - U.Z * (mean[key] * (1 - mean[key]) / (n + m + 1)) ** 0.5
    return out


def rule(host, path):
    fits = [(len(h), len(p), a, h + p) for a, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


ROWS = [
    (1, "http://A.Example.ORG/es/x?y#z"), (2, "https://example.org/en/1"), (3, "ftp://example.org/en/2"), (4, "http://org"), (5, "http://b.com/fr/1"), (6, "http://x.b.com/de/#q"),
    (7, None), (8, "no scheme"), (9, "http://"), (10, "x://y://z/w"), (11, "http://a.co.uk/p\nq"), (11, "http://a.co.uk/p\nq"), (None, "http://bad.net/1"), (12, "http://bad.net?x://y/"), (13, "http://ÄÖ.de/é"),
    *((100 + i, f"http://h{i % 4}.worse.net/en/{i}") for i in range(80)),
]
OUTCOMES = [(100 + i, int(i % 4 == 0 or i % 10 == 1)) for i in range(80)] + [(1, 0), (2, 1), (2, 0), (None, 1), (3, None), (4, 7)]


def test_rows_and_bounds(spark):
    pages = spark.createDataFrame([(*r, "h", "x") for r in ROWS], "page_id long, url string, host string, bad string")
    out = U.judge(pages, spark.createDataFrame(OUTCOMES, "page_id long, bad int"), limit=0.5)
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=str)
    bound = brute(ROWS, OUTCOMES)
    want = []
    for page, url in ROWS:
        host, path = split_url(url)
        action, name = rule(host, path)
        want.append((page, host, path, name, action or ("block" if bound[host] > 0.5 else "allow")))
    assert got == sorted(want, key=str) and {x[4] for x in want if not x[3]} == {"allow", "block"}
    assert all(abs(r.bound - bound[r.host]) < 1e-9 for r in out.collect())


def test_limit_is_the_share_of_the_table(spark):
    """Without a limit a host goes once it is surely worse than all pages; suffixes are a parameter."""
    rows = [(i, f"http://{'bad' if i < 60 else f'good{i % 9}'}.shop.xx/{i}") for i in range(600)]
    outcomes = [(i, int(i % 10 < (9 if i < 60 else 1))) for i, _ in rows]
    pages, known = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int")
    out = U.judge(pages, known).collect()
    share, bound = sum(x for _, x in outcomes) / 600, brute(rows, outcomes)
    assert {r.host for r in out if r.verdict == "block"} == {"bad.shop.xx"} == {h for h, b in bound.items() if b > share}
    assert U.reputation(pages, known)[1] == share
    host = spark.createDataFrame([("bad.shop.xx",)], "h string")
    assert host.select(U.domain_of(host.h, ["shop.xx"]), U.suffix_of(host.h, ["shop.xx"])).first()[:] == ("bad.shop.xx", "shop.xx")


def test_empty(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    assert {r.verdict for r in U.judge(pages, none).where("rule is null").collect()} == {"allow"}
    assert U.judge(pages.limit(0), none).collect() == []


def test_query_is_the_sql_answer(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        c = duckdb.connect()
        for t in ("pages", "labels"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        cursor = c.execute(ORACLES["op9_urls"])
        names = [d[0] for d in cursor.description]
        got = QUERIES["op9_urls"](spark, sf)
        assert got.columns == names
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, cursor.fetchall()))
