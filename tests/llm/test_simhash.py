"""SimHash groups against a brute-force version."""

import itertools
import random

import pytest
import xxhash

from linewright.llm import simhash as S


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, radius=3):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    rank = {r: n for n, r in enumerate(order)}
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)), key=rank.get)
            label[b] = a
    return sorted((rows[i][0], f"{fps[i]:016x}", rows[find(i)][0]) for i in range(len(rows)))


@pytest.mark.parametrize("chunk", [2, 4096])
def test_whole_table(spark, chunk, monkeypatch):
    monkeypatch.setattr(S.links, "__defaults__", (3, chunk))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(tuple(r) for r in S.near_duplicates(docs).collect())
    assert got == brute_groups([(r.doc_id, r.text) for r in docs.collect()])


def test_links_connect_as_all_pairs(spark):
    import random

    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for x in base:
        for _ in range(6):
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                x ^= 1 << bit
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(signed)], "fp long, key long")
    got = {r.key: r.component for r in S.groups(df, 3, 16).collect()}
    label = list(range(len(signed)))
    for _ in range(len(signed)):
        old = list(label)
        for i, j in itertools.combinations(range(len(signed)), 2):
            if ((signed[i] ^ signed[j]) & (2**64 - 1)).bit_count() <= 3:
                label[i] = label[j] = min(label[i], label[j])
        if old == label:
            break
    assert got == dict(enumerate(label))


def test_odd_rows(spark):
    rows = [(None, "a b c d", 1, "x"), (1, None, 2, "y"), (2, "", 3, "z"), (3, "A b C d", 4, "x"), (3, "A b C d", 4, "x"), (4, " \n ", 5, "q"), (5, "one", 6, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long, component string")
    got = sorted(map(tuple, S.near_duplicates(docs).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(None, None), (1, 1), (2, 1), (3, None), (3, None), (4, 1), (5, 5)], key=str)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 5, None]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).collect() == []
    assert S.keep_one(docs).collect() == []


def test_rows_without_or_with_equal_ids_stay(spark):
    """Only near copies are reduced to one, whatever their ids."""
    words = lambda w: " ".join(f"{w}{k}" for k in range(40))
    rows = [(None, words("a")), (None, words("b")), (None, words("c")), (None, words("a")), (7, words("b")), (8, words("d")), (8, words("e")), (9, words("e")), (9, words("f"))]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    got = sorted(((r.doc_id, r.text) for r in S.keep_one(docs).collect()), key=str)
    want = [(None, words("a")), (None, words("b")), (None, words("c")), (8, words("d")), (8, words("e")), (9, words("f"))]
    assert got == sorted(want, key=str)


def brute_near(rows, least=0.8, radius=None):
    """Pairs of row numbers whose texts are alike by five-word shingles, and all rows' sets; ``radius`` asks for near word fingerprints too."""
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        sets.append({" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    fps = [S.words_fingerprint((t or "").encode()) for _, t in rows]
    pairs = []
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if len(a) >= least * len(b) and len(b) >= least * len(a) and len(a & b) >= least * len(a | b):
            if radius is None or ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= radius:
                pairs.append((i, j))
    return pairs


def brute_keep(rows, radius=7):
    """The least id of each group that near copies connect; rows of one id are told apart by text."""
    label = list(range(len(rows)))
    pairs = brute_near(rows, radius=radius)
    for _ in rows:
        old = list(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if old == label:
            break
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(label[k], []).append(i)
    return {min(g) for g in groups.values()}


def test_keep_one_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(600)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id for r in S.keep_one(docs).collect()} == brute_keep(rows)


def test_near_copies_are_found(spark):
    """Recall of pairs of different texts, at two scales: at most a tenth of them stay both."""
    rng = random.Random(6)
    found = total = 0
    for words, n in ((60, 150), (600, 60)):
        rows = []
        for k in range(n):
            w = [f"w{rng.randrange(5000)}" for _ in range(words)]
            rows.append((2 * k, " ".join(w)))
            for _ in range(max(1, words // 60)):
                w[rng.randrange(words)] = f"x{rng.randrange(5000)}"
            rows.append((2 * k + 1, " ".join(w)))
        kept = {r.doc_id for r in S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        pairs = brute_near(rows)
        total += len(pairs)
        found += sum(rows[i][0] not in kept or rows[j][0] not in kept for i, j in pairs)
    assert total > 150 and found >= 0.9 * total


def test_boilerplate_is_no_near_copy(spark):
    """Equal fingerprints don't drop a row: texts that repeat a phrase and differ in the rest; a large group of copies goes."""
    phrase = "terms of use " * 200
    own = lambda k: " ".join(f"v{k}x{i}" for i in range(250))
    same_words = [" ".join(random.Random(k).sample([f"z{i}" for i in range(60)], 60)) for k in range(40)]
    rows = [(k, phrase + own(k)) for k in range(6)] + [(10 + k, t) for k, t in enumerate(same_words)]
    rows += [(100 + k, own(99) + f" tail{k}") for k in range(300)]
    docs = spark.createDataFrame([(*r, {"a": 1}, 7) for r in rows + rows[:3]], "doc_id long, text string, meta map<string, int>, __key int")
    got = S.keep_one(docs).collect()
    assert sorted(r.doc_id for r in got) == [*range(6), *range(10, 50), 100]
    assert all(r["__key"] == 7 and r.meta == {"a": 1} for r in got)


def test_links_of_a_wide_radius(spark):
    rng = random.Random(9)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for x in fps[:100]:
        for bit in rng.sample(range(64), rng.randrange(4, 12)):
            x ^= 1 << bit
        fps.append(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(signed)], "fp long, key long")
    for radius in (7, 10):
        label = list(range(len(fps)))
        for _ in fps:
            old = list(label)
            for i, j in itertools.combinations(range(len(fps)), 2):
                if (fps[i] ^ fps[j]).bit_count() <= radius:
                    label[i] = label[j] = min(label[i], label[j])
            if old == label:
                break
        assert {r.key: r.component for r in S.groups(df, radius, 64).collect()} == dict(enumerate(label))


def made_group(rng, texts, base, fresh, edits):
    """Sets of one text's copies, each with up to ``edits`` of its hashes replaced by fresh ones."""
    out = []
    for _ in range(texts):
        x = list(base)
        for at in rng.sample(range(len(x)), rng.randint(1, edits)):
            x[at] = fresh()
        out.append(sorted(set(x)))
    return out


def connected(spark, sets, least=0.8):
    """Components of ``_verified`` over sets(group, list), by place."""
    rows = [(g, m, (m, 0, 0), x) for m, (g, x) in enumerate(sets)]
    df = spark.createDataFrame(rows, "group long, m long, rank struct<key:long,one:long,two:long>, set array<long>")
    found = {r.node: r.component for r in S.components(S._verified(df, least)).collect()}
    return [found.get(m, m) for m in range(len(sets))]


def brute_connected(sets, least=0.8):
    label = list(range(len(sets)))
    own = [frozenset(x) for _, x in sets]
    near = [
        (i, j)
        for i, j in itertools.combinations(range(len(sets)), 2)
        if sets[i][0] == sets[j][0] and len(own[i] & own[j]) >= least * len(own[i] | own[j])
    ]
    while True:
        old = list(label)
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
        if old == label:
            return label


def test_verified_loses_no_link(spark):
    """Copies of copies, several crowds in a group, texts of other sizes, sets without a hash: all as connected as all pairs make them."""
    rng = random.Random(12)
    number = itertools.count(1)
    fresh = lambda: rng.getrandbits(40) * 1000 + next(number) % 1000
    sets = []
    for group, size in ((1, 60), (2, 25), (3, 8)):
        for _ in range(4):
            base = [fresh() for _ in range(size)]
            sets += [(group, x) for x in made_group(rng, 40, base, fresh, max(2, size // 7))]
            step = list(base)
            for _ in range(8):
                step = step[2:] + [fresh()]
                sets.append((group, sorted(step)))
    sets += [(4, []), (4, [fresh(), fresh()]), (4, [fresh()]), (4, []), (4, []), (1, [])]
    sets += [(5, list(range(n))) for n in (4, 5, 10, 15, 20, 35, 44)]
    rng.shuffle(sets)
    assert connected(spark, sets) == brute_connected(sets)


def test_verified_compares_few(spark, monkeypatch):
    """Exact comparisons in one group of texts with one passage, most of them no near copies of each other, grow with the texts."""
    rng = random.Random(13)
    number = itertools.count(1)
    calls = spark.sparkContext.accumulator(0)
    alike = S._alike

    def counted(a, b, least):
        def one(x):
            calls.add(1)
            return x

        return S.F.udf(one, "boolean").asNondeterministic()(alike(a, b, least))

    compared = {}
    for n in (200, 400):
        base = [next(number) for _ in range(140)]
        sets = [(1, x) for x in made_group(rng, n, base, lambda: next(number), 40)]
        want = brute_connected(sets)
        monkeypatch.setattr(S, "_alike", counted)
        before = calls.value
        assert connected(spark, sets) == want
        monkeypatch.undo()
        compared[n] = calls.value - before
    assert compared[400] < 400 * 10 and compared[400] < 3.5 * compared[200]
