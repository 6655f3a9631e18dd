"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from linewright.llm.variants import count_words, group, near_pairs, signatures

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_counts(rows, damage=97):
    total = Counter()
    for doc_id, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def brute_groups(counts):
    found = {w: sorted((v for v in counts if near(w, v)), key=lambda v: (-counts[v], v)) for w in counts}
    form = {w: v[0] if v and counts[v[0]] >= 2 * counts[w] else None for w, v in found.items()}
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(found[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def grouped(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, group(words, **options).select(*COLUMNS).collect()))


def made(seed, letters, size, n):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, size))) for _ in range(n)}
    for w in list(words)[: n // 2]:
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]}
    return {w: 2 ** rng.randrange(12) + rng.randrange(3) for w in sorted(words)}


@pytest.mark.parametrize("hot", [1, 64])
@pytest.mark.parametrize("letters,size", [("ab", 9), ("abcdefgéàÿ×", 8)])
def test_groups_against_brute_force(spark, letters, size, hot):
    counts = made(len(letters), letters, size, 150)
    assert grouped(spark, counts, hot=hot) == brute_groups(counts)


def test_words_of_the_same_letters(spark):
    """All words fall under the same signatures; refining keeps every pair."""
    rng = random.Random(1)
    counts = {"".join(rng.sample("abcdefg", 7)): k for k in range(1, 300)}
    counts |= {w[:3] + "x" + w[4:]: 2 for w in list(counts)[:20]}
    counts |= {w[:-1]: 40 for w in list(counts)[20:40]}
    assert grouped(spark, counts, hot=8) == brute_groups(counts)


def test_long_chain_and_long_words(spark):
    """Forms double at each step; a very long word is a word like any other."""
    chain = {"aaaaa" + "b" * k: 2**k for k in range(20)}
    long = {"q" * 30_000: 3, "q" * 30_001: 7, "q" * 15_000 + "z" + "q" * 15_000: 3}
    got = grouped(spark, chain | long)
    want = {w: (f, r) for w, f, r, *_ in got}
    assert all(want["aaaaa" + "b" * k] == ("aaaaa" + "b" * (k + 1), "aaaaa" + "b" * 19) for k in range(19))
    assert want["q" * 30_000] == ("q" * 30_001,) * 2
    assert {r[0]: r[4] for r in got}["q" * 30_001] == 2


def test_counts_against_brute_force(spark):
    rng = random.Random(2)
    words = ["Hello", "hello", "ÉCOLE", "École", "çava", "straße", "naïve×two", "abc", "wörterbuch"]
    rows = [(k if k % 9 else None, " ".join(rng.choice(words) + rng.choice(["", ",", "1", "é"]) for _ in range(40))) for k in range(120)]
    rows += [(1, None), (2, ""), (3, "  \n"), (4, "dots…here здравствуй"), rows[0], (5, "word " * 50_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = {r.word: r.n for r in count_words(docs).collect()}
    assert got == brute_counts(rows)
    got = {r.word: r.n for r in count_words(docs, damage=2).collect()}
    assert got == brute_counts(rows, damage=2)


def test_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert count_words(none).collect() == []
    assert group(count_words(none)).collect() == []
    assert grouped(spark, {"lonely": 3}) == [("lonely", None, "lonely", 3, 0, None)]


def test_near_words_share_a_signature(spark):
    counts = made(3, "abcd", 8, 60)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    sigs = {}
    for r in signatures(words).collect():
        sigs.setdefault(r.word, {}).setdefault(r.role, set()).add(r.sig)
    pairs = [(r.word, r.near) for r in near_pairs(words).collect()]
    assert pairs
    for a, b in pairs:
        if len(a) == len(b):
            assert sigs[a][0] & sigs[b][0]
        elif len(a) < len(b):
            assert sigs[a][1] & sigs[b][2]
