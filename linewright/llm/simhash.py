"""SimHash near-duplicates by tiled exact comparison.

A fingerprint has 64 bits; a bit is set if it is set in more than half of the hashes of the
text's three-word shingles. Distinct fingerprints are dealt to tiles by the population counts
of their four 16-bit quarters. The counts of two fingerprints differ by no more than their
distance, so only tile pairs whose counts are within the radius are compared; every such pair
is compared whole, with exclusive-or and bit counts in numpy. Tiles beyond ``CHUNK``
fingerprints are cut by hash, and each pair of cuts is a group of its own, so a hot tile is
spread. A group hands on a spanning forest of its links, never all links.

Null and empty texts have fingerprint zero and are linked like any other. A null id comes
first in the order of ids. Repeated rows come out as often as they go in. Other columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, any_id, id_key, id_of, map_batches, settle, table, texts_of
from .components import components

RADIUS = 3
SHINGLE = 3
CHUNK = 4096
#: Most tiles there can be: 17 counts in each of four quarters. Bounds what is broadcast.
MAX_TILES = 17**4
#: Bounds that only choose what is compared give way by this much, so that rounding leaves nothing out.
SLACK = 1e-9


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit number."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        begins = [0, *(ends[:-1] + 1).tolist()]
        hashes = [xxhash.xxh64_intdigest(line[a:b], 42) for a, b in zip(begins, ends[shingle - 1 :].tolist())]
    values = np.array(hashes, np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(values), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``key, fp`` of each row; the key stands for doc_id."""
    rows = docs.select(id_key().alias("key"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, lambda b: {"key": b.column("key"), "fp": [fingerprint(x) for x in texts_of(b.column("text"))]}, "key long, fp long")


def spanning(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links of ``a`` to ``b`` within the radius connect.

    Compared in blocks, so memory is bounded also where all pairs are links.
    """
    nodes = np.unique(np.concatenate([a, b]))
    ia, ib = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    label = np.arange(len(nodes))
    for at in range(0, len(a), 128):
        near = np.bitwise_count(a[at : at + 128, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        u, v = ia[at + i], ib[j]
        while len(u):
            x, y = label[u], label[v]
            if (x == y).all():
                break
            low, high = np.minimum(x, y), np.maximum(x, y)
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _parts(radius: int) -> int:
    """Into how many parts a fingerprint is cut for its counts: a wide radius meets too many tiles of quarters."""
    return 4 if radius <= RADIUS else 2


def _tile(parts: int = 4, fp: str = "fp") -> Column:
    """The population counts of the parts, seven bits each."""
    width = 64 // parts
    each = F.lit((1 << width) - 1)
    counts = [F.bit_count(F.shiftrightunsigned(fp, width * q).bitwiseAND(each)).cast("int") for q in range(parts)]
    return sum((c * 128**q for q, c in enumerate(counts)), F.lit(0))


def _offsets(radius: int, parts: int = 4) -> list[int]:
    """Differences of tiles within the radius, one of each two opposite ones; counts end at 32 and a sum of counts and radius below 128, so none is mistaken."""
    around = itertools.product(range(-radius, radius + 1), repeat=parts)
    return [sum(x * 128**q for q, x in enumerate(t)) for t in around if sum(map(abs, t)) <= radius and t >= (0,) * parts]


def links(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """``u, v``: edges that connect distinct fingerprints (column fp) exactly as all their links would."""
    if not 0 <= radius <= 64:
        raise ValueError("radius must be 0 to 64")
    parts = _parts(radius)
    tiled = fps.select("fp", _tile(parts).alias("tile"))
    # At most MAX_TILES rows whatever the corpus, so this is broadcast.
    sizes = settle(tiled.groupBy("tile").agg(F.ceil(F.count("*") / chunk).cast("int").alias("cuts")), "tiles")
    cut = tiled.join(F.broadcast(sizes), "tile").select("tile", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int").alias("cut"), "fp")
    chunks = settle(cut.groupBy("tile", "cut").agg(F.collect_list("fp").alias("fps")), "cuts")
    near = F.explode(F.array(*(F.col("tile") + x for x in _offsets(radius, parts))))
    others = sizes.select(F.col("tile").alias("other"), F.col("cuts").alias("other_cuts"))
    pairs = sizes.withColumn("other", near).join(F.broadcast(others), "other")
    pairs = pairs.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    pairs = pairs.withColumn("other_cut", F.explode(F.sequence(F.lit(0), F.col("other_cuts") - 1)))
    key = ["tile", "cut", "other", "other_cut"]
    pairs = pairs.where("tile != other or cut <= other_cut").select(*key)
    # One group for each pair of cuts; both cuts are sent to it.
    left = pairs.join(chunks, ["tile", "cut"]).select(*key, F.lit(0).alias("side"), "fps")
    right = chunks.select(F.col("tile").alias("other"), F.col("cut").alias("other_cut"), "fps")
    right = pairs.where("tile != other or cut != other_cut").join(right, ["other", "other_cut"]).select(*key, F.lit(1).alias("side"), "fps")
    sides = left.unionByName(right).groupBy(*key).agg(F.max_by("fps", F.col("side")).alias("b"), F.min_by("fps", F.col("side")).alias("a"))

    def compare(batch: pa.RecordBatch) -> dict:
        found = [(np.empty(0, np.uint64),) * 2]
        for x, y in zip(batch.column("a"), batch.column("b")):
            found.append(spanning(np.asarray(x.values).view(np.uint64), np.asarray(y.values).view(np.uint64), radius))
        return {name: np.concatenate([f[k] for f in found]).view(np.int64) for k, name in enumerate("uv")}

    return map_batches(sides.select("a", "b"), compare, "u long, v long")


def _reached(each: DataFrame, radius: int, chunk: int) -> DataFrame:
    """each, a row per fingerprint, with ``component``: the least fingerprint that can be reached over links."""
    reached = components(links(each.select("fp"), radius, chunk))
    return each.join(reached.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def groups(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """``key, fp, component``: the least key that can be reached over links.

    fps: key long, fp long; read several times, so settle it first.
    """
    each = settle(fps.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    joined = _reached(each, radius, chunk)
    least = joined.groupBy("component").agg(F.min("least").alias("first"))
    named = joined.join(least, "component").select("fp", F.col("first").alias("component"))
    return fps.join(settle(named, "named"), "fp").select("key", "fp", "component")


@any_id("doc_id", "component_id")
def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of docs(doc_id, text)."""
    found = groups(settle(fingerprints(docs), "fingerprints"), radius)
    return found.select(id_of("key").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), id_of("component").alias("component_id"))


def _identity(tag: str) -> dict[str, Column]:
    """Columns that are equal for rows of equal doc_id and text: the id and 128 bits of hash. ``tag`` keeps them apart from the input's."""
    text = F.col("text").cast("string")
    return {f"{tag}key": id_key(), f"{tag}one": F.xxhash64(text), f"{tag}two": F.xxhash64(F.lit(1), text)}


def words_fingerprint(text: bytes) -> int:
    """The fingerprint of a text's set of words. It moves little when a few words change."""
    words = set(text.translate(LOWER).split())
    return fingerprint(b" ".join(sorted(words)), 1)


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of words (fewer words: of the whole sequence)."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.int64)
    parts = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    return np.unique(np.array([xxhash.xxh64_intdigest(x, 7) for x in parts], np.uint64).view(np.int64))


def _alike(a: str, b: str, least: float) -> Column:
    """Whether two sets of hashes have a Jaccard similarity of ``least`` or more; two empty ones have."""
    both = F.size(F.array_intersect(a, b))
    return both >= F.lit(least) * (F.size(a) + F.size(b) - both)


def _stars(sets: DataFrame, least: float, rounds: int) -> tuple[DataFrame, DataFrame]:
    """``u, v`` and ``group, m, n, set, label``: the texts that are left of a group are compared with the first of them, ``rounds`` times."""
    edges, left = [], sets
    for _ in range(rounds):
        lead = left.groupBy("group").agg(F.min(F.struct("rank", "m")).alias("lead")).select("group", F.col("lead.m").alias("lead"))
        lead = settle(lead.join(left.select(F.col("m").alias("lead"), F.col("set").alias("lead_set")), "lead"), "leads")
        compared = settle(left.join(lead, "group").select("group", "m", "rank", "set", "lead", _alike("set", "lead_set", least).alias("near")), "compared")
        edges.append(compared.where("near and m != lead").select(F.col("lead").alias("u"), F.col("m").alias("v")))
        left = compared.where("not near and m != lead").select("group", "m", "rank", "set")
    found = functools.reduce(DataFrame.unionByName, edges)
    named = sets.join(found.select(F.col("v").alias("m"), F.col("u").alias("star")), "m", "left")
    return found, named.select("group", "m", F.size("set").alias("n"), "set", F.coalesce("star", "m").alias("label"))


def _heads(texts: DataFrame, least: float) -> DataFrame:
    """``group, hash, m, n, at``: the rarest hashes of each text that others of its group hold, and their places among its hashes.

    In the order of (texts of the group that hold it, hash), two sets that share least * n of n
    hashes share one of the first n - ceil(least * n) + 1. Hashes of one text come first and meet
    nothing. A set without a hash has a place of its own.
    """
    own = F.when(F.col("n") > 0, F.col("set")).otherwise(F.array(F.lit(0).cast("long")))
    each = settle(texts.select("group", "m", "n", F.explode(own).alias("hash")), "hashes")
    often = each.groupBy("group", "hash").agg(F.count("*").alias("often")).where("often > 1")
    shared = each.join(often, ["group", "hash"])
    of_text = Window.partitionBy("m")
    lone = F.greatest("n", F.lit(1)) - F.count("*").over(of_text)
    place = F.row_number().over(of_text.orderBy("often", "hash"))
    last = F.col("n") - F.ceil(F.lit(least) * F.col("n") - SLACK) + 1
    heads = settle(shared.withColumn("at", place + lone).where(F.col("at") <= last).select("group", "hash", "m", "n", "at"), "heads")
    # What a text needs to share grows with the other's size, and no text of the hash is smaller than least_n.
    fewest = heads.groupBy("group", "hash").agg(F.min("n").alias("least_n"), F.count("*").alias("texts")).where("texts > 1")
    other = F.greatest(F.lit(least) * F.col("n"), "least_n")
    able = (F.col("n") - F.col("at") + 1) * (1 + least) >= least * (F.col("n") + other) - SLACK
    return settle(heads.join(fewest, ["group", "hash"]).where(able).select("group", "hash", "m", "n", "at"), "able")


def _may(least: float) -> Column:
    """Whether the sets of m and m2 can be alike if the hash at their places is the first, in the order of all, that they share."""
    sizes = (F.col("n") >= least * F.col("n2")) & (F.col("n2") >= least * F.col("n"))
    most = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2")) + 1
    return sizes & (most * (1 + least) >= least * (F.col("n") + F.col("n2")) - SLACK)


def _alike_pairs(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """``u, v``: those pairs (m, m2) of texts that are near copies."""
    pairs = settle(pairs.select(F.least("m", "m2").alias("m"), F.greatest("m", "m2").alias("m2")).distinct(), "pairs")
    both = pairs.join(texts.select("m", "set"), "m").join(texts.select(F.col("m").alias("m2"), F.col("set").alias("set2")), "m2")
    return settle(both.where(_alike("set", "set2", least)).select(F.col("m").alias("u"), F.col("m2").alias("v")), "alike")


def _crossing(heads: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """heads with the label of each text, and a row for each label of a hash that several labels hold.

    The latter has the label's text of the earliest place, and ``main``, the same of the hash's most frequent label.
    """
    named = settle(heads.join(labels, "m"), "named")
    each = named.groupBy("group", "hash", "label").agg(F.count("*").alias("texts"), F.min(F.struct("at", "n", "m")).alias("first"))
    main = each.groupBy("group", "hash").agg(F.max(F.struct("texts", "label", "first")).alias("main"), F.count("*").alias("labels"))
    main = settle(main.where("labels > 1").select("group", "hash", "main"), "main")
    return named, each.join(main, ["group", "hash"])


def _verified(sets: DataFrame, least: float, rounds: int = 2) -> DataFrame:
    """``u, v``: near copies by exact similarity, which connect what all pairs of near copies in a group connect.

    sets: group, m, rank, set; a row per text. First all of a group are compared with its first
    text, twice, which settles large groups of copies by one comparison each. Then texts meet
    where their rarest hashes, a fifth of each set, share one, as sets of such a similarity must.
    Texts that are connected already need no comparison: of each such hash one text of each
    label, that is of what is connected, is compared with one of the most frequent label; of
    what is then still apart, texts outside the most frequent label are compared with all others that
    the places of the hash allow.
    """
    stars, texts = _stars(sets, least, rounds)
    texts = settle(texts, "texts")
    apart = texts.groupBy("group").agg((F.min("label") != F.max("label")).alias("apart")).where("apart").select("group")
    texts = settle(texts.join(apart, "group", "left_semi"), "apart")
    heads = _heads(texts, least)
    _, firsts = _crossing(heads, texts.select("m", "label"))
    firsts = firsts.where("label != main.label").select("first.*", *(F.col(f"main.first.{x}").alias(f"{x}2") for x in ("at", "n", "m")))
    found = stars.unionByName(_alike_pairs(firsts.where(_may(least)), texts, least))
    labels = texts.select("m").join(components(found).withColumnRenamed("node", "m"), "m", "left").select("m", F.coalesce("component", "m").alias("label"))
    named, several = _crossing(heads, settle(labels, "labels"))
    main = several.groupBy("group", "hash").agg(F.first("main.label").alias("main"))
    crossing = settle(named.join(main, ["group", "hash"]), "crossing")
    others = crossing.select("group", "hash", F.col("m").alias("m2"), F.col("n").alias("n2"), F.col("at").alias("at2"), F.col("label").alias("label2"))
    # Pairs outside the main label meet once, by label.
    once = (F.col("label2") == F.col("main")) | (F.col("label") < F.col("label2"))
    pairs = crossing.where("label != main").join(others, ["group", "hash"]).where(once & _may(least))
    return found.unionByName(_alike_pairs(pairs, texts, least))


#: Distance of word fingerprints within which texts are compared. Over the tables 0.95 of the pairs
#: with a similarity of 0.8 or more lie within it; tests/llm holds the recall.
NEAR_RADIUS = 7


@any_id("doc_id")
def keep_one(docs: DataFrame, radius: int = NEAR_RADIUS, least: float = 0.8) -> DataFrame:
    """docs with one row of each group of near copies: the least doc_id, of repeated ids the text with the least hash.

    Texts whose word fingerprints link within ``radius`` are candidates; a row only goes as a
    verified near copy, by the exact similarity of five-word shingles, or as a copy of an equal
    text. Texts without a word are copies of each other. Every column of docs is kept, whatever
    its name or type. Rows without an id, and rows that share one, stay as long as their texts
    are no near copies. Of rows equal in id and text the least stays, as JSON text.
    """
    tag = f"_{uuid.uuid4().hex}_"
    same = list(_identity(tag))
    key, one, two = same
    named = docs.withColumns(_identity(tag))
    # Copies: one row for each text, of the least id.
    copies = named.groupBy(*same).agg(F.count("*").alias("n"))
    texts = settle(copies.groupBy(one, two).agg(F.min(F.struct(key, "n")).alias("least")).select(f"least.{key}", one, two, "least.n"), "texts")
    whole = named.join(texts.select(*same), same, "left_semi").select(*same, F.col("text").cast("string").alias("text"))
    prints = map_batches(
        whole, lambda b: {**{n: b.column(n) for n in same}, "fp": [words_fingerprint(x) for x in texts_of(b.column("text"))]}, ", ".join(f"{n} long" for n in (*same, "fp"))
    )
    prints = settle(prints.dropDuplicates(same), "prints")
    reached = _reached(settle(prints.select("fp").distinct(), "distinct"), radius, CHUNK)
    several = prints.join(reached, "fp").withColumn("m", F.monotonically_increasing_id())
    several = settle(several, "linked")
    crowd = several.groupBy("component").count().where("count > 1").select("component")
    several = settle(several.join(crowd, "component", "left_semi").select("m", F.col("component").alias("group"), *same), "several")
    held = whole.join(several, same).dropDuplicates(["m"])
    sets = map_batches(
        held.select("group", "m", *same, "text"),
        lambda b: {**{n: b.column(n) for n in ("group", "m", *same)}, "set": [shingles(x) for x in texts_of(b.column("text"))]},
        ", ".join(f"{n} long" for n in ("group", "m", *same)) + ", set array<long>",
    )
    sets = settle(sets.select("group", "m", F.struct(*same).alias("rank"), "set"), "sets")
    groups_ = components(_verified(sets, least)).join(several.select(F.col("m").alias("node"), *same), "node")
    first = groups_.groupBy("component").agg(F.min(F.struct(*same)).alias("first")).select("component", "first.*")
    gone = settle(groups_.select("node", *same).join(first.select(*same), same, "left_anti").select(*same), "gone")
    # Settled, so that the joins can split a text that is repeated under one id.
    kept = settle(texts.join(gone, same, "left_anti"), "kept")
    once = named.join(kept.where("n = 1").drop("n"), same, "left_semi").select(*docs.columns)
    twice = named.join(kept.where("n > 1").drop("n"), same, "left_semi")
    # Equal rows are merged on the map side.
    row = F.struct(*docs.columns)
    one_of = twice.groupBy(*same).agg(F.min_by(row, F.to_json(row)).alias(f"{tag}row")).select(f"{tag}row.*")
    return once.unionByName(one_of)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its fingerprint and component."""
    return near_duplicates(table(spark, sf_dir, "documents"))
