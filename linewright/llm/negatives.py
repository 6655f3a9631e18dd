"""Hard-negative mining with Kronecker-packed products.

Rows are (id, label, vector of whole numbers). For each anchor its positives are the rows of the
same label with the highest inner product; for each positive, the hard negatives are the rows of
other labels with the highest inner product inside a band that the positive's score sets.

Inner products are exact. Candidates' components are biased to be at least 0 and several of them
put into separated fields of one wide integer, one integer per dimension. An anchor's (biased)
component is multiplied with it once, and the sum over the dimensions holds the products of all
those candidates side by side; the fields are wide enough for the largest sum, so none runs into
the next. Taking the biases off again gives the scores. The width follows from the numbers at
hand: 64-bit integers hold two fields or more for usual vectors, and where a single field needs
more than 64 bits Python's unbounded integers take over.

All anchors meet all rows in blocks: anchors are dealt to blocks of about ``BLOCK`` rows and
candidates to parts of about ``PART`` by hash, and every (block, part) is one group. What a group
hands on are its best few rows for each anchor, which a window then ranks. A task holds one block
and one part, whatever the table; nothing goes to the driver but counts.

Rows with a null id or label, a null vector, or a null or non-finite component take no part.
Rows equal in id, label and vector count once; rows that share only the id are rows of their own,
ranked by id and then by hash. Vectors of unequal length are filled up with zeros, an empty one is
all zeros. Scores beyond a long count as the nearest long. Other columns do not matter. An empty
table gives no rows; an anchor without positives, or a positive without negatives, gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settle, table

BLOCK = 8192
PART = 16384
#: Scores that are held at once: anchors times candidates.
AT_ONCE = 1 << 22
_LEAST, _MOST = -(2**63), 2**63 - 1


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all anchors with all rows (longs in, longs out), by packed products."""
    n, dims = rows.shape
    if not n or not len(anchors) or not dims:
        return np.zeros((len(anchors), n), np.int64)
    low_a, low_c = anchors.min(axis=0), rows.min(axis=0)
    top_a = [int(x) - int(y) for x, y in zip(anchors.max(axis=0), low_a)]
    top_c = [int(x) - int(y) for x, y in zip(rows.max(axis=0), low_c)]
    # The largest sum a field can come to, so that it never runs into the next one.
    bits = max(1, sum(x * y for x, y in zip(top_a, top_c)).bit_length())
    most = max(1, max(top_c))
    bits = max(bits, most.bit_length())
    wide = bits > 64
    fields = 8 if wide else 64 // bits
    if wide:
        biased_a = anchors.astype(object) - low_a.astype(object)
        biased_c = rows.astype(object) - low_c.astype(object)
    else:
        biased_a = (anchors - low_a).astype(np.uint64)
        biased_c = (rows - low_c).astype(np.uint64)
    filled = np.zeros((-n % fields, dims), biased_c.dtype)
    lanes = np.concatenate([biased_c, filled]).reshape(fields, -1, dims)
    shift = (lambda k: k * bits) if wide else (lambda k: np.uint64(k * bits))
    packed = lanes[0].copy()
    for k in range(1, fields):
        packed |= lanes[k] << shift(k)
    packed = np.ascontiguousarray(packed.T)
    total = biased_a @ packed if wide else np.einsum("ad,dn->an", biased_a, packed)
    mask = (1 << bits) - 1 if wide else np.uint64((1 << bits) - 1)
    out = np.concatenate([(total >> shift(k)) & mask for k in range(fields)], axis=1)[:, :n]
    # (a - x)(c - y) = ac - ay - xc + xy, summed over the dimensions.
    exact_a, exact_c, x, y = (v.astype(object) for v in (anchors, rows, low_a, low_c))
    back_a, back_c = exact_a @ y, exact_c @ x - (x @ y)
    ends = [int(v) for v in (*(back_a.min(), back_a.max()), *(back_c.min(), back_c.max()))]
    if not wide and bits < 62 and max(map(abs, ends)) < 2**60:
        return out.astype(np.int64) + back_a.astype(np.int64)[:, None] + back_c.astype(np.int64)[None, :]
    exact = out.astype(object) + back_a[:, None] + back_c[None, :]
    return np.clip(exact, _LEAST, _MOST).astype(np.int64)


def first(scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores, of equal ones the first."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        over = np.flatnonzero(scores > least)
        found = np.concatenate([over, np.flatnonzero(scores == least)[: most - len(over)]])
    else:
        found = np.arange(len(scores))
    return found[np.lexsort((found, ~scores[found]))]  # ~x falls as x rises, and never overflows


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    values = np.asarray(column.combine_chunks().flatten())
    return values.astype(np.int64, copy=False).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _sorted(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, keys, labels and vectors of the candidates, by id and key."""
    ids, keys, labels = (np.asarray(group.column(c).combine_chunks()) for c in ("id", "key", "label"))
    order = np.lexsort((keys, ids))
    return ids[order], keys[order], labels[order], _matrix(group.column("vec"), group.num_rows)[order]


def _steps(n_anchors: int, n_rows: int) -> Iterator[slice]:
    step = max(1, AT_ONCE // max(1, n_rows))
    return (slice(at, at + step) for at in range(0, n_anchors, step))


def _table(parts: list[list], names: list[str]) -> pa.Table:
    columns = [np.concatenate([np.asarray(p[k], np.int64) for p in parts]) if parts else np.zeros(0, np.int64) for k in range(len(names))]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _meet(anchors: DataFrame, rows: DataFrame, blocks: int, parts: int, fn, schema: str) -> DataFrame:
    """``fn`` of every block of anchors with every part of the rows."""
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("block", F.pmod("key", F.lit(blocks))).withColumn("part", spread(parts))
    right = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")).withColumn("block", spread(blocks))
    left = left.withColumn("block", F.col("block").cast("int"))
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(fn, schema)


def _nearest(most: int):
    """For each anchor of a block the ``most`` best rows of its label in a part."""
    names = ["anchor_id", "anchor_key", "positive_id", "positive_key", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts: list[list] = []
        if left.num_rows and right.num_rows:
            ids, keys, labels, vecs = _sorted(right)
            a_ids, a_keys, a_labels, a_vecs = _sorted(left)
            for label in np.unique(a_labels):
                of, among = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
                if not len(among):
                    continue
                for some in _steps(len(of), len(among)):
                    mine = of[some]
                    for a, scores in zip(mine, products(a_vecs[mine], vecs[among])):
                        # One row more, as the anchor itself may be among them.
                        best = among[found := first(scores, most + 1)]
                        other = ~((ids[best] == a_ids[a]) & (keys[best] == a_keys[a]))
                        best, found = best[other][:most], found[other][:most]
                        parts.append([np.full(len(best), a_ids[a]), np.full(len(best), a_keys[a]), ids[best], keys[best], scores[found]])
        return _table(parts, names)

    return run, ", ".join(f"{n} long" for n in names)


def _banded(most: int, low: int, high: int):
    """For each positive of an anchor the ``most`` best rows of other labels in its band."""
    names = ["anchor_id", "anchor_key", "place", "negative_id", "negative_key", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts: list[list] = []
        if left.num_rows and right.num_rows:
            ids, keys, labels, vecs = _sorted(right)
            a_ids, a_keys, a_labels = (np.asarray(left.column(c).combine_chunks()) for c in ("id", "key", "label"))
            a_vecs, positives = _matrix(left.column("vec"), left.num_rows), left.column("scores").to_pylist()
            for some in _steps(left.num_rows, len(ids)):
                for a, scores in enumerate(products(a_vecs[some], vecs), some.start):
                    # low * positive <= 100 * negative <= high * positive, in whole numbers.
                    bands = [(max(-(-low * p // 100), _LEAST), min(high * p // 100, _MOST)) for p in positives[a]]
                    among = np.flatnonzero((labels != a_labels[a]) & (scores >= min(b[0] for b in bands)))
                    near = scores[among]
                    for place, (lo, hi) in enumerate(bands):
                        fits = np.flatnonzero((near >= lo) & (near <= hi))
                        best = fits[first(near[fits], most)]
                        parts.append([np.full(len(best), v) for v in (a_ids[a], a_keys[a], place)] + [ids[among[best]], keys[among[best]], near[best]])
        return _table(parts, names)

    return run, ", ".join(f"{n} long" for n in names)


def prepare(vectors: DataFrame, label: Column, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``id, label, vec, key`` of the rows that take part; a component x becomes floor(scale * x)."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & ~broken)
    rows = rows.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vec"))
    return rows.withColumn("key", F.xxhash64("id", "label", "vec"))


def mine(rows: DataFrame, anchor: Column, n_positive: int = 5, n_negative: int = 10, low: int = 30, high: int = 90, block: int = BLOCK, part: int = PART) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    rows: as ``prepare`` gives them; anchor: which of them are anchors. A negative's score lies
    between ``low`` and ``high`` hundredths of the positive's.
    """
    rows = settle(rows.dropDuplicates(["id", "label", "vec"]), "vectors")
    n, n_anchors, short, dims, most = rows.agg(
        F.count("*"), F.count_if(anchor), F.min(F.size("vec")), F.max(F.size("vec")), F.max(F.array_max(F.transform("vec", lambda x: F.greatest(x, -x))))
    ).first()
    if n and short != dims:
        rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("vec"))))
    if most is not None and 0 <= most < 2**15:
        rows = rows.withColumn("vec", F.col("vec").cast("array<smallint>"))
    parts, blocks = max(1, -(-n // part)), max(1, -(-n_anchors // block))
    anchors = settle(rows.where(anchor), "anchors")
    nearest, schema = _nearest(n_positive)
    found = _meet(anchors, rows, blocks, parts, nearest, schema)
    # Both windows see a few rows of each part for an anchor; ranks are cut before the shuffle.
    by = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("score"), "positive_id", "positive_key")
    found = found.withColumn("place", F.row_number().over(by)).where(F.col("place") <= n_positive)
    positives = settle(found.select("anchor_id", "anchor_key", (F.col("place") - 1).alias("place"), "positive_id", F.col("score").alias("positive_score")), "positives")
    # At most n_positive entries in a list.
    scores = F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"])
    with_scores = positives.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_key").alias("key")).agg(scores.alias("scores"))
    banded, schema = _banded(n_negative, low, high)
    found = _meet(settle(anchors.join(with_scores, ["id", "key"]), "banded"), rows, blocks, parts, banded, schema)
    by = Window.partitionBy("anchor_id", "anchor_key", "place").orderBy(F.desc("score"), "negative_id", "negative_key")
    found = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= n_negative).withColumnRenamed("score", "negative_score")
    joined = found.join(positives, ["anchor_id", "anchor_key", "place"])
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of ``embeddings``; some labels are shifted, as the contract has it."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(prepare(table(spark, sf_dir, "embeddings"), label), F.col("id") % 100 == 0)


OP12_SQL = """
WITH whole AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
components AS (SELECT id, label, unnest(vec) AS c, generate_subscripts(vec, 1) AS dim FROM whole),
scores AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, CAST(sum(a.c * r.c) AS BIGINT) AS score
  FROM components a JOIN components r USING (dim) WHERE a.id % 100 = 0 AND a.id <> r.id GROUP BY ALL),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
