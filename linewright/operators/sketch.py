"""Exact membership of names as a filter without a join: a cascade of Bloom filters.

The first filter holds the names of ``inside``. Names of ``outside`` that it wrongly holds go into
a second one, names of ``inside`` that this one holds into a third, and so on; each level is about
a hundredth of the one before, and the last holds nothing by mistake. For every name of the two
tables the answer is exact. Sizes follow the number of names, about 2 bytes each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewright.operators.sizing import BROADCAST_BYTES, settle

HASHES = 5
BITS_PER_NAME = 12
MAX_LEVELS = 30


def _places(name: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level * HASHES + k), name), F.lit(bits)) for k in range(HASHES)]


def _words(names: DataFrame, level: int, bits: int) -> DataFrame:
    """One row with the filter's bits as an array of longs; bits are merged on the map side."""
    places = names.select(F.explode(F.array(*_places(F.col("name"), level, bits))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    found = places.groupBy((F.col("place") / 64).cast("bigint").alias("id")).agg(F.bit_or(bit).alias("bits"))
    dense = names.sparkSession.range(bits // 64).join(found, "id", "left")
    by_id = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return dense.agg(F.transform(by_id, lambda x: x["bits"]).alias("words"))


def _holds(words: Column, name: Column, level: int, bits: int) -> Column:
    bit_at = lambda p: F.call_function("shiftright", F.get(words, (p / 64).cast("int")), (p % 64).cast("int")).bitwiseAND(F.lit(1))
    found = F.lit(True)
    for place in _places(name, level, bits):
        found = found & (bit_at(place) == 1)
    return found


def member(inside: DataFrame, outside: DataFrame, max_bytes: int = BROADCAST_BYTES) -> Callable[[Column], Column] | None:
    """A test for names of ``inside``, exact for all names of both tables (column ``name``).

    None if the first filter would take more than ``max_bytes``. The filters are scalar
    subqueries: no table that is tested is shuffled.
    """
    levels: list[tuple[DataFrame, int]] = []
    here, there = settle(inside.distinct()), outside
    for level in range(MAX_LEVELS):
        n = here.count()
        if not n:
            break
        bits = 1 << max(10, (n * BITS_PER_NAME - 1).bit_length())
        if bits // 8 > max_bytes:
            return None
        words = settle(_words(here, level, bits))
        levels.append((words, bits))
        wrong = settle(there.where(_holds(words.scalar(), F.col("name"), level, bits)).distinct())
        here, there = wrong, here
    else:
        return None

    def test(name: Column) -> Column:
        found = F.lit(False)
        for level in range(len(levels) - 1, -1, -1):
            words, bits = levels[level]
            found = _holds(words.scalar(), name, level, bits) & ~found
        return found

    return test
