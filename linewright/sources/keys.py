"""Object listings and the manifest of keys already taken in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewright.functions.text import literal
from linewright.operators.sizing import settle
from linewright.sources.published import new_run

KEY = r"<Key>([^\n]*?)</Key>"
_BASE, _DELTA, _MERGED = "base-", "delta-", "merged-"


def list_keys(listings: DataFrame, text: str = "value") -> DataFrame:
    """Distinct ``key`` of every ``<Key>…</Key>`` in listing texts (pages or lines)."""
    keys = F.regexp_extract_all(text, F.lit(KEY), F.lit(1))
    return listings.select(F.explode(keys).alias("key")).distinct()


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Keys of stored listing pages. Each page is one row."""
    return list_keys(spark.read.text(path, wholetext=True))


def keys_of_json(texts: DataFrame, text: str = "value") -> DataFrame:
    """Keys of JSON array texts; anything that is no array of text gives no keys."""
    keys = F.from_json(text, "array<string>")
    return texts.select(F.explode(keys).alias("key")).where("key is not null").distinct()


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _done(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Names of the finished folders ``kind=…`` below ``path``, oldest first; one without
    _SUCCESS does not count."""
    jvm, folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    finished = lambda n: fs.exists(jvm.org.apache.hadoop.fs.Path(folder, f"{n}/_SUCCESS"))
    return sorted(n for n in names if n.startswith(kind) and finished(n))


def _parts(spark: SparkSession, path: str) -> tuple[str | None, list[str]]:
    """The newest base, and the deltas that it does not hold.

    A base lists the deltas merged into it, so one that a writer added meanwhile is still read.
    """
    bases = _done(spark, path, _BASE)
    base = bases[-1] if bases else None
    merged = _merged(spark, path, base)
    return base, [d for d in _done(spark, path, _DELTA) if d not in merged]


def _merged(spark: SparkSession, path: str, base: str | None) -> set[str]:
    """The deltas in a base: a name per update that was ever merged, not per key."""
    if base is None:
        return set()
    return {r.delta for r in spark.read.schema("delta string").parquet(f"{path}/{_MERGED}{base[len(_BASE):]}").collect()}


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Known keys: a manifest table of this library, or a JSON array file.

    A missing path, broken JSON or a JSON value that is no array gives no keys.
    """
    none = spark.createDataFrame([], "key string")
    if path.endswith(".json"):
        _, file, fs = _folder(spark, path)
        if not fs.exists(file):
            return none
        return keys_of_json(spark.read.text(path, wholetext=True))
    base, deltas = _parts(spark, path)
    folders = [f"{path}/{name}" for name in ([base] if base else []) + deltas]
    if not folders:
        return none
    return spark.read.schema("key string").parquet(*folders)


def union_keys(manifest: DataFrame, taken: DataFrame) -> DataFrame:
    return manifest.select("key").union(taken.select("key")).distinct()


def update_manifest(spark: SparkSession, path: str, taken: DataFrame) -> bool:
    """Add the keys of ``taken`` that the manifest does not hold, as one delta.

    What is written follows the new keys alone; no known key is written again. A delta has
    a folder of its own, so writers never touch each other's, and readers see it when it
    is complete. A key that two writers add at once stands in both deltas until
    ``compact_manifest``. Nothing is written when nothing is new.
    """
    fresh = settle(new_keys(taken, read_manifest(spark, path)))
    if fresh.isEmpty():
        return False
    fresh.write.parquet(f"{path}/{_DELTA}{new_run()}")
    return True


def compact_manifest(spark: SparkSession, path: str, *, buckets: int = 64) -> bool:
    """Merge the deltas into a new base of distinct keys in ``buckets`` hash buckets.

    The list of merged deltas is written before the base, so a base that is seen is whole.
    Deltas that come in meanwhile are not on the list and go on being read.
    """
    base, deltas = _parts(spark, path)
    if not deltas:
        return False
    run = new_run()
    known = _merged(spark, path, base)
    spark.createDataFrame([(d,) for d in sorted({*known, *deltas})], "delta string").write.parquet(f"{path}/{_MERGED}{run}")
    keys = spark.read.schema("key string").parquet(*(f"{path}/{n}" for n in ([base] if base else []) + deltas)).distinct()
    keys.repartition(buckets, "key").sortWithinPartitions("key").write.parquet(f"{path}/{_BASE}{run}")
    return True


def new_keys(found: DataFrame, manifest: DataFrame, base_url: str | None = None) -> DataFrame:
    """Distinct keys that the manifest does not hold, with their ``url`` if a base is given."""
    fresh = found.select("key").distinct().join(manifest.select("key"), "key", "left_anti")
    if base_url is None:
        return fresh
    return fresh.selectExpr("key", f"concat({literal(base_url.rstrip('/'))}, '/', key) as url")


def key_of_url(url: str) -> str:
    """Expression: the last path part."""
    return f"substring_index({url}, '/', -1)"


def log_file_name(taken_at: str, key: str) -> str:
    """Expression: file name of a fetched key, ``yyyyMMdd_HHmmss_<key>.txt``."""
    return f"concat(date_format({taken_at}, 'yyyyMMdd_HHmmss'), '_', {key}, '.txt')"
