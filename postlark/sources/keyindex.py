"""The repeat keys of stored documents as an index: 128-bit hashes in hash buckets, each with a Bloom filter.

A batch asks the filters first, and only the buckets that may hold one of its keys are read. Small writes have few buckets
and large ones many, always powers of two, so that a bucket and its filter are bounded whatever the store holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.session import stage
from postlark.sources import versions
from postlark.sources.versions import Part, Version

KEYS, FILTERS = "keys", "filters"
KEYS_PER_BUCKET = 500_000
BITS_PER_KEY = 12
HASHES = 8
KEY_SCHEMA = "k1 bigint, k2 bigint, created_at timestamp, buckets int, write string, bucket int"
FILTER_SCHEMA = "buckets int, bucket int, folder string, bits binary"


def key_hashes(key: Column) -> list[Column]:
    """Two longs that stand for a repeat key; null for null."""
    return [F.when(key.isNotNull(), F.xxhash64(F.lit(salt), key)).alias(name) for salt, name in ((17, "k1"), (29, "k2"))]


def _places(k1: np.ndarray, k2: np.ndarray, n_bits: int) -> np.ndarray:
    """(hash, key): the bits that stand for each key."""
    one, two = k1.astype(np.uint64), k2.astype(np.uint64) | np.uint64(1)
    return (one + np.arange(HASHES, dtype=np.uint64)[:, None] * two) % np.uint64(n_bits)


def make_filter(k1: np.ndarray, k2: np.ndarray) -> bytes:
    bits = np.zeros(-(-max(1, len(k1) * BITS_PER_KEY) // 64) * 64, np.uint8)
    bits[_places(k1, k2, len(bits)).reshape(-1).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    packed = np.frombuffer(bits, np.uint8)
    places = _places(k1, k2, len(packed) * 8).astype(np.int64)
    return ((packed[places >> 3] >> (places & 7)) & 1).all(axis=0)


def _filters(keys: pa.Table) -> pa.Table:
    """The filter of a bucket's keys."""
    bits = make_filter(keys["k1"].to_numpy(), keys["k2"].to_numpy())
    return pa.table({"buckets": pa.array([keys["buckets"][0].as_py()], pa.int32()), "bucket": pa.array([keys["bucket"][0].as_py()], pa.int32()),
                     "bits": pa.array([bits], pa.binary())})


def write_keys(keys: DataFrame, root: str, batch: int) -> list[Part]:
    """Write distinct keys (k1, k2, created_at) and their filters; the parts to commit."""
    spark = keys.sparkSession
    kept = stage(keys, "keys")
    n = kept.count()
    if not n:
        return []
    buckets = 1 << max(0, (-(-n // KEYS_PER_BUCKET) - 1).bit_length())
    placed = kept.withColumn("buckets", F.lit(buckets)).withColumn("bucket", F.pmod("k1", F.lit(buckets)).cast("int"))
    dealt = placed.repartition(min(buckets, 1000), "bucket")
    parts = versions.write_parts(dealt, root, KEYS, cut="bucket")
    folder = parts[0].folder.rsplit("/", 1)[0]
    written = spark.read.schema(KEY_SCHEMA).option("basePath", f"{root}/{KEYS}").parquet(f"{root}/{folder}")
    made = written.select("buckets", "bucket", "k1", "k2").groupBy("bucket").applyInArrow(_filters, "buckets int, bucket int, bits binary")
    named = made.withColumn("folder", F.concat(F.lit(f"{folder}/bucket="), F.col("bucket").cast("string")))
    return versions.of_batch([*parts, *versions.write_parts(named, root, FILTERS)], batch)


def _asked(key, keys: pa.Table, filters: pa.Table) -> pa.Table:
    """The keys that each filter of their bucket may hold, with the bucket's folder."""
    k1, k2 = (keys[c].to_numpy() for c in ("k1", "k2"))
    hits: list[tuple[str, np.ndarray]] = []
    if len(k1):
        hits = [(folder, np.flatnonzero(may_hold(bits, k1, k2)))
                for folder, bits in zip(filters["folder"].to_pylist(), filters["bits"].to_pylist(), strict=True)]
    at = np.concatenate([np.zeros(0, np.int64), *(x for _, x in hits)])
    folders = [folder for folder, x in hits for _ in x]
    return pa.table({"k1": pa.array(k1[at], pa.int64()), "k2": pa.array(k2[at], pa.int64()), "folder": pa.array(folders, pa.string())})


def live(now: Version, without: int | None = None) -> list[Part]:
    """The key buckets of a version, but for those of a batch."""
    return [p for p in now.of(KEYS) if p.batch != without]


def candidates(keys: DataFrame, root: str, now: Version, without: int | None = None) -> tuple[DataFrame | None, list[Part]]:
    """Of distinct keys (k1, k2) those that some bucket may hold, and these buckets."""
    spark = keys.sparkSession
    parts = {p.folder: p for p in live(now, without)}
    filters = versions.read_parts(spark, root, FILTERS, FILTER_SCHEMA, [p for p in now.of(FILTERS) if p.batch != without])
    if not parts:
        return None, []
    sizes = [r.buckets for r in filters.select("buckets").distinct().collect()]  # powers of two
    asked = keys.withColumn("buckets", F.explode(F.array(*[F.lit(n) for n in sizes]))).withColumn(
        "bucket", F.pmod("k1", F.col("buckets")).cast("int"))
    met = asked.groupBy("buckets", "bucket").cogroup(filters.groupBy("buckets", "bucket")).applyInArrow(
        _asked, "k1 bigint, k2 bigint, folder string")
    hits = stage(met, "key_candidates")
    touched = [parts[r.folder] for r in hits.select("folder").distinct().collect() if r.folder in parts]  # as the version lists them
    return hits.select("k1", "k2").distinct(), touched


def known(keys: DataFrame, root: str, now: Version, without: int | None = None) -> DataFrame:
    """Of distinct keys (k1, k2) those that a stored document has. Keys of documents that retention has removed since are
    not known any more."""
    spark = keys.sparkSession
    hits, touched = candidates(keys, root, now, without)
    if not touched:
        return keys.select("k1", "k2").limit(0)
    stored = unexpired(versions.read_parts(spark, root, KEYS, KEY_SCHEMA, touched), now)
    return hits.join(stored.select("k1", "k2"), ["k1", "k2"], "left_semi")


def unexpired(keys: DataFrame, now: Version) -> DataFrame:
    cutoff = now.settings.get("cutoff")
    return keys.filter(F.col("created_at").isNull() | (F.col("created_at") >= F.lit(cutoff).cast("timestamp"))) if cutoff else keys


def stored_hashes(spark: SparkSession, root: str, now: Version) -> DataFrame:
    """(k1, k2) of all stored documents."""
    return unexpired(versions.read_parts(spark, root, KEYS, KEY_SCHEMA, live(now)), now).select("k1", "k2").distinct()


def compact_keys(spark: SparkSession, root: str, below: int) -> None:
    """Merge the buckets of batches below ``below`` (all of them ended) into one write, without expired and repeated keys."""
    now = versions.read_version(spark, root)
    old = [p for p in now.parts if p.table in (KEYS, FILTERS) and p.batch < below]
    if len({p.batch for p in old}) < 2:
        return
    rows = unexpired(versions.read_parts(spark, root, KEYS, KEY_SCHEMA, [p for p in old if p.table == KEYS]), now)
    never = F.max(F.col("created_at").isNull())
    merged = rows.groupBy("k1", "k2").agg(F.when(~never, F.max("created_at")).alias("created_at"))
    versions.commit(spark, root, versions.replacing(old, write_keys(merged, root, -below)))
