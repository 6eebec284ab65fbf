"""Near-duplicates by MinHash: universal hash minima, banding, links confirmed on whole shingle sets, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.llm.components import components
from postlark.session import stage

SHINGLE_WORDS = 5
BANDS, ROWS = 32, 7
PERCENT = 80
BLOCK_SHINGLES = 2_000_000
CHUNK = 1 << 15
SEED = 20_250_101

_SIGNED = pa.int64()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _numbers(seed: int, count: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, count, np.uint64) | np.uint64(1)


@cache
def _byte_values() -> np.ndarray:
    """A random number for each byte; A-Z count as a-z, and white space is marked by 0."""
    values = _numbers(SEED, 256).copy()
    values[65:91] = values[97:123]
    values[[32, *range(9, 14)]] = 0
    return values


BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each run of bytes that are not white space, with A-Z lower-cased, and where each begins.

    The hashes are of a polynomial in random byte values, read off its running sums.
    """
    values = _byte_values()[data]
    inside = np.concatenate([[False], values != 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(BASE, len(data)))])
    return _mixed((sums[end] - sums[begin]) * _powers(INVERSE, len(data) + 1)[begin]), begin


def shingle_set(data: bytes) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of five words; of all its words, if they are fewer; none without words."""
    if not data:
        return np.zeros(0, np.uint64)
    words, _ = word_hashes(np.frombuffer(data, np.uint8))
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(SHINGLE_WORDS, len(words))
    runs = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        runs = _mixed(runs * BASE + words[k : len(words) - width + 1 + k])
    return np.unique(runs)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash (an odd multiple and an offset, modulo 2^64, of mixed shingles)."""
    count = BANDS * ROWS
    factors, offsets = _numbers(SEED + 1, count), _numbers(SEED + 2, count)
    least = np.full(count, np.uint64(2**64 - 1))
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at : at + CHUNK]
        for i in range(count):
            least[i] = min(least[i], (part * factors[i] + offsets[i]).min())
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = _mixed(keys * BASE + column)
    return keys


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    return tuple(int(x.view(np.int64)) for x in (
        np.bitwise_xor.reduce(_mixed(shingles * BASE + np.uint64(k))) + np.uint64(len(shingles)) for k in (1, 2)))


def _signed(batches: Iterator[pa.RecordBatch], with_bands: bool, with_set: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("_text")
        keys, rows = batch.drop_columns(["_text"]), ([], [], [], [])
        for value in batch.column(at):
            found = shingle_set(value.as_py() or b"")
            a, b = _set_key(found) if len(found) else (0, 0)
            for column, x in zip(rows, (len(found), a, b, found.view(np.int64) if with_set else
                                        band_keys(signature(found)).view(np.int64) if with_bands and len(found) else None), strict=True):
                column.append(x)
        made = [pa.array(rows[0], _SIGNED), pa.array(rows[1], _SIGNED), pa.array(rows[2], _SIGNED), pa.array(rows[3], pa.list_(_SIGNED))]
        yield pa.RecordBatch.from_arrays([*keys.columns, *made], names=[*keys.schema.names, "n_shingles", "k1", "k2", "numbers"])


def _shingled(docs: DataFrame, columns: list[str], text: str, bands: bool) -> DataFrame:
    rows = docs.select(*columns, F.col(text).cast("binary").alias("_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.drop("_text").schema)
    return rows.mapInArrow(lambda batches: _signed(batches, bands, not bands),
                           f"{kinds}n_shingles bigint, k1 bigint, k2 bigint, numbers array<bigint>")


def candidate_groups(classes: DataFrame) -> DataFrame:
    """``node`` and ``component`` for the classes (``node``, ``bands``) that meet another in a band, over any number of
    bands and classes; those that do not are left out. In each bucket all link to its smallest member, not to each other."""
    laid = classes.select("node", F.explode("bands").alias("band"))
    hubs = laid.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("_last")).filter("hub <> _last")
    links = laid.join(hubs, "band").filter("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    found = stage(components(links), "groups")
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def _linked(percent: int):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        """Of the links between two blocks, or within one, as many as join all that they join."""
        group = group.drop_duplicates("node")
        nodes, blocks = group["node"].to_numpy(), group["block"].to_numpy()
        first, second = int(group["one"].iloc[0]), int(group["two"].iloc[0])
        sets = [np.asarray(x, np.int64) for x in group["numbers"]]
        sizes = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        owner, values = owner[order], values[order]
        edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
        runs = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        shared = np.diff(edges)[runs] > 1
        by_owner = np.argsort(owner[shared], kind="stable")
        mine, run = owner[shared][by_owner], runs[shared][by_owner]
        bounds = np.searchsorted(mine, np.arange(len(sets) + 1))
        parent = list(range(len(sets)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        found = []
        for i in np.flatnonzero(blocks == first):
            own = run[bounds[i] : bounds[i + 1]]
            if not len(own):
                continue
            starts, lengths = edges[own], edges[own + 1] - edges[own]
            ends = np.cumsum(lengths)
            meet = owner[np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)]
            common = np.bincount(meet, minlength=len(sets))
            close = (100 * common >= percent * (sizes[i] + sizes - common)) & (blocks == second)
            if first == second:
                close[: i + 1] = False
            for j in np.flatnonzero(close):
                a, b = root(i), root(j)
                if a != b:
                    parent[b] = a
                    found.append((nodes[i], nodes[j]))
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return link


def confirmed_links(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (``u``, ``v``) of the members (``node``, ``component``, ``n_shingles``, ``numbers``: the whole set) of which
    the sets of the same group meet in at least ``percent`` of their union. Links between members that are joined already
    may be left out.

    A group is dealt into blocks of some two million shingles and a task has the pair of blocks, so none holds more
    however large the group is. Within a task the members meet over the shingles that they share.
    """
    sizes = members.groupBy("component").agg(F.sum("n_shingles").alias("_all"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_all") / BLOCK_SHINGLES)).cast("int")
    dealt = members.join(sizes, "component").withColumn("_blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    pairs = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "node", "component", "numbers", "block", F.least("block", "_other").cast("int").alias("one"),
        F.greatest("block", "_other").cast("int").alias("two"))
    return pairs.groupBy("component", "one", "two").applyInPandas(_linked(percent), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """For each row ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id that it can reach over links, its own
    included) and ``kept`` (whether that is its own).

    A text's set holds its distinct runs of five words, A-Z lower-cased; with fewer words, the one run of them all. Two
    texts are linked if their sets meet in at least ``percent`` of their union, counted on the whole sets (as 64-bit hashes).
    Candidates agree in one of 32 bands of seven minima: a pair at 80 per cent is missed with a chance of 4 in 10,000, one
    at 85 of 4 in a million.

    Texts without words, null among them, are linked with nothing. Equal sets are one node, so copies, repeated rows
    and ids that occur more than once cost no pairs; a null id counts only where no other is there. No rows give no rows.
    """
    read = stage(_shingled(docs, ["doc_id"], text, bands=True), "signatures")
    worded = read.filter("n_shingles > 0")
    node = F.xxhash64("k1", "k2").alias("node")
    classes = stage(worded.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("least"), F.min("n_shingles").alias("n_shingles"), F.first("numbers").alias("bands"))
        .select(node, "k1", "k2", "least", "n_shingles", "bands"), "classes")
    groups = stage(candidate_groups(classes), "candidates")
    # One document stands for each class in a group, and its text is read again.
    chosen = classes.join(groups, "node").select("node", "component", "n_shingles", F.col("k1").alias("_k1"), F.col("k2").alias("_k2"),
                                                 F.col("least").alias("_id"))
    texts = chosen.hint("shuffle_hash").join(docs.select("doc_id", text), F.col("doc_id").eqNullSafe(F.col("_id")))
    sets = _shingled(texts, ["node", "component", "_k1", "_k2"], text, bands=False).filter("k1 = _k1 and k2 = _k2")
    joined = stage(components(confirmed_links(sets.select("node", "component", "n_shingles", "numbers"), percent)), "components")
    named = (
        classes.select("node", "least").join(joined, "node", "left")
        .select("node", "least", F.coalesce("component", "node").alias("component")))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = stage(named.join(smallest, "component").select("node", "component_id"), "smallest")
    rows = read.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, node).alias("node"))
    return (
        rows.join(of_node, "node", "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
