"""First arrival wins among posts with the same first link or the same text."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlark.functions.links import first_link, repeat_key
from postlark.session import stage
from postlark.sources import keyindex, versions


def with_repeat_key(posts: DataFrame, text: str = "text") -> DataFrame:
    """Add ``link`` (null when there is none) and ``repeat_key``; the link is searched for once."""
    linked = posts.withColumn("link", first_link(F.col(text)))
    return linked.withColumn("repeat_key", repeat_key(F.col(text), F.col("link")))


def first_arrivals(posts: DataFrame, by: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """One row per repeat key, the earliest.

    ``row_number = 1`` makes Spark keep one candidate per key in each task before the shuffle, so
    a key with a third of all posts sends one row per task.
    """
    if "repeat_key" not in posts.columns:
        posts = with_repeat_key(posts)
    arrival = Window.partitionBy("repeat_key").orderBy(*by)
    return posts.withColumn("_rn", F.row_number().over(arrival)).filter("_rn = 1").drop("_rn")


Derive = Callable[[DataFrame | None], DataFrame]  # posts, or of them those with the times and ids of a table's rows


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equal in all of these columns, where null equals null."""
    return reduce(and_, [left[name].eqNullSafe(right[name]) for name in names])


def arrivals(keyed: DataFrame, by: Sequence[str] = ("created_at", "id")) -> DataFrame:
    """(repeat_key, by, n_alike) of the first arrivals, without the posts' other columns; ``n_alike`` is the number of rows
    that have these times and ids, under whatever key."""
    slim = keyed.select("repeat_key", *by)
    alike = slim.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.count(F.lit(1)).alias("n_alike"))
    both = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return first_arrivals(slim, tuple(by)).join(alike, both).select(*slim.columns, "n_alike")


def posts_of(derive: Derive, chosen: DataFrame, by: Sequence[str] = ("created_at", "id")) -> DataFrame:
    """The posts that rows of ``arrivals``, written before, stand for.

    Times and ids alone say which posts are derived, so texts are joined to these only, and are neither shuffled nor sorted
    for their keys. Only where several rows have a chosen time and id are these told apart by their keys, and one of each taken.
    """
    found = with_repeat_key(derive(chosen.filter("n_alike = 1")))
    many = chosen.filter("n_alike > 1")
    if many.isEmpty():
        return found
    keyed = with_repeat_key(derive(many))
    alike = keyed.join(many, same(keyed, many, ["repeat_key", *by]), "left_semi")
    return found.unionByName(first_arrivals(alike, tuple(by)))


def first_derived(derive: Derive, by: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """``first_arrivals`` of posts whose texts are joined to them from another table: they are derived twice, once for their
    keys and once for the rows that are first."""
    return posts_of(derive, stage(arrivals(with_repeat_key(derive(None)), by), "arrivals"), by)


def stored_keys(documents: DataFrame, *keep: str) -> DataFrame:
    """Repeat keys of stored documents: of the link where one is stored, of the hash otherwise."""
    return documents.select(
        *keep,
        F.when(F.col("link") != "", F.concat(F.lit("L:"), F.col("link")))
        .otherwise(F.concat(F.lit("H:"), F.col("hash")))
        .alias("repeat_key")
    ).distinct()


def new_posts(posts: DataFrame, documents: DataFrame, by: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """First arrivals that no stored document repeats. Both sides have unique keys: no skew."""
    return first_arrivals(posts, by).join(stored_keys(documents), "repeat_key", "left_anti")


def _unknown(first: DataFrame, root: str, batch_id: int | None, name: str) -> DataFrame:
    """Rows (one for each repeat key) whose key no stored document of another batch has."""
    spark = first.sparkSession
    hashed = stage(first.select("*", *keyindex.key_hashes(F.col("repeat_key"))), name)
    now = versions.read_version(spark, root)
    known = keyindex.known(hashed.select("k1", "k2").dropna().distinct(), root, now, without=batch_id)
    return hashed.join(known, ["k1", "k2"], "left_anti").select(*first.columns)


def unseen_posts(posts: DataFrame, root: str, batch_id: int | None = None, by: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """First arrivals that no stored document of another batch repeats, by the store's key index.

    The distinct keys of the posts ask the index's filters, and of the stored keys only the buckets that may hold one of
    them are read. A post whose text is null has no key and is kept.
    """
    return _unknown(first_arrivals(posts, by), root, batch_id, "arrivals")


def unseen_derived(
    derive: Derive, keys: DataFrame, root: str, batch_id: int | None = None, by: tuple[str, ...] = ("created_at", "id"),
) -> DataFrame:
    """``unseen_posts`` of posts that are derived again (``first_derived``); ``keys`` are their repeat keys, times and ids,
    written before."""
    fresh = stage(_unknown(arrivals(keys, by), root, batch_id, "arrivals"), "fresh")
    return posts_of(derive, fresh, by)


def insert_status(posts: DataFrame, documents: DataFrame, by: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """Every post with ``inserted`` or ``duplicate``.

    The first arrival per key is found on ids alone, and rows with its id and key are numbered: of
    a post that was delivered several times one is inserted. Both the join and the numbering go by
    the id, so the posts are shuffled once.
    """
    keyed = posts if "repeat_key" in posts.columns else with_repeat_key(posts)
    winners = new_posts(keyed.select("id", "created_at", "repeat_key"), documents, by).select(
        F.col("id").alias("_id"), F.col("repeat_key").alias("_key")
    )
    delivery = Window.partitionBy("id", "repeat_key").orderBy(*by)
    first = F.col("_id").isNotNull() & (F.col("_rn") == 1)
    return (
        keyed.join(winners, (F.col("id") == F.col("_id")) & (F.col("repeat_key") == F.col("_key")), "left")
        .withColumn("_rn", F.row_number().over(delivery))
        .withColumn("status", F.when(first, "inserted").otherwise("duplicate"))
        .drop("_id", "_key", "_rn")
    )
