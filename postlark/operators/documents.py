"""Posts as stored documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.functions.links import first_link
from postlark.functions.text import list_text
from postlark.operators.aggregators import from_aggregator
from postlark.operators.joins import count_rows, lookup
from postlark.sources.sites import AGGREGATOR_SITES

NO_CONTACTS = "[]"
SCORE_FIELDS = ("avg_tweet_freq", "avg_tweet_reg", "tweet_freq_variance", "is_bot")


def stored_id() -> Column:
    """A repost is stored under the original's id."""
    return F.when(F.col("is_retweet"), F.col("retweeted.id")).otherwise(F.col("id")).cast("string")


def post_fields() -> list[Column]:
    """The five text fields every stored form of a post has."""
    return [
        F.col("source"),
        stored_id().alias("tweet_id"),
        F.col("text"),
        F.col("favorites").cast("string").alias("favorites"),
        F.coalesce("place", F.lit("")).alias("place"),
    ]


def to_documents(posts: DataFrame, sites: Sequence[str] = AGGREGATOR_SITES) -> DataFrame:
    """Document rows. Columns ``phone``, ``email`` and ``link`` are used when already present."""
    have = set(posts.columns)

    def contacts(name: str) -> Column:
        return F.coalesce(list_text(F.col(name)), F.lit(NO_CONTACTS)) if name in have else F.lit(NO_CONTACTS)

    link = F.col("link") if "link" in have else first_link(F.col("text"))
    return posts.select(
        F.col("id").alias("post_id"),
        *post_fields(),
        "user",
        contacts("phone").alias("phone"),
        contacts("email").alias("email"),
        F.coalesce(link, F.lit("")).alias("link"),
        F.md5("text").alias("hash"),
        "created_at",
        from_aggregator(F.col("source"), sites).alias("third_party"),
        F.lit(None)
        .cast("struct<avg_tweet_freq:bigint,avg_tweet_reg:bigint,tweet_freq_variance:bigint,is_bot:boolean>")
        .alias("metadata"),
        "is_retweet",
    )


def write_back_scores(documents: DataFrame, scores: DataFrame, user_id: Column | None = None) -> DataFrame:
    """Set ``metadata`` on all documents of a scored user; others keep theirs."""
    user_id = F.col("user.id") if user_id is None else user_id
    keyed = documents.withColumn("user_id", user_id)
    fresh = scores.select("user_id", F.struct(*SCORE_FIELDS).alias("_new"))
    return (
        lookup(keyed, fresh, ["user_id"], ["post_id"], count_rows(keyed, ["user_id"]))
        .withColumn("metadata", F.coalesce("_new", "metadata"))
        .drop("_new", "user_id")
    )


def retain(documents: DataFrame, cutoff: Column, created: str = "created_at") -> DataFrame:
    """Drop what is older than the cutoff; a document without a time stays."""
    return documents.filter(F.col(created).isNull() | (F.col(created) >= cutoff))


def retention_cutoff(now: Column, days: int = 30) -> Column:
    return now - F.make_interval(days=F.lit(days))
