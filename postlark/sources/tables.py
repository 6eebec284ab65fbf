"""The given Parquet tables, and the posts that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.sources.messages import POST_FIELDS


TEXT_TABLES = ("documents", "pages")


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(table) if name in TEXT_TABLES else table


SPREAD_BYTES = 32_000_000


def spread(table: DataFrame) -> DataFrame:
    """Give every core a share of a table with less than SPREAD_BYTES for each of them.

    Texts are costly to read through and one row group is one task, so a small table would keep few
    cores busy. What is shuffled is bounded by SPREAD_BYTES per core; a larger table is left as it
    is. The size is the scan's own estimate. The first column is the id that joins use.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return table.repartition(cores, table.columns[0]) if size < cores * SPREAD_BYTES else table


def _count(spark: SparkSession, folder: str, name: str) -> Column:
    """Number of rows, from the files' own counts."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(F.count(F.lit(1))).scalar()


def posts_from(events: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """One post per event, in the shape of a message's post.

    The event gives id, time and user; a document gives the text, to which hashtags, some
    keywords and for two events in three a link are appended; a page gives the source. Document
    and page ids are dense from 0, so ids modulo the counts spread the events over them. Texts are
    joined last: a text is shuffled once per document, not once per post. Works on a stream of
    events too.
    """
    keyed = events.withColumns(
        {
            "doc_id": F.col("event_id") % _count(spark, folder, "documents"),
            "page_id": F.col("event_id") % _count(spark, folder, "pages"),
        }
    )
    pages = load(spark, folder, "pages").select("page_id", "url")
    docs = load(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("doc_text"), "lang", F.col("source").alias("doc_source")
    )
    event_id, kind = F.col("event_id"), F.col("event_type")
    user_id = F.col("user_id").cast("string")
    text = F.concat(
        F.col("doc_text"), F.lit(" #"), kind,
        F.lit(" #K"), F.get_json_object("props", "$.k"),
        F.when(kind == "purchase", " Hiring").when(kind == "click", " career").otherwise(""),
        F.when(event_id % 3 == 0, "").otherwise(
            F.concat(F.lit(" http://t.co/"), (event_id % 997).cast("string"))
        ),
    )
    return (
        keyed.join(pages, "page_id")
        .join(docs, "doc_id")
        .select(
            event_id.alias("id"),
            text.alias("text"),
            "lang",
            F.col("ts").cast("timestamp").alias("created_at"),
            F.col("url").alias("source"),
            F.floor("value").cast("bigint").alias("favorites"),
            F.when(event_id % 4 != 0, F.col("doc_source")).alias("place"),
            (kind == "view").alias("is_retweet"),
            F.when(kind == "view", F.struct((event_id - event_id % 10).alias("id"))).alias("retweeted"),
            F.struct(
                F.col("user_id").alias("id"),
                F.concat(F.lit("user"), user_id, F.when(kind == "signup", "_new").otherwise("")).alias(
                    "screen_name"
                ),
                F.concat(F.lit("User "), user_id).alias("name"),
                F.col("doc_source").alias("location"),
            ).alias("user"),
        )
        .select(*POST_FIELDS)
    )


def posts(spark: SparkSession, folder: str, only: DataFrame | None = None) -> DataFrame:
    """The posts of all events, or of those with the id and time of a row of ``only``, where null equals null."""
    events = spread(load(spark, folder, "events"))
    if only is not None:
        at = F.col("ts").cast("timestamp").eqNullSafe(only["created_at"])
        events = events.join(only, F.col("event_id").eqNullSafe(only["id"]) & at, "left_semi")
    return posts_from(events, spark, folder)


def history(spark: SparkSession, folder: str) -> DataFrame:
    """(user_id, ts, post_id) of every event."""
    return load(spark, folder, "events").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("post_id")
    )


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a quality label, as (doc_id, text, label)."""
    labels = load(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return load(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of files."""
    schema = load(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


def post_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Posts of streamed events, the other tables being static.

    A batch comes from few files; its events are spread before texts are joined to them.
    """
    cores = spark.sparkContext.defaultParallelism
    return posts_from(event_stream(spark, folder).repartition(cores, "event_id"), spark, folder)
