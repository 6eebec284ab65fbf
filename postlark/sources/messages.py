"""Posts on a message stream: base64 of JSON, with undecodable messages set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.functions.text import bind

POST_SCHEMA = (
    "id BIGINT, text STRING, lang STRING, created_at TIMESTAMP, source STRING, favorites BIGINT, "
    "place STRING, is_retweet BOOLEAN, retweeted STRUCT<id: BIGINT>, "
    "user STRUCT<id: BIGINT, screen_name: STRING, name: STRING, location: STRING>"
)
POST_FIELDS = (
    "id", "text", "lang", "created_at", "source", "favorites", "place", "is_retweet", "retweeted", "user",
)
_JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def encode_post(post: Column) -> Column:
    """Envelope of a post struct, on one line; null stays null."""
    json = F.to_json(post, _JSON_OPTIONS)
    return F.replace(F.base64(json.cast("binary")), F.lit("\r\n"), F.lit(""))


def decode_post(value: Column, schema: str = POST_SCHEMA) -> Column:
    """Post struct of an envelope, null when it is no base64, no UTF-8, no JSON or has no id. It is parsed once."""
    payload = F.try_to_binary(value.cast("string"), F.lit("base64"))
    post = F.from_json(F.try_validate_utf8(payload.cast("string")), schema, _JSON_OPTIONS)
    return bind(post, lambda p: F.when(p["id"].isNotNull(), p))


def encode_posts(posts: DataFrame) -> DataFrame:
    """Keyless messages (key, value) of posts."""
    return posts.select(
        F.lit(None).cast("binary").alias("key"),
        encode_post(F.struct(*POST_FIELDS)).cast("binary").alias("value"),
    )


def decode_messages(messages: DataFrame, *keep: str) -> DataFrame:
    """Add ``post`` (null when undecodable) to the messages; only the value is looked at."""
    return messages.select(*keep, "value", decode_post(F.col("value")).alias("post"))


def valid_posts(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("post").isNotNull()).select("post.*")


def decoded_posts(messages: DataFrame) -> DataFrame:
    """``valid_posts(decode_messages(messages))``, where conditions on the posts do not decode them again: none is moved below
    the generator."""
    post = decode_post(F.col("value"))
    return messages.select(F.inline(F.array_compact(F.array(post))))


def rejected_messages(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("post").isNull()).drop("post")


def read_messages(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """Streaming messages of one or more comma-separated topics. Needs the Kafka connector."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .options(**options)
        .load()
    )


def read_message_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Streaming messages from a folder of text files, one message per line."""
    return spark.readStream.options(**options).text(path)


def write_messages(posts: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish posts, the leader's acknowledgement being enough. Needs the Kafka connector."""
    (
        encode_posts(posts)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "1")
        .option("topic", topic)
        .options(**options)
        .save()
    )


def write_message_files(posts: DataFrame, path: str) -> None:
    encode_posts(posts).select(F.col("value").cast("string")).write.mode("append").text(path)
