"""Search responses: a JSON object whose ``statuses`` array holds the found posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESPONSE_SCHEMA = (
    "statuses ARRAY<STRUCT<created_at: STRING, id: BIGINT, text: STRING, "
    "user: STRUCT<name: STRING, location: STRING>>>"
)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """One response per line."""
    return spark.read.schema(RESPONSE_SCHEMA).json(path)


def parse_responses(responses: DataFrame, column: str = "value") -> DataFrame:
    return responses.select(F.from_json(column, RESPONSE_SCHEMA).alias("r")).select("r.*")


def found_posts(responses: DataFrame, target: str | None = None) -> DataFrame:
    """(username, id, created_at, location, text) of every status; those naming ``target`` if given."""
    found = responses.select(F.explode("statuses").alias("s")).select(
        F.col("s.user.name").alias("username"),
        F.col("s.id").alias("id"),
        F.col("s.created_at").alias("created_at"),
        F.col("s.user.location").alias("location"),
        F.col("s.text").alias("text"),
    )
    if target is None:
        return found
    return found.filter(F.contains(F.lower("text"), F.lit(target.lower())))
