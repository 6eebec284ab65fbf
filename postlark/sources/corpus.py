"""The labelled corpus: one post per line, six fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.functions.text import one_line
from postlark.functions.times import parse_corpus_time

# Delimiter and field order of a corpus line.
DELIMITER = "|#|"
FIELDS = ("username", "id", "created_at", "location", "text", "label")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Whole lines; only the newline ends one, as only newlines are replaced on writing."""
    return spark.read.option("lineSep", "\n").text(path)


def parse_corpus(lines: DataFrame) -> DataFrame:
    """Typed fields plus ``ok``: six fields, a number as id and as label."""
    fields = lines.select("value", F.split("value", r"\|#\|", -1).alias("f"))
    get = {name: F.get("f", F.lit(i)) for i, name in enumerate(FIELDS)}
    typed = fields.select(
        "value",
        get["username"].alias("username"),
        get["id"].try_cast("bigint").alias("id"),
        parse_corpus_time(get["created_at"]).alias("created_at"),
        get["location"].alias("location"),
        get["text"].alias("text"),
        get["label"].try_cast("double").alias("label"),
        F.size("f").alias("n_fields"),
    )
    return typed.withColumn(
        "ok", (F.col("n_fields") == len(FIELDS)) & F.col("id").isNotNull() & F.col("label").isNotNull()
    )


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return parse_corpus(read_lines(spark, path)).filter("ok").select(*FIELDS)


def read_corpus_rejects(spark: SparkSession, path: str) -> DataFrame:
    return parse_corpus(read_lines(spark, path)).filter("NOT ok").select("value")


def corpus_line(label: Column) -> Column:
    """Line of a found post (username, id, created_at text, location, text) with its label."""
    return F.concat_ws(
        DELIMITER,
        F.coalesce(one_line(F.col("username")), F.lit("")),
        F.col("id").cast("string"),
        F.coalesce(F.col("created_at"), F.lit("")),
        F.coalesce(one_line(F.col("location"), ""), F.lit("")),
        F.coalesce(one_line(F.col("text")), F.lit("")),
        label.cast("string"),
    )


def append_corpus(posts: DataFrame, path: str, label: Column | None = None) -> None:
    """Append labelled lines; the label is set by whoever collects, 0 unless given."""
    lines = posts.select(corpus_line(F.lit("0") if label is None else label).alias("value"))
    lines.write.mode("append").option("lineSep", "\n").text(path)
