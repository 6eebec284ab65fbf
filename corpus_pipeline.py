"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.llm import lines, minhash, mixing, packing, quality
from postlark.llm.common import n_words
from postlark.llm.queries import word_tokenizer
from postlark.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it now is."""
    return rows.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. The verdict hangs on text and language alone, so the rejected pairs of them, by
    digest, say which documents go; no pair of rows is multiplied, whatever ids repeat."""
    lang = [F.coalesce("lang", F.lit("")), F.col("lang").isNull()]
    whole = F.coalesce("text", F.lit(""))
    digest = [F.xxhash64(whole, *lang).alias("_q1"), F.xxhash64(F.lit(7), whole, *lang).alias("_q2")]
    judged = quality.assess(docs.select("text", "lang", *digest), keys=("_q1", "_q2"))
    rejected = judged.filter(~F.col("kept")).select("_q1", "_q2").distinct()
    return _documents(docs.select(*COLUMNS, *digest).join(rejected, ["_q1", "_q2"], "left_anti"))


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are spread over many sites."""
    return _documents(lines.remove_spread_lines(docs.select(*COLUMNS)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest id (null ids last); rows of texts without words all
    stay. A row is known by its id and its text's digest, so null and repeated ids join nothing that the texts do not."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *lines.text_digest(F.col("text")))
    keyed = docs.select(*COLUMNS, row.alias("_row"))
    gone = minhash.near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text")).filter(~F.col("kept")).select(
        F.col("doc_id").alias("_row")).distinct()
    worded = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    one_each = keyed.filter(worded).join(gone, "_row", "left_anti").dropDuplicates(["_row"])
    return _documents(one_each.unionByName(keyed.filter(~worded)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, each as often as the mixture takes it."""
    sized = docs.select(*COLUMNS, n_words(F.col("text")).alias("size"))
    plan = mixing.curriculum_plan(sized.select("source", "size"))
    return _documents(mixing.in_training_order(mixing.assign_positions(sized, plan, ties=("doc_id", "n_chars", "size"))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes. A document that comes several times is packed as often."""
    return packing.packed_documents(docs, word_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", drop_low_quality),
    ("line dedup", remove_boilerplate),
    ("near-duplicates", drop_near_duplicates),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # tokenizing and hashing are beyond SQL; tests check what each operator does and what the whole keeps


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
