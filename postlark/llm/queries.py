"""The registered queries: each operator over its whole table, and the digest columns of its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.llm import (clusters, fingerprints, html, licenses, lines, minhash, mixing, negatives, packing, quality, sharding,
                          toxicity, warc)
from postlark.llm.common import n_words
from postlark.session import stage

SHARDS = 8


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_interleave(spark: SparkSession, folder: str) -> DataFrame:
    whole = F.coalesce("text", F.lit(""))
    rows = _table(spark, folder, "documents").select(
        "doc_id", "source", (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"))
    return sharding.interleave(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: by source and language, then five hundred to a directory and 25 to one below, of which the first
    is the licence file."""
    name = F.when(F.col("doc_id") % 25 == 0, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", "source", F.expr("cast(doc_id div 500 as string)"), F.expr("cast(doc_id div 25 as string)"), name)
    files = _table(spark, folder, "documents").select("doc_id", path.alias("path"), "text")
    return licenses.scan_files(files)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, folder, "documents"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write_bundles(_table(spark, folder, "pages"), warc.bundle_folder(spark))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(_table(spark, folder, "pages"))


def word_tokenizer() -> str:
    """The vocabulary file, which every executor has with its Python."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op7_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(_table(spark, folder, "documents"), word_tokenizer())


def op8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    rows = stage(docs, "sizes")
    assigned = mixing.assign_positions(rows, mixing.curriculum_plan(rows))
    return assigned.select(
        "doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).cast("long").alias("taken"), "repeats",
        F.get("positions", F.lit(0)).alias("position")).orderBy("position", "doc_id")  # untaken rows have no position


def op9_spread_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    return lines.remove_spread_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), percent=85)


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, folder, "labels").select("doc_id", "toxic"), learn=~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "hits")


def op12_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster(_table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, folder, "embeddings").withColumn("label", moved))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_interleave": op1_interleave,
    "op2_licenses": op2_licenses,
    "op3_simhash": op3_simhash,
    "op4_quality": op4_quality,
    "op5_warc": op5_warc,
    "op6_main_text": op6_main_text,
    "op7_best_fit": op7_best_fit,
    "op8_mixture": op8_mixture,
    "op9_spread_lines": op9_spread_lines,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_toxicity": op11_toxicity,
    "op12_clusters": op12_clusters,
    "op13_hard_negatives": op13_hard_negatives,
}
