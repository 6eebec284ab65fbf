"""Scoring, duplicate removal and storing of posts as they arrive."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlark.operators.blocks import predict_texts
from postlark.operators.classify import NaiveBayesTables
from postlark.operators.dedup import first_arrivals, unseen_posts, with_repeat_key
from postlark.operators.documents import to_documents
from postlark.operators.features import with_tokens, word_count
from postlark.operators.filters import accepted, has_keyword, in_language_and_long, is_wanted, score_or_zero
from postlark.operators.graph import graph_rows
from postlark.session import stage
from postlark.sources import keyindex, stores, versions
from postlark.sources.messages import decode_messages, decoded_posts, rejected_messages, valid_posts
from postlark.sources.sites import AGGREGATOR_SITES
from postlark.streaming.repeats import SLIM, first_arrivals_by_state

# Batch interval of the scorer and of the probe, and how long a post blocks repeats.
SCORE_INTERVAL = "1 second"
PROBE_INTERVAL = "2 seconds"
REPEAT_HORIZON = "30 days"
REPEAT_HORIZON_MS = 30 * 24 * 3600 * 1000

Model = PipelineModel | NaiveBayesTables


def _trigger(interval: str | None) -> dict:
    """Every interval, or once over what is there now."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def score(posts: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Posts in language and length with their prediction; on tables, in the batches of a stream and, with a pipeline
    model, on streams.

    Rows without keyword stay with 0.0 and are given no tokens, so the classifier's work is
    spent on keyword rows only. With ``keep``, of the posts' columns these only.
    """
    if isinstance(model, NaiveBayesTables):
        return score_by_tables(posts, model, *keep)
    long_posts = in_language_and_long(posts).withColumn("matched", has_keyword(F.col("text")))
    tokenized = with_tokens(long_posts.withColumn("_text", F.when(F.col("matched"), F.col("text"))), "_text")
    tokenized = tokenized.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    scored = model.transform(tokenized)
    return scored.withColumn("prediction", score_or_zero(F.col("prediction"), F.col("matched"))).select(
        *(keep or posts.columns), "matched", "prediction"
    )


def score_by_tables(posts: DataFrame, model: NaiveBayesTables, *keep: str) -> DataFrame:
    """``score`` with a model of tables, which the distinct terms of blocks of posts join; with ``keep``, these columns only."""
    kept = list(keep) or posts.columns
    found = in_language_and_long(posts).withColumn("matched", has_keyword(F.col("text")))
    words = with_tokens(found.withColumn("_text", F.when(F.col("matched"), F.col("text"))), "_text", "_words", stemmed=False)
    return predict_texts(words.select(*kept, "matched", "_words"), model, "_words", "matched", stemmed=False)


def message_counts() -> list[Column]:
    """What is counted of a batch's decoded messages: all, undecodable ones, and posts older than the repeat horizon."""
    oldest = F.current_timestamp() - F.expr(f"INTERVAL {REPEAT_HORIZON}")
    return [F.count(F.lit(1)).alias("messages"), F.count_if(F.col("post").isNull()).alias("rejected"),
            F.count_if(F.coalesce(F.col("post.created_at") < oldest, F.lit(False))).alias("late")]


def without_repeats(posts: DataFrame, horizon: str = REPEAT_HORIZON) -> DataFrame:
    """Streaming duplicate removal with its state in Spark, forgotten after the horizon.

    Time is that of arrival, so a post that arrives late is never dropped for its age.
    """
    return (
        with_repeat_key(posts)
        .withColumn("_arrived", F.current_timestamp())
        .withWatermark("_arrived", horizon)
        .dropDuplicatesWithinWatermark(["repeat_key"])
        .drop("_arrived")
    )


def store_batch(
    batch: DataFrame, batch_id: int, root: str, model: Model,
    sites: Sequence[str] = AGGREGATOR_SITES,
) -> None:
    """Decode, score, drop repeats of the batch and of the stored documents, store the rest and the batch's counts.

    The messages are decoded once, and counted while they are; of these, undecodable ones and posts in language and length are
    written. What the batch costs follows the batch, not the store.
    """
    seen = Observation()
    post = F.col("post")
    found = decode_messages(batch).observe(seen, *message_counts()).filter(post.isNull() | is_wanted(post["lang"], post["text"]))
    decoded = stage(found.withColumn("value", F.when(post.isNull(), F.col("value"))), "decoded")
    write_rejects(rejected_messages(decoded), root, batch_id)
    wanted = accepted(score(valid_posts(decoded), model))
    store_new(unseen_posts(with_repeat_key(wanted), root, batch_id), batch_id, root, sites)
    stores.write_counts(batch.sparkSession, root, batch_id, seen.get)


def store_new(
    fresh: DataFrame, batch_id: int, root: str, sites: Sequence[str] = AGGREGATOR_SITES
) -> None:
    """Store documents, then the graph from the stored documents."""
    stores.append_documents(to_documents(fresh, sites), root, batch_id)
    stores.append_graph(graph_rows(stores.read_batch(fresh.sparkSession, root, batch_id)), root, batch_id)


def write_rejects(rejects: DataFrame, root: str, batch_id: int) -> None:
    (
        rejects.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(f"{root}/rejects")
    )


def start_store(
    messages: DataFrame, model: Model, root: str, checkpoint: str,
    interval: str | None = SCORE_INTERVAL, sites: Sequence[str] = AGGREGATOR_SITES,
) -> StreamingQuery:
    """Run ``store_batch`` on a message stream; without interval, on what is there now."""
    spark = messages.sparkSession
    stores.create(spark, root)
    base = stores.first_batch(spark, root, checkpoint)
    return (
        messages.writeStream.foreachBatch(
            lambda batch, batch_id: store_batch(batch, base + batch_id, root, model, sites)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def accept_batch(batch: DataFrame, batch_id: int, accepted_path: str, model: Model) -> None:
    """Decode and score a batch and keep the accepted posts with the hashes of their repeat keys. A batch that is whole
    already is not written again, since a stream reads the files."""
    spark = batch.sparkSession
    folder = f"{accepted_path}/batch_id={batch_id}"
    if not stores.is_whole(spark, folder):
        keyed = with_repeat_key(accepted(score(decoded_posts(batch), model)))
        hashed = keyed.select("*", *keyindex.key_hashes(F.col("repeat_key")))
        hashed.write.mode("overwrite").option("compression", "zstd").parquet(folder)


def store_winners(winners: DataFrame, batch_id: int, root: str, sites: Sequence[str] = AGGREGATOR_SITES) -> None:
    """Store the posts of the keys that have passed the state, read from the files that hold them."""
    spark = winners.sparkSession
    chosen = stage(winners, "winners")
    files = [r.file for r in chosen.select("file").distinct().collect()]  # those of the batch
    if files:
        posts = spark.read.parquet(*files).withColumn("file", F.col("_metadata.file_path"))
        keys = ["k1", "k2", "id", "file"]
        met = posts.join(chosen.select(*keys), keys, "left_semi").drop("k1", "k2", "file")
        store_new(first_arrivals(met), batch_id, root, sites)


def start_store_by_state(
    messages: DataFrame, model: Model, root: str, checkpoint: str,
    interval: str | None = SCORE_INTERVAL, sites: Sequence[str] = AGGREGATOR_SITES, horizon_ms: int = REPEAT_HORIZON_MS,
) -> list[StreamingQuery]:
    """The store job with repeats known to Spark's state, which begins with the keys of the stored documents.

    One query keeps the accepted posts as files; another passes only their keys through the state and stores the posts whose
    keys are new. Without interval both run over what is there now, one after the other. The cost of a batch follows the
    batch alone. Undecodable messages are left to ``start_rejects``, a query of its own over the same source.
    """
    spark = messages.sparkSession
    stores.create(spark, root)
    base = stores.first_batch(spark, root, checkpoint)
    kept = f"{checkpoint}/accepted"
    accepting = (
        messages.writeStream.foreachBatch(lambda batch, batch_id: accept_batch(batch, batch_id, kept, model))
        .option("checkpointLocation", f"{checkpoint}/accepting")
        .trigger(**_trigger(interval))
        .start()
    )
    if not interval:
        accepting.awaitTermination()
    stores.make_folder(spark, kept)
    slim = (
        spark.readStream.schema(SLIM.replace(", file string", "")).option("recursiveFileLookup", "true").parquet(kept)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    known = keyindex.stored_hashes(spark, root, versions.read_version(spark, root))
    winners = first_arrivals_by_state(slim, known, horizon_ms, int(time.time() * 1000))
    storing = (
        winners.writeStream.foreachBatch(lambda batch, batch_id: store_winners(batch, base + batch_id, root, sites))
        .option("checkpointLocation", f"{checkpoint}/storing")
        .trigger(**_trigger(interval))
        .start()
    )
    return [accepting, storing]


def start_rejects(
    messages: DataFrame, root: str, checkpoint: str, interval: str | None = SCORE_INTERVAL
) -> StreamingQuery:
    """Keep undecodable messages."""
    rejects = rejected_messages(decode_messages(messages))
    return (
        rejects.writeStream.foreachBatch(lambda batch, batch_id: write_rejects(batch, root, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def print_texts(messages: DataFrame, interval: str = PROBE_INTERVAL, sink: str = "console", name: str = "texts") -> StreamingQuery:
    """Show the first texts of every batch; with the sink ``memory`` all of them are a table of that name."""
    texts = valid_posts(decode_messages(messages)).select("text")
    return texts.writeStream.format(sink).queryName(name).trigger(processingTime=interval).start()


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an appending stream over what is there now and read what it wrote."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_scores(posts: DataFrame, model: Model, path: str, checkpoint: str) -> DataFrame:
    """Score a stream of posts over what is there now, batch by batch, and read the scores; batch_id says in which."""
    return _run_batches(posts, lambda batch: score(batch, model, "id"), path, checkpoint)


def run_batch_counts(texts: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """(batch_id, word, n): the words of each batch of a stream, counted for itself and without state."""
    return _run_batches(texts, word_count, path, checkpoint)


def run_counts(texts: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """(word, n) over all batches of a stream, from the counts of each: a batch writes its own words only."""
    return run_batch_counts(texts, path, checkpoint).groupBy("word").agg(F.sum("n").alias("n"))


def _run_batches(stream: DataFrame, work, path: str, checkpoint: str) -> DataFrame:
    """Run ``work`` on each batch of what is there now, into a folder of its own that is replaced whole, and read them."""
    query = (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: work(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
