"""The programs a user runs: collect, train, predict, check for bots, retain."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.operators.cadence import cadence, newest, score_people, unscored_batch
from postlark.operators.classify import accuracy, fit_pipeline, in_training
from postlark.operators.documents import retain, retention_cutoff, write_back_scores
from postlark.operators.features import with_tokens
from postlark.operators.graph import score_persons
from postlark.session import stage
from postlark.sources import stores
from postlark.sources.corpus import append_corpus, read_corpus
from postlark.sources.search import found_posts, read_responses


def collect(spark: SparkSession, responses: str, target: str, corpus: str, label: Column | None = None) -> None:
    """Append the found posts of saved search responses to the corpus."""
    append_corpus(found_posts(read_responses(spark, responses), target), corpus, label)


def train(spark: SparkSession, corpus: str, model: str) -> DataFrame:
    """Fit on the training side, save the model, return the accuracy on the other side.

    Tokens are written once to the shared folder: fitting passes over them three times.
    """
    docs = stage(with_tokens(read_corpus(spark, corpus)).select("id", "label", "tokens"), "tokens")
    side = in_training(F.col("id"))
    fitted = fit_pipeline(docs, training=side)
    fitted.write().overwrite().save(model)
    return accuracy(fitted.transform(docs.filter(~side)))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def check_bots(
    people: DataFrame, scored: DataFrame, history: DataFrame, batch: int | None = None
) -> DataFrame:
    """Scores of the next people not scored yet; of all of them without a batch size.

    A batch is a short list, so the history is filtered by it before anything is shuffled. For all
    people the history is cut to the newest posts first, so no user brings more than those along.
    """
    if batch:
        todo = unscored_batch(people, scored, batch)
        looked_at = history
    else:
        todo = people.join(scored.select("user_id"), "user_id", "left_anti")
        looked_at = newest(history)
    return score_people(todo, cadence(looked_at.join(todo, "user_id", "left_semi")))


def check_store(spark: SparkSession, root: str, history: DataFrame, run: int, batch: int | None = None) -> DataFrame:
    """Score the store's people that no other run has scored, store the scores and return them. The same run again
    replaces its scores; the next one takes other people."""
    people = stores.read_vertices(spark, root, "persons").select(F.col("id").cast("bigint").alias("user_id")).dropna().distinct()
    scored = stores.other_batches(stores.read(spark, root, "scores"), run)
    found = stage(check_bots(people, scored.select("user_id").distinct(), history, batch), "scores")
    stores.append_scores(found, root, run)
    return found


def write_back(documents: DataFrame, persons: DataFrame, scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents and persons with the scores put in."""
    return write_back_scores(documents, scores), score_persons(persons, scores)


def retire(documents: DataFrame, now: Column, days: int = 30) -> DataFrame:
    return retain(documents, retention_cutoff(now, days))
