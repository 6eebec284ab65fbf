"""Multinomial Naive Bayes over TF-IDF: as inspectable tables and as a pyspark.ml pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.operators.blocks import class_counts
from postlark.operators.features import idf_value, term_freq
from postlark.operators.joins import lookup

# Smoothing, share of the training side, and the vector size of the hashed form.
SMOOTHING = 0.0001
TRAIN_SHARE = 0.7
HASHED_TERMS = 1 << 20


def in_training(key: Column, share: float = TRAIN_SHARE) -> Column:
    """Random split by the key's hash, so a re-run task puts every row on the same side."""
    draw = F.conv(F.left(F.md5(key.cast("string")), F.lit(8)), 16, 10).cast("bigint")
    return F.pmod(draw, F.lit(1000)) < F.lit(int(round(share * 1000)))


@dataclass(frozen=True)
class NaiveBayesTables:
    """A trained model as three tables.

    ``priors``: label, n_docs, log_prior. ``totals``: one row with the number of documents, the
    vector size and, per class, the weight sum. ``terms``: term, df, idf, and per class the
    weight sum ``w_i``.
    """

    classes: tuple[float, ...]
    smoothing: float
    priors: DataFrame
    totals: DataFrame
    terms: DataFrame

    def _log_likelihood(self, i: int, weight: Column, totals: Column) -> Column:
        floor = F.lit(self.smoothing)
        return F.log(weight + floor) - F.log(totals[f"w_{i}"] + floor * totals["dimension"])

    def _totals(self) -> Column:
        return self.totals.select(F.struct(*self.totals.columns)).scalar()

    def weighted_terms(self) -> DataFrame:
        """(term, df, idf, ll_0, ll_1, ...): one row per term with its class log-likelihoods."""
        with_totals = self.terms.withColumn("_t", self._totals())
        return with_totals.select(
            "term", "df", "idf",
            *[
                self._log_likelihood(i, F.col(f"w_{i}"), F.col("_t")).alias(f"ll_{i}")
                for i in range(len(self.classes))
            ],
        )

    def likelihoods(self) -> DataFrame:
        """(label, term, log_likelihood)."""
        entries = F.array(
            *[
                F.struct(F.lit(c).alias("label"), F.col(f"ll_{i}").alias("log_likelihood"))
                for i, c in enumerate(self.classes)
            ]
        )
        return self.weighted_terms().select("term", F.inline(entries)).select(
            "label", "term", "log_likelihood"
        )

    def predict(self, terms: DataFrame, docs: DataFrame, key: str) -> DataFrame:
        """``docs`` with ``prediction``; ``terms`` are the term_freq rows of the same documents.

        One join on the term and one aggregation on the document. A term unknown to the model
        weighs what a term with no occurrence weighs. On a tie the lower label wins. Terms
        frequent in training are taken to be the frequent ones here; being wrong costs balance,
        not rows.
        """
        n = range(len(self.classes))
        counts = self.terms.select("term", "df")
        scored = (
            lookup(terms, self.weighted_terms().drop("df"), ["term"], [key], counts, rows="df")
            .withColumn("_t", self._totals())
            .withColumn("_known", F.col("idf").isNotNull())
            .select(
                key,
                (
                    F.col("tf")
                    * F.when(F.col("_known"), F.col("idf")).otherwise(
                        idf_value(F.lit(0), F.col("_t")["n_docs"])
                    )
                ).alias("weight"),
                *[
                    F.when(F.col("_known"), F.col(f"ll_{i}"))
                    .otherwise(self._log_likelihood(i, F.lit(0.0), F.col("_t")))
                    .alias(f"ll_{i}")
                    for i in n
                ],
            )
            .groupBy(key)
            .agg(*[F.sum(F.col("weight") * F.col(f"ll_{i}")).alias(f"s_{i}") for i in n])
        )
        priors = self.priors.select(
            F.map_from_entries(F.collect_list(F.struct("label", "log_prior")))
        ).scalar()
        scores = [F.coalesce(F.col(f"s_{i}"), F.lit(0.0)) + F.col("_p")[F.lit(c)]
                  for i, c in enumerate(self.classes)]
        best_score, best = scores[0], F.lit(self.classes[0])
        for score, label in zip(scores[1:], self.classes[1:]):
            best = F.when(score > best_score, F.lit(label)).otherwise(best)
            best_score = F.greatest(best_score, score)
        return (
            docs.join(scored, key, "left")
            .withColumn("_p", priors)
            .select(*docs.columns, best.alias("prediction"))
        )

    def products(self) -> DataFrame:
        """(term, c_0, c_1, ...): what an occurrence of the term adds to each class's score."""
        n = range(len(self.classes))
        return self.weighted_terms().select("term", *[(F.col("idf") * F.col(f"ll_{i}")).alias(f"c_{i}") for i in n])

    def product_of_unknown(self, i: int) -> Column:
        """What a term that the model does not know adds to the score of a class."""
        totals = self._totals()
        return idf_value(F.lit(0), totals["n_docs"]) * self._log_likelihood(i, F.lit(0.0), totals)

    @classmethod
    def load(
        cls, spark: SparkSession, path: str, smoothing: float = SMOOTHING,
    ) -> NaiveBayesTables:
        """The classes are those of ``priors``, in the order of the weight sums."""
        priors, totals, terms = (spark.read.parquet(f"{path}/{t}") for t in ("priors", "totals", "terms"))
        classes = tuple(row.label for row in priors.select("label").orderBy("label").collect())
        return cls(classes, smoothing, priors, totals, terms)


def train_tables(
    docs: DataFrame,
    path: str,
    label: str = "label",
    training: Column | None = None,
    classes: Sequence[float] | None = None,
    smoothing: float = SMOOTHING,
    dimension: int | None = None,
    stemmed: bool = True,
) -> NaiveBayesTables:
    """Train on ``docs`` (label, tokens) into a folder. Unless ``stemmed`` the tokens are words, and blocks of documents stem
    their distinct ones.

    IDF sees all rows, the classifier the training side. The weight sum of a term in a class is idf(term) times its summed tf, so idf, document
    frequency and class sums come from one aggregation by term: no TF-IDF table is built and
    nothing is joined. The documents are read once for it. ``dimension`` is the vector size, by default the number of terms.
    The classes are the labels that training rows have; with ``classes``, those of them that do.
    """
    training = F.lit(True) if training is None else training
    marked = docs.withColumn("_class", F.when(training, F.col(label).cast("double")))
    present = [row._class for row in marked.select("_class").dropna().distinct().orderBy("_class").collect()]
    classes = tuple(c for c in present if classes is None or c in classes)
    if not classes:
        raise ValueError("no training row has a label")
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    if stemmed:
        counts = term_freq(marked, "_class").select(
            "term", F.lit(1).cast("bigint").alias("df"),
            *[F.when(F.col("_class") == c, F.col("tf")).alias(f"tf_{i}") for i, c in enumerate(classes)])
    else:
        counts = class_counts(marked, "_class", classes, "tokens")
    terms = (
        counts.groupBy("term")
        .agg(F.sum("df").alias("df"), *[F.coalesce(F.sum(f"tf_{i}"), F.lit(0)).alias(f"tf_{i}") for i in range(len(classes))])
        .withColumn("idf", idf_value(F.col("df"), n_docs))
        .select(
            "term", "df", "idf",
            *[(F.col(f"tf_{i}") * F.col("idf")).alias(f"w_{i}") for i in range(len(classes))],
        )
    )
    spark = docs.sparkSession
    terms.write.mode("overwrite").parquet(f"{path}/terms")
    per_class = (
        marked.filter(F.col("_class").isin(*classes))
        .groupBy(F.col("_class").alias("label"))
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )
    n_training = per_class.select(F.sum("n_docs")).scalar()
    per_class.withColumn(
        "log_prior",
        F.log(F.col("n_docs") + smoothing) - F.log(n_training + smoothing * len(classes)),
    ).write.mode("overwrite").parquet(f"{path}/priors")
    spark.read.parquet(f"{path}/terms").agg(
        (F.count(F.lit(1)) if dimension is None else F.lit(dimension)).cast("bigint").alias("dimension"),
        *[F.coalesce(F.sum(f"w_{i}"), F.lit(0.0)).alias(f"w_{i}") for i in range(len(classes))],
    ).withColumn("n_docs", n_docs).write.mode("overwrite").parquet(f"{path}/totals")
    return NaiveBayesTables.load(spark, path, smoothing)


def accuracy(predicted: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: the share of rows whose prediction equals the label."""
    return predicted.agg(
        F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def feature_stages(num_features: int = HASHED_TERMS) -> list:
    return [
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features),
        IDF(inputCol="tf", outputCol="features"),
    ]


def fit_pipeline(
    docs: DataFrame,
    label: str = "label",
    training: Column | None = None,
    smoothing: float = SMOOTHING,
    num_features: int = HASHED_TERMS,
) -> PipelineModel:
    """Fit hashing, IDF (all rows) and Naive Bayes (training rows) into one savable model.

    The classifier's fit holds a dense vector per task and class, so its tasks number the cores,
    not the files. Corpora beyond a labelled set are for ``train_tables``, which aggregates by
    term.
    """
    features = Pipeline(stages=feature_stages(num_features)).fit(docs)
    classifier = NaiveBayes(
        labelCol=label, featuresCol="features", predictionCol="prediction",
        smoothing=smoothing, modelType="multinomial",
    )
    train = docs if training is None else docs.filter(training)
    cores = docs.sparkSession.sparkContext.defaultParallelism
    model = classifier.fit(
        features.transform(
            train.select("tokens", F.col(label).cast("double").alias(label)).coalesce(cores)
        )
    )
    return PipelineModel(stages=[*features.stages, model])
