"""Tokens, term frequencies and inverse document frequencies as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.functions.stemming import stem_all
from postlark.functions.text import clean, term_counts, tokens, words
from postlark.operators.joins import lookup


def with_tokens(df: DataFrame, text: str = "text", out: str = "tokens", stemmed: bool = True) -> DataFrame:
    """Clean, tokenize and stem. The cleaned text is a column of its own so it is computed once."""
    split = df.withColumn("_cleaned", clean(F.col(text))).withColumn(out, tokens(F.col("_cleaned")))
    return (split.withColumn(out, stem_all(out)) if stemmed else split).drop("_cleaned")


def term_freq(docs: DataFrame, *keys: str, column: str = "tokens") -> DataFrame:
    """(keys, term, tf), counted inside each row: no shuffle."""
    return docs.select(*keys, F.inline(term_counts(F.col(column))))


def doc_freq(terms: DataFrame) -> DataFrame:
    """(term, df) from term_freq rows, of which a document has one per term."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf_value(df: Column, n_docs: Column) -> Column:
    return F.log((n_docs + 1) / (df + 1))


def idf(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df, idf) with idf = ln((m + 1) / (df + 1))."""
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    return doc_freq(terms).withColumn("idf", idf_value(F.col("df"), n_docs))


def tfidf(terms: DataFrame, weights: DataFrame, *keys: str) -> DataFrame:
    """(keys, term, tf, tfidf). The document frequency is also the number of rows per term."""
    counts = weights.select("term", "df")
    return lookup(
        terms, weights.select("term", "idf"), ["term"], keys, counts, rows="df", how="inner"
    ).select(*keys, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences of each space-separated word; the same plan on tables and streams."""
    return (
        df.select(F.explode(words(F.col(text))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
