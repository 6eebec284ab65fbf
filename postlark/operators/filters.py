"""Which posts go on to the classifier, and what happens to the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.functions.text import KEYWORDS, contains_any, longer_than

# The language and length a post needs.
LANGUAGE = "en"
LENGTH_OVER = 80


def in_language_and_long(
    posts: DataFrame, language: str = LANGUAGE, length_over: int = LENGTH_OVER
) -> DataFrame:
    return posts.filter(is_wanted(F.col("lang"), F.col("text"), language, length_over))


def is_wanted(lang: Column, text: Column, language: str = LANGUAGE, length_over: int = LENGTH_OVER) -> Column:
    return (lang == language) & longer_than(text, length_over)


def has_keyword(text: Column, keywords: Sequence[str] = KEYWORDS) -> Column:
    return contains_any(text, tuple(keywords))


def score_or_zero(prediction: Column, matched: Column) -> Column:
    """The prediction of a keyword post; 0.0 for the others, which stay as rows."""
    return F.when(matched, prediction).otherwise(F.lit(0.0))


def post_or_null(posts: DataFrame, matched: Column, columns: Sequence[str]) -> Column:
    """The post as a struct; null for a post without keyword."""
    return F.when(matched, F.struct(*columns))


def accepted(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    return scored.filter(F.col(prediction) == 1.0)


def texts(posts: DataFrame) -> DataFrame:
    return posts.select("text")
