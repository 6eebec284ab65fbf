"""Phone numbers and e-mail addresses of a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlark.functions.text import strip_punctuation

# What a whole token must look like.
PHONE_PATTERN = r"^(?:(?:\+?1\s*(?:[.-]\s*)?)?(?:\(\s*([2-9]1[02-9]|[2-9][02-8]1|[2-9][02-8][02-9])\s*\)|([2-9]1[02-9]|[2-9][02-8]1|[2-9][02-8][02-9]))\s*(?:[.-]\s*)?)?([2-9]1[02-9]|[2-9][02-9]1|[2-9][02-9]{2})\s*(?:[.-]\s*)?([0-9]{4})(?:\s*(?:#|x\.?|ext\.?|extension)\s*(\d+))?$"
EMAIL_PATTERN = r"[a-zA-Z0-9_.]+@[a-z0-9\-]+\.[a-z]+(\.[a-z]+)?"


def _whole(pattern: str) -> str:
    return rf"\A(?:{pattern})\z"


def _matching_tokens(text: Column, pattern: str) -> Column:
    return F.array_distinct(
        F.filter(F.split(text, r"\s+", -1), lambda token: token.rlike(_whole(pattern)))
    )


def phones(page: Column) -> Column:
    """Distinct tokens that are a phone number once all punctuation is gone."""
    return _matching_tokens(strip_punctuation(page, keep=""), PHONE_PATTERN)


def emails(page: Column) -> Column:
    """Distinct tokens that are an e-mail address; a page without ``@`` is not split."""
    return F.when(
        F.contains(page, F.lit("@")), _matching_tokens(page, EMAIL_PATTERN)
    ).when(page.isNotNull(), F.array().cast("array<string>"))
