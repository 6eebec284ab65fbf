"""Links, hashtags and the key under which a post counts as a repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a link and as a hashtag.
LINK_PATTERN = r"""\b((?:[a-z][\w-]+:(?:\/{1,3}|[a-z0-9%])|www\d{0,3}[.]|[a-z0-9.\-]+[.][a-z]{2,4}\/)(?:[^\s()<>]+|\(([^\s()<>]+|(\([^\s()<>]+\)))*\))+(?:\(([^\s()<>]+|(\([^\s()<>]+\)))*\)|[^\s`!()\[\]{};:'".,<>?«»“”‘’]))"""
HASHTAG_PATTERN = r"(#\w+)"

# LINK_PATTERN nests a repeat inside a repeat, so a long run of dots or an unclosed bracket costs
# exponential time. The body of a link is a row of units, each one character or one bracketed
# part, with at least two units and the last one a bracketed part or no trailing mark. Every unit
# is told by its first character, so the same language reads without backtracking: one unit, then
# blocks of marks closed by plain characters or a bracketed part. Possessive repeats also keep the
# matcher's stack flat on long texts, and the look ahead for the slash spares words that have none.
_HEAD = r"(?:[a-z][\w-]++:(?:\/{1,3}|[a-z0-9%])|www\d{0,3}[.]|(?=[a-z0-9.\-]++\/)[a-z0-9.\-]+[.][a-z]{2,4}\/)"
_BRACKETED = r"\((?:[^\s()<>]++|\([^\s()<>]++\))*+\)"
_MARK = r"""[`!\[\]{};:'".,?«»“”‘’]"""
_PLAIN = r"""[^\s`!()\[\]{};:'".,<>?«»“”‘’]"""
LINEAR_LINK_PATTERN = (
    rf"\b{_HEAD}(?:[^\s()<>]|{_BRACKETED})(?:{_MARK}*+(?:{_PLAIN}++|{_BRACKETED}))++"
)


# A run of letters, digits, dots and hyphens has a start for every part of it, and each start reads
# to the run's end. Long texts with a very long run are read with an alternative that skips a run
# from which no link can start: none of its parts is "www" and no colon or slash follows.
LONG_TEXT = 10_000
LONG_RUN = r"[\w.\-]{1000}"
SKIPPING_LINK_PATTERN = (
    rf"({LINEAR_LINK_PATTERN})|(?![\w.\-]*?www)[\w.\-]++(?!:[\/a-z0-9%]|\/)"
)


def _may_hold_link(text: Column) -> Column:
    """Every link has a colon, a slash or ``www``; most texts without one need no pattern."""
    return F.contains(text, F.lit(":")) | F.contains(text, F.lit("/")) | F.contains(text, F.lit("www"))


def _has_long_run(text: Column) -> Column:
    return (F.length(text) > LONG_TEXT) & text.rlike(LONG_RUN)


def _past_long_runs(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(SKIPPING_LINK_PATTERN), F.lit(1))
    return F.filter(found, lambda link: link != "")


def links(text: Column) -> Column:
    """Every link of the text in order, as whole matches."""
    return (
        F.when(~_may_hold_link(text), F.array().cast("array<string>"))
        .when(_has_long_run(text), _past_long_runs(text))
        .otherwise(F.regexp_extract_all(text, F.lit(LINEAR_LINK_PATTERN), F.lit(0)))
    )


def first_link(text: Column) -> Column:
    """The first link, null when there is none; the search stops at it except past long runs."""
    return (
        F.when(~_may_hold_link(text), F.lit(None).cast("string"))
        .when(_has_long_run(text), F.get(_past_long_runs(text), F.lit(0)))
        .otherwise(_null_if_empty(F.regexp_extract(text, LINEAR_LINK_PATTERN, 0)))
    )


def _null_if_empty(found: Column) -> Column:
    """Evaluates ``found`` once, which ``nullif`` does not."""
    return F.get(F.filter(F.array(found), lambda link: link != ""), F.lit(0))


def hashtags(text: Column) -> Column:
    """Lower-case tags without the mark, in order, repeats kept."""
    found = F.regexp_extract_all(text, F.lit(HASHTAG_PATTERN), F.lit(1))
    return F.transform(found, lambda tag: F.lower(F.replace(tag, F.lit("#"), F.lit(""))))


def repeat_key(text: Column, link: Column | None = None) -> Column:
    """Posts are repeats of each other when this key is equal.

    A post repeats an earlier one when the first link is the same or the whole text is. Equal
    texts have equal first links, so the two tests fold into one key: the first link where there
    is one, the text hash otherwise.
    """
    link = first_link(text) if link is None else link
    return F.coalesce(F.concat(F.lit("L:"), link), F.concat(F.lit("H:"), F.md5(text)))
