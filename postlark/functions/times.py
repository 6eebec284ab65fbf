"""Clock arithmetic and 32-bit wrapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the corpus writes "Tue Jul 07 16:16:57 +0000 2015"; the weekday is skipped.
CORPUS_TIME_FORMAT = "MMM dd HH:mm:ss Z yyyy"


def parse_corpus_time(text: Column) -> Column:
    """Timestamp of the corpus date text, null when it does not parse."""
    return F.try_to_timestamp(F.substring(text, 5, 64), F.lit(CORPUS_TIME_FORMAT))


def format_corpus_time(ts: Column) -> Column:
    weekday = F.element_at(
        F.array(*[F.lit(d) for d in ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")]),
        F.dayofweek(ts),
    )
    return F.concat_ws(" ", weekday, F.date_format(ts, "MMM dd HH:mm:ss Z yyyy"))


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def int_div(dividend: Column, divisor: Column) -> Column:
    """Integer division truncating toward zero."""
    return F.call_function("div", dividend, divisor)


def wrap_int32(value: Column) -> Column:
    """The value a 32-bit signed integer would hold after overflow."""
    low = F.lit(1 << 31)
    return F.pmod(value + low, F.lit(1 << 32)) - low
