"""Helpers that several operators share: words of a text, empty-safe counts, order without one big sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]+"
MAX_SLICES = 4096
ROWS_PER_SLICE = 2000


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; none for null or empty text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def sheltered(columns: Sequence[str]) -> dict[str, str]:
    """For each input column the name that it has inside an operator, whose own columns all begin with an underscore."""
    names, used = {}, {c.lower() for c in columns}
    for c in columns:
        inner = c
        while inner.startswith("_") or (inner != c and inner.lower() in used):
            inner = f"given{inner}" if inner.startswith("_") else f"given_{inner}"
        used.add(inner.lower())
        names[c] = inner
    return names


def tie_breaker(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    """63 hashed bits of the row; rows that agree in all the columns may change places unseen."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), 1)


def slices_for(rows: int) -> int:
    """Slices of an order: some thousand rows each, and never so many that their table is not small."""
    return max(1, min(MAX_SLICES, -(-rows // ROWS_PER_SLICE)))


def slice_of(key: Column, slices: int) -> Column:
    """The slice of a 63-bit key; slices hold ranges of the key in its order."""
    return F.least(F.floor(key.cast("double") / F.lit(float(2**63)) * slices), F.lit(slices - 1)).cast("int")


def null_safe(group: Sequence[str]) -> list[Column]:
    """Key columns that tell null from every value and can be joined with plain equality."""
    return [x.alias(f"_g{i}{kind}") for i, c in enumerate(group)
            for kind, x in (("n", F.col(c).isNull()), ("v", F.coalesce(F.col(c).cast("string"), F.lit(""))))]


def group_names(group: Sequence[str]) -> list[str]:
    return [f"_g{i}{kind}" for i in range(len(group)) for kind in "nv"]


def running(df: DataFrame, group: Sequence[str], key: str, value: str, slices: int) -> DataFrame:
    """Adds, within each group in the order of the 63-bit column ``key``: ``_rank`` (from 1), ``_before`` (sum of
    ``value`` in the rows ahead), ``_rows`` and ``_total`` of the group.

    A group is cut into ranges of the key, which are numbered apart and moved on by what lies ahead of them, so a group
    with a third of all rows is as many tasks as any other third.
    """
    names = group_names(group)
    cut = df.select("*", *null_safe(group), slice_of(F.col(key), slices).alias("_slice"))
    own = W.partitionBy(*names).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*names)
    ahead = cut.groupBy(*names, "_slice").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s")).select(
        *names, "_slice",
        F.coalesce(F.sum("_n").over(own), F.lit(0)).alias("_rows_ahead"),
        F.coalesce(F.sum("_s").over(own), F.lit(0)).alias("_sum_ahead"),
        F.sum("_n").over(whole).alias("_rows"),
        F.sum("_s").over(whole).alias("_total"),
    )
    here = W.partitionBy(*names, "_slice").orderBy(key)
    numbered = cut.select(
        "*",
        F.row_number().over(here).alias("_at"),
        (F.sum(value).over(here.rowsBetween(W.unboundedPreceding, 0)) - F.col(value)).alias("_sum_here"),
    )
    joined = numbered.join(ahead, [*names, "_slice"])
    return joined.select(
        *[F.col(c) for c in df.columns],
        (F.col("_at") + F.col("_rows_ahead")).alias("_rank"),
        (F.col("_sum_here") + F.col("_sum_ahead")).alias("_before"),
        "_rows",
        "_total",
    )
