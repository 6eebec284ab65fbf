"""Joining large fact tables to compact lookup tables when one key may hold much of the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1 / 1000


def hot_keys(counts: DataFrame, on: Sequence[str], rows: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of all rows, with ``_salts``: the parts of at most that share
    they are cut into. There are fewer than ``1 / share`` keys, and fewer than ``2 / share`` parts."""
    limit = counts.select(F.sum(rows)).scalar() * share
    hot = counts.filter(F.col(rows) > limit)
    return hot.select(*on, F.ceil(F.col(rows) / limit).cast("int").alias("_salts"))


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    counts: DataFrame,
    rows: str = "n_rows",
    how: str = "left",
    share: float = HOT_SHARE,
) -> DataFrame:
    """Join ``facts`` to ``table`` (unique on ``on``) with the hot keys spread over as many tasks as
    their rows ask for, so that no part holds more than ``share`` of the facts.

    ``counts`` says how many fact rows each key has. The hot keys number fewer than ``1 / share``
    whatever the data, so that list is broadcast; only their few table rows are repeated per salt.
    Cold keys join on the key alone. Null keys keep their row in a left join.
    """
    on = list(on)
    hot = F.broadcast(hot_keys(counts, on, rows, share))
    none = F.lit(0)

    def salted(salt: Column) -> Column:
        return F.when(F.col("_salts").isNotNull(), salt).otherwise(none)

    left = (
        facts.join(hot, on, "left")
        .withColumn("_salt", salted(F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int")))
        .drop("_salts")
    )
    right = (
        table.join(hot, on, "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_salts").isNotNull(), F.sequence(none, F.col("_salts") - 1)).otherwise(F.array(none))
            ),
        )
        .drop("_salts")
    )
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def count_rows(facts: DataFrame, on: Sequence[str], rows: str = "n_rows") -> DataFrame:
    """Fact rows per key, combined before the shuffle; rows without a key are left out."""
    present = facts.dropna(subset=list(on)) if len(on) > 1 else facts.filter(F.col(on[0]).isNotNull())
    return present.groupBy(*on).agg(F.count(F.lit(1)).alias(rows))
