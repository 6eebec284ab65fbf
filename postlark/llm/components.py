"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.session import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v) turned towards the smallest neighbour. In a large star each node gives its smallest neighbour (or
    itself) to its larger ones, in a small star to its smaller ones and to itself."""
    if large:
        sided = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sided = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sided.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = sided.join(least, "u")
    if large:
        turned = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        turned = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return turned.filter("u <> v").distinct()


def _is_stars(links: DataFrame) -> bool:
    """Whether every node that is not the smallest of its component hangs on that one alone: then both stars leave all
    as it is."""
    ends = links.select(F.greatest("u", "v").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        links.select(F.least("u", "v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    odd = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter("below > 1 or below + above > 1")
    return odd.agg(F.count(F.lit(1)).alias("n")).first()["n"] == 0


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the links (``u``, ``v``, longs) but those whose
    component they name themselves.

    The two stars alternate until each node points at the smallest one it can reach. Every round is written to the
    shared folder, so no lineage builds up, and nothing but a number comes to the driver.
    """
    now = stage(links.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
                .filter("u <> v").distinct(), "links")
    while not _is_stars(now):
        now = stage(_star(_star(now, large=True), large=False), "links")
    return now.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("component"))
