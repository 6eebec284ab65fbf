"""Is a post's source one of the known aggregator sites?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.functions.text import contains_any
from postlark.operators.joins import count_rows, lookup
from postlark.session import stage
from postlark.sources.sites import AGGREGATOR_SITES

GRAM = 3


def from_aggregator(source: Column, sites: Sequence[str] = AGGREGATOR_SITES) -> Column:
    """True when the lower-cased source holds a site's name literally; stops at the first hit."""
    return F.coalesce(contains_any(source, tuple(sites)), F.lit(False))


def flag_aggregators(posts: DataFrame, sites: Sequence[str] | DataFrame = AGGREGATOR_SITES) -> DataFrame:
    """``sites`` are names, or a table of them (``site``) of any size."""
    if isinstance(sites, DataFrame):
        return flag_by_table(posts, sites)
    return posts.withColumn("third_party", from_aggregator(F.col("source"), sites))


def _grams(text: Column, size: Column | int) -> Column:
    """The distinct parts of a text of so many characters, none where it is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: text.substr(i, size)))


def flag_by_table(posts: DataFrame, sites: DataFrame, row: str = "id") -> DataFrame:
    """``flag_aggregators`` with a table of names: distinct sources and names meet by a part of three characters.

    A source that holds a name holds all its parts, so a name is looked for by the one that the fewest sources have, and not
    at all if no source has one of them. What meets is confirmed literally. Shorter names are their own part. Null and empty
    names match nothing, a null source is no site. ``row`` tells the posts of a frequent source apart.
    """
    keyed = posts.withColumn("_source", F.lower("source"))
    sources = stage(keyed.select("_source").dropna().distinct(), "sources")
    names = sites.select("site").filter(F.length("site") > 0).distinct()
    own = names.withColumn("parts", _grams(F.col("site"), F.least(F.length("site"), F.lit(GRAM))))
    wanted = stage(own.select("site", F.size("parts").alias("n"), F.explode("parts").alias("part")), "site_parts")
    parts = F.flatten(F.array(*[_grams(F.col("_source"), size) for size in range(1, GRAM + 1)]))
    held = stage(
        sources.select("_source", F.explode(parts).alias("part")).join(wanted.select("part").distinct(), "part", "left_semi"), "source_parts")
    rarest = (
        wanted.join(held.groupBy("part").agg(F.count(F.lit(1)).alias("n_sources")), "part")
        .groupBy("site", "n").agg(F.min(F.struct("n_sources", "part"))["part"].alias("part"), F.count(F.lit(1)).alias("found"))
        .filter("found = n").select("site", "part")
    )
    hit = held.join(rarest, "part").filter(F.contains("_source", "site")).select("_source").distinct().withColumn("_hit", F.lit(True))
    flagged = lookup(keyed, stage(hit, "site_hits"), ["_source"], [row], count_rows(keyed, ["_source"]))
    return flagged.withColumn("third_party", F.coalesce("_hit", F.lit(False))).select(*posts.columns, "third_party")
