"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlark.llm.common import group_names, null_safe, running, sheltered, slices_for, tie_breaker
from postlark.session import stage


def interleave(rows: DataFrame, shards: int, source: str = "source", seed: int = 11) -> DataFrame:
    """Adds ``shard`` (from 0) and ``slot`` (from 0 without gaps within the shard) to every row.

    Rows are put in a seeded order within their source; a row's fractional rank is its place there over the source's
    rows, moved by a seeded offset of the source, lest all sources of one row share a place. Sorted by it, any run
    of rows holds the sources in the proportions of the whole, so equal cuts give shards that match the mixture. Their
    row counts differ by one at most.

    A null source is a source of its own. Rows that are equal in every column are interchangeable, each with a slot of
    its own. No rows give no rows; fewer rows than shards leave some shards empty. Columns that are called ``shard``
    or ``slot`` are replaced, any other names may be used. The columns must be of types that hash (no maps); give texts by their digests, since all
    columns travel.
    """
    keep = [c for c in rows.columns if c.lower() not in {"shard", "slot"}]
    names_in = sheltered(keep)
    inner, source = list(names_in.values()), names_in.get(source, source)
    given_back = [F.col(names_in[c]).alias(c) for c in keep]
    staged = stage(rows.select(*[F.col(c).alias(names_in[c]) for c in keep], tie_breaker(rows, keep, seed).alias("_key"), F.lit(1).alias("_one")), "interleave")
    total = staged.count()
    if not total:
        return staged.select(*given_back, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)
    slices = slices_for(total)
    start = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), F.col(source)), 11) / F.lit(float(2**53))
    ranked = stage(
        running(staged, [source], "_key", "_one", slices)
        .withColumn("_share", (F.col("_rank") - 1 + start) / F.col("_rows"))
        .select(*inner, "_key", "_share", F.least(F.floor(F.col("_share") * slices), F.lit(slices - 1)).alias("_slice")),
        "shares",
    )
    ahead = ranked.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        "_slice",
        F.coalesce(F.sum("_n").over(W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"),
    )
    names = group_names([source])
    order = W.partitionBy("_slice").orderBy("_share", *names, "_key")
    place = F.col("_at") + F.col("_ahead") - 1
    cut = (
        ranked.select("*", *null_safe([source]))
        .withColumn("_at", F.row_number().over(order))
        .join(F.broadcast(ahead), "_slice")  # a row for each slice, of which there are 4,096 at most
        .withColumn("_place", place)
        .withColumn("_shard", F.expr(f"(_place * {shards}) div {total}"))
    )
    return cut.select(
        *given_back,
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_place") - F.expr(f"(_shard * {total} + {shards - 1}) div {shards}")).cast("long").alias("slot"),
    )
