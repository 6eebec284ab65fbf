"""Mixing sources to target weights along a curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlark.llm.common import group_names, null_safe, running, sheltered, slices_for, tie_breaker
from postlark.session import stage

MOST_REPEATS = 3


def source_sizes(rows: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """One row for each source: its documents' number and summed size."""
    return rows.groupBy(source).agg(F.sum(size).cast("long").alias("source_size"))


def cyclic_weights(sources: DataFrame, source: str = "source", weights: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Sources by code point, null last, take the weights in turn."""
    at = F.row_number().over(W.orderBy(F.col(source).asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (at % len(weights) + 1).cast("int")))


def capped_targets(sources: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``target``: all sizes shared out by weight, where no target passes ``most`` times the source's size and the
    excess is shared out again by weight.

    With the sources in the order of cap over weight those that meet their cap come first. The level that the others
    reach per weight is what the capped ones leave, over the weights that remain; the first source whose cap lies above
    its level ends the capped ones (from there on the levels fall, so it has the largest). One row per source goes
    through this, no documents.
    """
    cap = F.lit(most) * F.col("source_size")
    ratio = cap / F.col("weight")
    order = W.orderBy("_ratio", "_cap", "weight")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    level = (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (
        F.col("_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return (
        sources.withColumns({"_cap": cap, "_ratio": ratio})
        .withColumns({"_all": F.sum("source_size").over(whole), "_weights": F.sum("weight").over(whole)})
        .withColumn("_level", level)
        .withColumn("_free", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(whole))
        .withColumn("target", F.when(F.col("_ratio") < F.col("_free"), F.col("_cap").cast("double"))
                    .otherwise(F.coalesce(F.col("weight") * F.col("_free"), F.col("_cap").cast("double"))))
        .drop("_cap", "_ratio", "_all", "_weights", "_level", "_free")
    )


def ramp_schedule(sources: DataFrame, steps: int = 4) -> DataFrame:
    """Adds ``schedule``: each source's share of the stream in ``steps`` spans of training time (0 to 1), as an array of
    structs (t0, t1, w0, w1) whose weight runs straight from w0 to w1.

    The stream begins near the natural mixture and ends as far on the other side of the targets, and so meets them over
    the whole. At any time the weights of all sources sum to 1.
    """
    whole = W.partitionBy()
    share = F.try_divide("target", F.sum("target").over(whole))
    natural = F.try_divide("source_size", F.sum("source_size").over(whole))
    tilt = F.when(F.col("_share") > 0, (F.col("_share") - F.col("_natural")) / F.col("_share")).otherwise(0.0)
    damp = F.greatest(F.lit(1.0), F.max(F.abs(F.col("_tilt"))).over(whole))
    weight = lambda t: F.col("_share") * (1 + F.col("_tilt") / F.col("_damp") * (2 * t - 1))
    spans = [F.struct(F.lit(i / steps).alias("t0"), F.lit((i + 1) / steps).alias("t1"),
                      weight(i / steps).alias("w0"), weight((i + 1) / steps).alias("w1")) for i in range(steps)]
    return (
        sources.withColumns({"_share": F.coalesce(share, F.lit(0.0)), "_natural": F.coalesce(natural, F.lit(0.0))})
        .withColumn("_tilt", tilt)
        .withColumn("_damp", damp)
        .withColumn("schedule", F.array(*spans))
        .drop("_share", "_natural", "_tilt", "_damp")
    )


def _integrated(schedule: Column) -> Column:
    """The spans with ``d0``, the demand before them, and ``d``, the demand within, both as parts of the source's whole."""
    area = lambda s: (s["w0"] + s["w1"]) / 2 * (s["t1"] - s["t0"])
    total = F.aggregate(schedule, F.lit(0.0), lambda a, s: a + area(s))
    return F.transform(schedule, lambda s, i: F.struct(
        s["t0"].alias("t0"), s["t1"].alias("t1"), s["w0"].alias("w0"), s["w1"].alias("w1"),
        F.try_divide(F.aggregate(F.slice(schedule, 1, i), F.lit(0.0), lambda a, x: a + area(x)), total).alias("d0"),
        F.try_divide(area(s), total).alias("d")))


def _time_of(spans: Column, x: Column) -> Column:
    """The time at which the integrated weights reach the part x of their whole."""
    span = F.element_at(F.filter(spans, lambda s: (s["d0"] <= x) & (s["d"] > 0)), -1)

    def inside(s: Column) -> Column:
        y = F.least(F.greatest((x - s["d0"]) / s["d"], F.lit(0.0)), F.lit(1.0)) * (s["w0"] + s["w1"]) / 2
        rise = s["w1"] - s["w0"]
        root = s["w0"] + F.sqrt(F.greatest(s["w0"] * s["w0"] + 2 * rise * y, F.lit(0.0)))
        return s["t0"] + (s["t1"] - s["t0"]) * F.when(root > 0, F.least(2 * y / root, F.lit(1.0))).otherwise(0.0)

    return F.element_at(F.transform(F.array(span), inside), 1)


def assign_positions(rows: DataFrame, sources: DataFrame, source: str = "source", size: str = "size", seed: int = 23,
                     most: int = MOST_REPEATS, ties: Sequence[str] | None = None) -> DataFrame:
    """Adds ``source_size``, ``target``, ``repeats`` and ``positions`` (training times from 0 to 1, one for each time
    that the mix takes the row, in order).

    ``sources`` has a row for each source with ``target`` and ``schedule``. In a seeded order the rows of a source lay
    their sizes end to end, round after round, until the target is reached: a row is taken in a round if its middle lies
    before the target, so a source misses it by half a row at most. The middle, as a part of the target, is where the
    integrated weights of the source are inverted to a time.

    A null source is a source of its own; rows of no size are taken where they stand; rows that are equal in the columns
    ``ties`` (all, if not given) may change places. No rows give no rows. Equal runs give equal results. Columns called like
    the results are replaced, any other names may be used.
    """
    own = ["source_size", "target", "schedule", "repeats", "positions"]
    keep = [c for c in rows.columns if c.lower() not in own]
    names_in = sheltered(keep)
    keyed = rows.select(*[F.col(c).alias(names_in[c]) for c in keep], tie_breaker(rows, ties or keep, seed).alias("_key"))
    plans = sources.select(*null_safe([source]), F.col("target"), _integrated(F.col("schedule")).alias("_spans"))
    source, size = names_in[source], names_in[size]
    laid = running(keyed, [source], "_key", size, slices_for(rows.count()))
    names = group_names([source])
    middle = lambda e: e * F.col("_total") + F.col("_before") + F.col(size) / 2
    rounds = F.sequence(F.lit(0), F.lit(most - 1))
    taken = F.filter(rounds, lambda e: middle(e) < F.col("target"))
    return (
        laid.select("*", *null_safe([source]))
        .join(plans, names)
        .withColumn("_taken", F.transform(taken, lambda e: _time_of(F.col("_spans"), middle(e) / F.col("target"))))
        .select(*[F.col(names_in[c]).alias(c) for c in keep], F.col("_total").cast("long").alias("source_size"), "target",
                F.size("_taken").alias("repeats"), F.col("_taken").alias("positions"))
    )


def curriculum_plan(rows: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """The cyclic weights of the sources, their capped targets and their ramp schedules."""
    return stage(ramp_schedule(capped_targets(cyclic_weights(source_sizes(rows, source, size), source))), "mixture")


def in_training_order(assigned: DataFrame) -> DataFrame:
    """A row for each time that the mix takes a document, range-sorted by ``position``."""
    return assigned.withColumn("position", F.explode("positions")).drop("positions").orderBy("position")
