"""Does a user's posting rhythm look automated?

Gaps between posts are whole seconds, newest first. With n gaps: ``avg_tweet_freq`` is their
mean, ``avg_tweet_reg`` the mean change from one gap to the next, ``tweet_freq_variance`` the sum
of squared distances from the mean; both means truncate toward zero.

The changes telescope to newest gap minus oldest gap, and the squared distances follow from the
sums of gaps and of squared gaps. So one aggregation gives all three.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlark.functions.times import epoch_ms, int_div, wrap_int32


@dataclass(frozen=True)
class Thresholds:
    """Fixed values by default: too fast, too regular, and the spread that clears a user."""

    fast: int = 600
    regular: int = 60
    spread: int = 500_000_000


DEFAULT_THRESHOLDS = Thresholds()
TIMELINE_SIZE = 20


def newest(history: DataFrame, size: int = TIMELINE_SIZE) -> DataFrame:
    """The newest posts of each user. Each task keeps ``size`` per user before the shuffle."""
    order = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("post_id"))
    return history.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= size).drop("_rn")


def gaps(timeline: DataFrame, *within: str) -> DataFrame:
    """Add ``ms`` and ``dt``, the seconds to the next newer post of the same group."""
    keys = within or ("user_id",)
    order = Window.partitionBy(*keys).orderBy(F.desc("ts"), F.desc("post_id"))
    stamped = timeline.withColumn("ms", epoch_ms(F.col("ts")))
    return stamped.withColumn("dt", int_div(F.lag("ms").over(order) - F.col("ms"), F.lit(1000)))


def gap_changes(timeline: DataFrame) -> DataFrame:
    """Add ``dd``, the change from the newer gap to this one."""
    order = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("post_id"))
    return gaps(timeline).withColumn("dd", F.lag("dt").over(order) - F.col("dt"))


def _moments(value: str) -> list[Column]:
    at = F.struct("ts", "post_id")
    present = F.when(F.col(value).isNotNull(), at)
    return [
        F.count(value).alias("n"),
        F.sum(value).alias("s1"),
        F.sum(F.col(value) * F.col(value)).alias("s2"),
        F.max_by(value, present).alias("newest_gap"),
        F.min_by(value, present).alias("oldest_gap"),
    ]


def _timeline_moments(history: DataFrame, size: int) -> DataFrame:
    return gaps(newest(history, size)).groupBy("user_id").agg(*_moments("dt"))


def _history_moments(history: DataFrame, slice_seconds: int) -> DataFrame:
    """Moments over whole histories, however long.

    A user's posts are cut into time slices handled by different tasks. A slice reports its
    moments and its ends; the gap between two neighbouring slices is added on the slices' level,
    where a user has one row per slice in use.
    """
    sliced = history.withColumn(
        "slice", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / slice_seconds)
    )
    slices = (
        gaps(sliced, "user_id", "slice")
        .groupBy("user_id", "slice")
        .agg(*_moments("dt"), F.max("ms").alias("last_ms"), F.min("ms").alias("first_ms"))
    )
    newer = Window.partitionBy("user_id").orderBy(F.desc("slice"))
    bridge = F.col("bridge")
    bridged = slices.withColumn(
        "bridge", int_div(F.lag("first_ms").over(newer) - F.col("last_ms"), F.lit(1000))
    ).select(
        "user_id", "slice",
        (F.col("n") + F.when(bridge.isNull(), 0).otherwise(1)).alias("n"),
        (F.coalesce("s1", F.lit(0)) + F.coalesce(bridge, F.lit(0))).alias("s1"),
        (F.coalesce("s2", F.lit(0)) + F.coalesce(bridge * bridge, F.lit(0))).alias("s2"),
        F.coalesce(bridge, F.col("newest_gap")).alias("newest_gap"),
        F.coalesce(F.col("oldest_gap"), bridge).alias("oldest_gap"),
    )
    present = F.when(F.col("newest_gap").isNotNull(), F.col("slice"))
    return bridged.groupBy("user_id").agg(
        F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"),
        F.max_by("newest_gap", present).alias("newest_gap"),
        F.min_by("oldest_gap", present).alias("oldest_gap"),
    )


def label_bots(scores: DataFrame, limits: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Fast or regular posting marks a bot, unless the gaps spread too much."""
    fast = F.col("avg_tweet_freq") < limits.fast
    regular = F.abs("avg_tweet_reg") < limits.regular
    spread = F.col("tweet_freq_variance") > limits.spread
    return scores.withColumn("is_bot", (fast | regular) & ~spread)


def cadence(
    history: DataFrame,
    size: int | None = TIMELINE_SIZE,
    limits: Thresholds = DEFAULT_THRESHOLDS,
    int32_wrap: bool = False,
    min_posts: int = 0,
    slice_seconds: int = 3600,
) -> DataFrame:
    """(user_id, avg_tweet_freq, avg_tweet_reg, tweet_freq_variance, is_bot) from (user_id, ts, post_id).

    ``size`` is the length of the timeline looked at, ``None`` the whole history. With
    ``int32_wrap`` the variance overflows as a 32-bit sum would. Users with fewer than
    ``min_posts`` posts are no bots. Sums of squares fit BIGINT while a timeline spans less than
    68 years.
    """
    known = history.filter(F.col("ts").isNotNull() & F.col("user_id").isNotNull())
    m = _history_moments(known, slice_seconds) if size is None else _timeline_moments(known, size)
    zero = F.lit(0).cast("bigint")
    s1 = F.coalesce(F.col("s1"), zero)
    averaged = m.select(
        "user_id", "n", s1.alias("s1"), F.coalesce(F.col("s2"), zero).alias("s2"),
        int_div(s1, F.greatest(F.col("n"), F.lit(1))).alias("avg_tweet_freq"),
        int_div(
            F.coalesce(F.col("newest_gap") - F.col("oldest_gap"), zero),
            F.greatest(F.col("n") - 1, F.lit(1)),
        ).alias("avg_tweet_reg"),
    )
    f = F.col("avg_tweet_freq")
    variance = F.col("s2") - f * 2 * F.col("s1") + f * f * F.col("n")
    scored = averaged.withColumn(
        "tweet_freq_variance", wrap_int32(variance) if int32_wrap else variance
    )
    labelled = label_bots(scored, limits).withColumn(
        "is_bot", F.col("is_bot") & (F.col("n") + 1 >= min_posts)
    )
    return labelled.select(
        "user_id", "avg_tweet_freq", "avg_tweet_reg", "tweet_freq_variance", "is_bot"
    )


def score_people(
    people: DataFrame, scores: DataFrame, limits: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    """Scores for every person; someone without posts scores all zeros."""
    filled = people.join(scores.drop("is_bot"), "user_id", "left").na.fill(
        0, ["avg_tweet_freq", "avg_tweet_reg", "tweet_freq_variance"]
    )
    return label_bots(filled, limits)


def unscored_batch(people: DataFrame, scored: DataFrame, size: int = 150) -> DataFrame:
    """The next people to score, by id."""
    return people.join(scored.select("user_id"), "user_id", "left_anti").orderBy("user_id").limit(size)
