"""Velocity: how a keyword's score moves against its own recent weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risewatch.functions.numbers import round_stable
from risewatch.operators.rollup import only_weeks

# Weeks looked back, rows needed for a z-score, flag threshold,
# scale of the substitute z-score of a flat history, decimals kept.
LOOKBACK = 12
MIN_HISTORY = 2
Z_THRESHOLD = 2.0
FLAT_SCALE = 2.0 / 0.5
DECIMALS = 4

# Scores have four decimals, so a history that varies at all has a standard
# deviation above 2e-5; anything below this is floating-point noise.
FLAT_STD = 1e-9


def rolling_stats(mentions: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """Add previous score and count, mean and deviation of the rows before.

    "Before" means stored weeks of the keyword, so weeks without mentions leave
    no gap.  Rows without a score are no history and drop out.  A keyword's
    window holds one row per week, whatever its number of stories.
    """
    ordered = Window.partitionBy("keyword").orderBy("iso_week")
    before = ordered.rowsBetween(-lookback, -1)
    score = F.col("hype_score")
    return (
        mentions.filter(score.isNotNull())
        .withColumn("prev_score", F.lag(score).over(ordered))
        .withColumn("history", F.count(score).over(before))
        .withColumn("mean_before", F.avg(score).over(before))
        .withColumn("std_before", F.stddev_samp(score).over(before))
    )


def keyword_velocity(
    mentions: DataFrame,
    weeks: Sequence[str] | None = None,
    lookback: int = LOOKBACK,
    threshold: float = Z_THRESHOLD,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Week-over-week change in %, rolling mean, z-score and flags.

    All weeks are computed in one pass; ``weeks`` selects rows afterwards, since
    a week needs the ones before it.  ``carry`` names columns of ``mentions`` to
    keep, which saves joining the two later.
    """
    score, prev = F.col("hype_score"), F.col("prev_score")
    mean, std = F.col("mean_before"), F.col("std_before")
    enough = F.col("history") >= MIN_HISTORY

    change = F.when(prev.isNull() | (prev == 0), 0.0).otherwise((score - prev) / prev * 100)
    z = (
        F.when(~enough, 0.0)
        .when(std > FLAT_STD, (score - mean) / std)
        .when(mean > 0, (score - mean) / mean * FLAT_SCALE)
        .otherwise(0.0)
    )
    return (
        only_weeks(rolling_stats(mentions, lookback), weeks)
        .withColumn("_z", z)
        .select(
            "keyword",
            "iso_week",
            round_stable(change, DECIMALS).alias("velocity"),
            round_stable(F.when(enough, mean).otherwise(score), DECIMALS).alias("rolling_avg"),
            round_stable("_z", DECIMALS).alias("z_score"),
            (F.col("_z") > threshold).alias("is_trending"),
            (F.col("_z") < -threshold).alias("is_crashing"),
            *carry,
        )
    )
