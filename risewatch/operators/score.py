"""Hype score: the three weekly metrics on one 0..100 scale."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from risewatch.functions.numbers import round_stable

# Weight of each metric, and decimals kept.
WEIGHTS = {"mention_count": 0.5, "weighted_score": 0.3, "avg_comments": 0.2}
DECIMALS = 4


def minmax(value: Column | str, over: WindowSpec) -> Column:
    """Scale to 0..100 within the window; 50 everywhere if all values are equal."""
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    low, high = F.min(value).over(over), F.max(value).over(over)
    return F.when(high == low, F.lit(50.0)).otherwise((value - low) / (high - low) * 100)


def hype_scores(
    mentions: DataFrame,
    weeks: Sequence[str] | None = None,
    weights: Mapping[str, float] = WEIGHTS,
) -> DataFrame:
    """Set ``hype_score`` on the rows of the given weeks, or of all.

    A week's window holds one row per keyword, so it is bounded by the taxonomy
    and not by the number of stories.
    """
    week = Window.partitionBy("iso_week")
    score = F.lit(0.0)
    for metric, weight in weights.items():
        score = score + weight * minmax(metric, week)
    score = round_stable(score, DECIMALS)
    if weeks is not None:
        score = F.when(F.col("iso_week").isin(list(weeks)), score).otherwise(F.col("hype_score"))
    return mentions.withColumn("hype_score", score)
