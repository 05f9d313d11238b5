"""Weekly rollup of mentions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risewatch.functions.time import week_label


def with_week(stories: DataFrame) -> DataFrame:
    if "iso_week" in stories.columns:
        return stories
    return stories.withColumn("iso_week", week_label("created_at"))


def only_weeks(df: DataFrame, weeks: Sequence[str] | None) -> DataFrame:
    """Keep the given weeks: on stored tables a partition filter."""
    return df if weeks is None else df.filter(F.col("iso_week").isin(list(weeks)))


def rollup_mentions(matched: DataFrame) -> DataFrame:
    """(keyword, iso_week) metrics from rows of story and keyword.

    Rows without a date have no week and drop out.  A missing score counts in
    the denominator of ``weighted_score``; a missing comment count does not
    count in ``avg_comments``.  The partial aggregation leaves one row per key
    and task to shuffle, however popular a keyword is.
    """
    return (
        matched.filter(F.col("iso_week").isNotNull())
        .groupBy("keyword", "iso_week")
        .agg(
            F.count("*").alias("mention_count"),
            (F.sum("score").cast("double") / F.count("*")).alias("weighted_score"),
            F.avg("num_comments").alias("avg_comments"),
        )
    )


def weekly_mentions(
    events: DataFrame, stories: DataFrame, weeks: Sequence[str] | None = None
) -> DataFrame:
    """Rollup of stored events, with score, comments and date of the story itself.

    The week label of an event row is that of its story, so with ``weeks`` both
    sides read only those partitions.
    """
    stories = only_weeks(with_week(stories), weeks)
    if "iso_week" in events.columns:
        events = only_weeks(events, weeks)
    matched = events.select("story_id", "keyword").join(
        stories.select("story_id", "iso_week", "score", "num_comments"), "story_id"
    )
    return rollup_mentions(matched)


def distinct_weeks(df: DataFrame) -> DataFrame:
    return df.select("iso_week").distinct().orderBy("iso_week")


def available_keywords(mentions: DataFrame, week: str | None = None) -> DataFrame:
    """Sorted distinct keywords, of one week or of all."""
    if week is not None:
        mentions = mentions.filter(F.col("iso_week") == week)
    return mentions.select("keyword").distinct().orderBy("keyword")
