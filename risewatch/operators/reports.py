"""Read queries over the weekly tables.

``week`` is a label or a column holding one, for instance
``latest_week(mentions).scalar()``.  Stored tables are read by week beforehand
(``Tables.read(name, weeks=[week])``), which is a partition filter on all of them.
Every ranking ends in a total order: the keyword, then the story, ascending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risewatch.functions.time import week_label
from risewatch.operators.detect import with_category
from risewatch.operators.velocity import keyword_velocity
from risewatch.taxonomy import Taxonomy

# Rows of each report, history choices, default comparison,
# "no filter" choice, link of a story, characters of a title shown.
FEED_ROWS = 20
MOVERS = 5
TOP_TRENDING = 10
HISTORY_CHOICES = (4, 8, 12, 26, 52)
HISTORY_WEEKS = 12
DEFAULT_KEYWORDS = ("Python", "Rust", "Go", "TypeScript")
ALL_CATEGORIES = "All"
STORY_LINK = "https://news.ycombinator.com/item?id="
TITLE_CHARS = 80
FALLBACK_KEYWORDS = 4

TRENDING_COLUMNS = (
    "keyword", "velocity", "z_score", "is_trending", "is_crashing", "hype_score", "mention_count",
)


def latest_week(mentions: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row, ``iso_week``: the last week with mentions, else that of ``as_of``."""
    today = F.current_date() if as_of is None else as_of
    return mentions.agg(F.coalesce(F.max("iso_week"), week_label(today)).alias("iso_week"))


def load_metadata(stories: DataFrame) -> DataFrame:
    """One row: last load time and number of stories."""
    return stories.agg(
        F.max("fetched_at").alias("last_run"), F.count("*").alias("total_stories")
    )


def trending_keywords(velocity: DataFrame, mentions: DataFrame, week: str | Column) -> DataFrame:
    """All keywords of a week, the fastest risers first."""
    return _trending(velocity, mentions, week).orderBy(F.desc("velocity"), "keyword")


def _of_last_week(df: DataFrame) -> DataFrame:
    """Rows of the last week: each task passes on those of its own last week only."""
    last = Window.orderBy(F.desc("iso_week"))
    return df.withColumn("_rank", F.rank().over(last)).filter("_rank = 1").drop("_rank")


def trending_now(mentions: DataFrame) -> DataFrame:
    """:func:`trending_keywords` of the last week, from scored mentions in one pass."""
    flagged = keyword_velocity(mentions, carry=("hype_score", "mention_count"))
    rows = _of_last_week(flagged).select(*TRENDING_COLUMNS)
    return rows.orderBy(F.desc("velocity"), "keyword")


def _trending(velocity: DataFrame, mentions: DataFrame, week: str | Column) -> DataFrame:
    return (
        velocity.filter(F.col("iso_week") == week)
        .join(mentions.filter(F.col("iso_week") == week), ["keyword", "iso_week"])
        .select(*TRENDING_COLUMNS)
    )


def in_category(df: DataFrame, taxonomy: Taxonomy, category: str) -> DataFrame:
    """Rows whose keyword is of ``category``; ``All`` keeps every row."""
    if category == ALL_CATEGORIES:
        return df
    return with_category(df, taxonomy, "").filter(F.col("category") == category).drop("category")


def risers(trending: DataFrame, n: int = MOVERS) -> DataFrame:
    return _movers(trending, F.desc("velocity"), n, "+")


def fallers(trending: DataFrame, n: int = MOVERS) -> DataFrame:
    return _movers(trending, F.asc("velocity"), n, "")


def _movers(trending: DataFrame, order: Column, n: int, sign: str) -> DataFrame:
    return (
        trending.orderBy(order, "keyword")
        .limit(n)
        .select(
            "keyword",
            "velocity",
            "hype_score",
            F.format_string("%.1f", "hype_score").alias("score_text"),
            F.format_string(f"{sign}%.1f%% WoW", "velocity").alias("change_text"),
        )
    )


def anomaly_feed(
    velocity: DataFrame,
    events: DataFrame,
    stories: DataFrame,
    week: str | Column,
    limit: int | None = FEED_ROWS,
) -> DataFrame:
    """Stories of a week behind its trending keywords, best first.

    The trending side has a row per keyword at most, so the planner sends it to
    the events by its own size limit.
    """
    flagged = velocity.filter((F.col("iso_week") == week) & F.col("is_trending")).select(
        "keyword", "z_score", "velocity"
    )
    if "iso_week" in events.columns:
        events = events.filter(F.col("iso_week") == week)
    if "iso_week" not in stories.columns:
        stories = stories.withColumn("iso_week", week_label("created_at"))
    of_week = stories.filter(F.col("iso_week") == week).select("story_id", "title", "score")
    feed = (
        events.select("story_id", "keyword")
        .join(flagged, "keyword")
        .join(of_week, "story_id")
        .select("keyword", "z_score", "velocity", "story_id", "title", "score")
    )
    if limit is None:
        return feed
    return feed.orderBy(*_feed_order()).limit(limit)


def anomalies_now(
    matched: DataFrame, velocity: DataFrame, limit: int | None = FEED_ROWS
) -> DataFrame:
    """:func:`anomaly_feed` of the last week in which anything trends.

    ``matched`` has a row per story and keyword with the story's title and score,
    so neither events nor stories are read again.
    """
    flagged = _of_last_week(velocity.filter("is_trending"))
    feed = matched.join(
        flagged.select("keyword", "iso_week", "z_score", "velocity"), ["keyword", "iso_week"]
    ).select("keyword", "z_score", "velocity", "story_id", "title", "score")
    if limit is None:
        return feed
    return feed.orderBy(*_feed_order()).limit(limit)


def _feed_order() -> list[Column]:
    return [F.desc("z_score"), F.desc("score"), F.asc("keyword"), F.asc("story_id")]


def top_story_per_keyword(feed: DataFrame) -> DataFrame:
    """The first story of each keyword of a feed, with link and display text."""
    best = Window.partitionBy("keyword").orderBy(*_feed_order())
    return (
        feed.withColumn("_rank", F.row_number().over(best))
        .filter("_rank = 1")
        .select(
            "keyword",
            "story_id",
            F.format_string("%.2f", "z_score").alias("z_text"),
            F.substring("title", 1, TITLE_CHARS).alias("title"),
            story_link("story_id").alias("link"),
            "score",
        )
    )


def story_link(story_id: str) -> Column:
    return F.concat(F.lit(STORY_LINK), F.col(story_id).cast("string"))


def top_trending(velocity: DataFrame, n: int = TOP_TRENDING) -> DataFrame:
    """Largest z-scores of trending rows over all weeks."""
    return (
        velocity.filter("is_trending")
        .orderBy(F.desc("z_score"), "keyword", "iso_week")
        .limit(n)
        .select("keyword", "iso_week", "z_score")
    )


def hype_cycle(mentions: DataFrame, keyword: str, n_weeks: int = HISTORY_WEEKS) -> DataFrame:
    """The latest ``n_weeks`` scored weeks of a keyword, oldest first."""
    return (
        mentions.filter((F.col("keyword") == keyword) & F.col("hype_score").isNotNull())
        .select("iso_week", "hype_score", "mention_count")
        .orderBy(F.desc("iso_week"))
        .limit(n_weeks)
        .orderBy("iso_week")
    )


def hype_cycles(
    mentions: DataFrame, keywords: Sequence[str], n_weeks: int = HISTORY_WEEKS
) -> DataFrame:
    """:func:`hype_cycle` of several keywords in one pass."""
    latest = Window.partitionBy("keyword").orderBy(F.desc("iso_week"))
    return (
        mentions.filter(F.col("keyword").isin(list(keywords)) & F.col("hype_score").isNotNull())
        .withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") <= n_weeks)
        .select("keyword", "iso_week", "hype_score", "mention_count")
    )


def hype_pivot(
    mentions: DataFrame, keywords: Sequence[str], n_weeks: int = HISTORY_WEEKS
) -> DataFrame:
    """One row per week and one column of scores per keyword."""
    return (
        hype_cycles(mentions, keywords, n_weeks)
        .groupBy("iso_week")
        .pivot("keyword", list(keywords))
        .agg(F.first("hype_score"))
    )


def compare_keywords(
    mentions: DataFrame, left: str, right: str, n_weeks: int = HISTORY_WEEKS
) -> DataFrame:
    """Score difference of two keywords by week; null where one has no score."""
    pivot = hype_pivot(mentions, [left, right], n_weeks)
    return pivot.select("iso_week", (F.col(f"`{left}`") - F.col(f"`{right}`")).alias("difference"))


def default_selection(
    mentions: DataFrame,
    wanted: Sequence[str] = DEFAULT_KEYWORDS,
    fallback: int = FALLBACK_KEYWORDS,
) -> DataFrame:
    """The wanted keywords that have data, in that order; if none has, the
    ``fallback`` alphabetically first ones.  Columns ``position``, ``keyword``."""
    spark = mentions.sparkSession
    order = spark.createDataFrame(
        list(enumerate(wanted)), "position int, keyword string"
    )
    available = mentions.select("keyword").distinct()
    hits = order.join(available, "keyword", "left_semi").select("position", "keyword")
    # never more than ``fallback`` rows reach the numbering below
    first = available.orderBy("keyword").limit(fallback).filter(~hits.exists())
    numbered = first.select(
        (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("keyword")) - 1).alias("position"),
        "keyword",
    )
    return hits.unionByName(numbered)


def stored_emerging_terms(
    terms: DataFrame, week: str | Column, limit: int = FEED_ROWS
) -> DataFrame:
    """Best stored terms of a week."""
    return (
        terms.filter(F.col("iso_week") == week)
        .orderBy(F.desc("tfidf_score"), "term")
        .limit(limit)
        .select("term", "iso_week", F.round("tfidf_score", 4).alias("tfidf_score"))
    )
