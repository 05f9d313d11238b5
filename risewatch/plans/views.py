"""The three views a dashboard shows, each as a set of lazy frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from risewatch.operators import reports
from risewatch.sources.tables import Tables
from risewatch.taxonomy import DEFAULT, Taxonomy


def _of_week(tables: Tables, name: str, week: str | Column) -> DataFrame:
    """A label prunes folders of every table; a column can only filter rows."""
    return tables.read(name, weeks=[week]) if isinstance(week, str) else tables.read(name)


def trending_view(
    tables: Tables,
    week: str | Column,
    category: str = reports.ALL_CATEGORIES,
    taxonomy: Taxonomy = DEFAULT,
) -> dict[str, DataFrame]:
    """Trending list, risers, fallers, and the best story of each anomaly."""
    velocity, mentions, events, stories = (
        _of_week(tables, name, week)
        for name in ("keyword_velocity", "weekly_mentions", "keyword_events", "raw_stories")
    )
    shown = reports.in_category(reports.trending_keywords(velocity, mentions, week), taxonomy, category)
    feed = reports.anomaly_feed(velocity, events, stories, week)
    return {
        "trending": shown,
        "risers": reports.risers(shown),
        "fallers": reports.fallers(shown),
        "anomalies": reports.top_story_per_keyword(feed),
    }


def hype_cycle_view(
    tables: Tables, keywords: Sequence[str], n_weeks: int = reports.HISTORY_WEEKS
) -> dict[str, DataFrame]:
    """Score history side by side, and the difference if two keywords are given."""
    mentions = tables.read("weekly_mentions")
    view = {"history": reports.hype_pivot(mentions, keywords, n_weeks)}
    if len(keywords) == 2:
        view["difference"] = reports.compare_keywords(mentions, *keywords, n_weeks)
    return view


def emerging_view(tables: Tables, week: str | Column, limit: int = reports.FEED_ROWS) -> DataFrame:
    """Best stored terms of a week; empty if none were ever stored."""
    return reports.stored_emerging_terms(_of_week(tables, "emerging_terms", week), week, limit)
