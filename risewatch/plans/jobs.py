"""Composite jobs: full rebuild, daily refresh, and the two as lazy frames."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from risewatch.functions.time import ntz, week_label
from risewatch.operators import quality
from risewatch.operators.detect import keyword_events, matched_stories, unprocessed, with_category
from risewatch.operators.emerging import emerging_terms
from risewatch.operators.keyed import merge_replace
from risewatch.operators.rollup import only_weeks, rollup_mentions, weekly_mentions, with_week
from risewatch.operators.score import hype_scores
from risewatch.operators.velocity import LOOKBACK, keyword_velocity
from risewatch.sources.pages import high_water_mark, in_time_range
from risewatch.sources.tables import Tables, observed_rows
from risewatch.taxonomy import DEFAULT, Taxonomy


def recent_weeks(spark: SparkSession, as_of: str | datetime.date) -> DataFrame:
    """Distinct labels of the week of ``as_of`` and of seven days before."""
    return recent_weeks_of(spark.range(1).select(F.lit(str(as_of)).cast("date").alias("as_of")))


def recent_weeks_of(days: DataFrame, column: str = "as_of") -> DataFrame:
    """Distinct labels of the weeks of the given days and of seven days before."""
    day = F.col(column).cast("date")
    both = F.explode(F.array(day, F.date_sub(day, 7)))
    return days.select(both.alias("_day")).select(week_label("_day").alias("iso_week")).distinct()


def scored_tables(stories: DataFrame, taxonomy: Taxonomy = DEFAULT) -> dict[str, DataFrame]:
    """Every derived table of ``stories`` as a lazy frame, for all weeks at once.

    A match already carries its story's score and comments, so the rollup reads
    the matches directly: there is no join of events back to stories.
    """
    matched = matched_stories(with_week(stories), taxonomy)
    mentions = hype_scores(rollup_mentions(matched))
    return {
        "keyword_events": with_category(matched, taxonomy).select(
            "story_id", "keyword", "category", "score", "created_at", "iso_week"
        ),
        "weekly_mentions": mentions,
        "keyword_velocity": keyword_velocity(mentions),
    }


def rebuild(tables: Tables, taxonomy: Taxonomy = DEFAULT) -> dict[str, int]:
    """Recompute all derived tables from the stored stories; returns row counts.

    Detection is a projection and runs once for the events and once for the
    rollup, which therefore needs no join of events back to stories.
    """
    lazy = scored_tables(tables.read("raw_stories"), taxonomy)
    counts = {
        "keyword_events": tables.overwrite("keyword_events", lazy["keyword_events"], like="raw_stories"),
        "weekly_mentions": tables.overwrite("weekly_mentions", lazy["weekly_mentions"]),
    }
    velocity = keyword_velocity(tables.read("weekly_mentions"))
    counts["keyword_velocity"] = tables.overwrite("keyword_velocity", velocity)
    return counts


def detection_totals(stories: DataFrame, events: DataFrame) -> DataFrame:
    """One row: stories processed, events found, stories with an event."""
    return stories.agg(F.count("*").alias("stories_processed")).select(
        "stories_processed",
        events.agg(F.count("*")).scalar().alias("hits_written"),
        events.agg(F.count_distinct("story_id")).scalar().alias("stories_with_hits"),
    )


def detect_new(
    tables: Tables,
    taxonomy: Taxonomy = DEFAULT,
    ids: DataFrame | None = None,
    weeks: Sequence[str] | None = None,
) -> dict[str, int]:
    """Append the events of stored stories that have none yet.

    Returns ``stories_processed`` and ``hits_written``.  Without limits every story
    without an event is looked at again, which a changed taxonomy calls for.
    ``weeks`` limits the run to those partitions of both tables (null among them:
    stories without a date), ``ids`` to the stories of a batch.
    """
    if weeks is None:
        stories, events = tables.read("raw_stories"), tables.read("keyword_events")
    else:
        dated = [w for w in weeks if w is not None]
        undated = F.col("iso_week").isNull() if None in weeks else F.lit(False)
        looked_at = F.col("iso_week").isin(dated) | undated
        stories, events = (tables.read(name).filter(looked_at) for name in ("raw_stories", "keyword_events"))
    if ids is not None:
        ids = ids.select("story_id").distinct()
        stories = stories.join(ids, "story_id", "left_semi")
        events = events.join(ids, "story_id", "left_semi")
    left = unprocessed(stories, events)
    seen = Observation()  # counted by the tasks that detect, in the job that writes the events
    observed = left.observe(seen, F.count("*").alias("n"))
    written = tables.append("keyword_events", keyword_events(observed, taxonomy))
    # with nothing to write, adaptive execution drops the counter with the plan
    return {"stories_processed": observed_rows(seen) if written else left.count(), "hits_written": written}


def rescore(tables: Tables, weeks: Sequence[str], later_weeks: bool = False) -> dict[str, int]:
    """Aggregate, score and re-flag the given weeks; returns rows written by table.

    Stored rows that no longer come up stay, and a stored score outlives the
    aggregation until the scoring replaces it.  ``later_weeks`` also re-flags
    the weeks whose history has changed: of each keyword the LOOKBACK stored weeks
    after a given one.
    """
    weeks = sorted(weeks)
    fresh = weekly_mentions(
        tables.read("keyword_events", weeks=weeks), tables.read("raw_stories", weeks=weeks), weeks
    )
    return store_mentions(tables, fresh, weeks, later_weeks)


def store_mentions(tables: Tables, fresh: DataFrame, weeks: Sequence[str], later_weeks: bool = False) -> dict[str, int]:
    """Upsert the rollup rows ``fresh`` of the given weeks, then score and re-flag these weeks."""
    key = ["keyword", "iso_week"]
    stored = tables.read("weekly_mentions", weeks=weeks)
    merged = merge_replace(fresh, stored, key, keep=["hype_score"])
    counts = {
        "weekly_mentions": tables.replace_weeks("weekly_mentions", hype_scores(merged, weeks), weeks)
    }

    # one row per keyword and week, so the whole history is small
    flagged = keyword_velocity(tables.read("weekly_mentions"))
    touched = affected_weeks(tables.read("weekly_mentions"), weeks) if later_weeks else weeks
    old = tables.read("keyword_velocity", weeks=touched)
    merged = merge_replace(only_weeks(flagged, touched), old, key)
    counts["keyword_velocity"] = tables.replace_weeks("keyword_velocity", merged, touched)
    return counts


def affected_weeks(mentions: DataFrame, weeks: Sequence[str], lookback: int = LOOKBACK) -> list[str]:
    """The given weeks and those that have one of them among a keyword's ``lookback`` scored weeks before."""
    ordered = Window.partitionBy("keyword").orderBy("iso_week")
    changed = F.col("iso_week").isin(list(weeks)).cast("int")
    near = F.max(changed).over(ordered.rowsBetween(-lookback, 0)) == 1
    rows = mentions.filter(F.col("hype_score").isNotNull()).withColumn("_near", near)
    # labels, so bounded by the calendar
    later = rows.filter("_near").select("iso_week").distinct().collect()
    return sorted({*weeks, *(row["iso_week"] for row in later)})


def refresh(
    tables: Tables,
    stories: DataFrame,
    as_of: str | datetime.datetime,
    taxonomy: Taxonomy = DEFAULT,
    weeks: Sequence[str] | None = None,
    newer_only: bool = True,
    order: Sequence[str | Column] | None = None,
    new_taxonomy: bool = False,
    raise_failures: bool = True,
) -> DataFrame:
    """The daily job: load, detect, re-score the recent weeks, check.

    ``newer_only`` drops stories not newer than the newest stored one;
    ``weeks`` defaults to the week of ``as_of`` and the one before.  Detection looks
    at the stories of this load only, unless ``new_taxonomy`` asks for all that have
    no event.  Returns the gates, after raising if one failed.
    """
    spark = tables.spark
    if newer_only:
        since = high_water_mark(tables.read("raw_stories")).first()["since_ts"]
        stories = in_time_range(stories, since)
    inserted = tables.insert_stories(stories, order, fetched_at=ntz(as_of))
    if new_taxonomy:
        detect_new(tables, taxonomy)
    else:
        # labels, so bounded by the calendar and not by the stories
        labels = stories.select(week_label("created_at").alias("w")).distinct().collect()
        detect_new(tables, taxonomy, ids=stories, weeks=[row["w"] for row in labels])
    if weeks is None:
        weeks = [row["iso_week"] for row in recent_weeks(spark, str(as_of)[:10]).collect()]
    rescore(tables, weeks)
    checks = (
        quality.new_stories(spark.range(inserted))
        .unionByName(quality.has_events(tables.read("keyword_events")))
        .unionByName(quality.freshness(tables.read("raw_stories"), ntz(as_of)))
    )
    if raise_failures:
        quality.raise_on_failure(checks)
    return checks


def discover(
    tables: Tables,
    taxonomy: Taxonomy = DEFAULT,
    weeks: Sequence[str] | None = None,
    **options,
) -> int:
    """Store the emerging terms of the given weeks (all by default); returns new rows."""
    return tables.insert_terms(
        emerging_terms(tables.read("raw_stories"), taxonomy, weeks, **options)
    )
