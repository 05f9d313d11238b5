"""Quality gates as a table: (check_name, passed, observed, threshold)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risewatch.functions.time import age_hours

# Fixed value: hours the newest story may be old.
MAX_AGE_HOURS = 26.0


class QualityError(ValueError):
    """A gate failed."""


def _check(df: DataFrame, name: str, observed: Column, passed: Column, threshold: float) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
    )


def new_stories(inserted: DataFrame) -> DataFrame:
    """Something was loaded."""
    counted = inserted.agg(F.count("*").alias("n"))
    return _check(counted, "new_stories", F.col("n"), F.col("n") > 0, 1)


def has_events(events: DataFrame) -> DataFrame:
    """The event table is not empty."""
    counted = events.agg(F.count("*").alias("n"))
    return _check(counted, "keyword_events", F.col("n"), F.col("n") > 0, 1)


def freshness(stories: DataFrame, as_of: Column, max_age: float = MAX_AGE_HOURS) -> DataFrame:
    """The newest story is young enough; an empty table passes."""
    newest = stories.agg(F.max("created_at").alias("newest"))
    age = age_hours("newest", as_of)
    return _check(newest, "freshness", age, F.coalesce(age <= max_age, F.lit(True)), max_age)


def unique_key(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """No key occurs twice; ``observed`` counts the keys that do."""
    repeated = df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    counted = repeated.agg(F.count("*").alias("n"))
    return _check(counted, f"unique_{name}", F.col("n"), F.col("n") == 0, 0)


def raise_on_failure(checks: DataFrame) -> None:
    """Raise :class:`QualityError` naming the failed gates (one row per gate)."""
    failed = [f"{r.check_name} ({r.observed})" for r in checks.filter("NOT passed").collect()]
    if failed:
        raise QualityError("quality checks failed: " + ", ".join(failed))
