"""Backfill windows and the audit of what each of them returned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from risewatch.functions.time import epoch_seconds, from_epoch_seconds

# Window length, how far back, and hits at which a result may be cut off.
WINDOW_HOURS = 12
YEARS_BACK = 2
HIT_CAP = 1000


def window_plan(
    bounds: DataFrame | None = None,
    *,
    spark: SparkSession | None = None,
    as_of: str | None = None,
    years: int = YEARS_BACK,
    hours: int = WINDOW_HOURS,
) -> DataFrame:
    """Consecutive windows ``(bucket, window_start, window_end)`` up to the end.

    The range is the one row ``(range_start, range_end)`` of ``bounds``, or the
    ``years`` of 365 days before ``as_of``.  The last window is clipped to the end.
    """
    if bounds is None:
        end = F.lit(as_of).cast("timestamp_ntz")
        start = end - F.make_dt_interval(days=F.lit(years * 365))
        bounds = spark.range(1).select(start.alias("range_start"), end.alias("range_end"))
    step = F.lit(hours * 3600)
    start, end = epoch_seconds("range_start"), epoch_seconds("range_end")
    buckets = F.ceil((end - start) / step)
    return (
        bounds.filter(end > start)
        .select(
            F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)).alias("bucket"),
            start.alias("_start"),
            end.alias("_end"),
        )
        .select(
            "bucket",
            from_epoch_seconds(F.col("_start") + F.col("bucket") * step).alias("window_start"),
            from_epoch_seconds(
                F.least(F.col("_start") + (F.col("bucket") + 1) * step, F.col("_end"))
            ).alias("window_end"),
        )
    )


def coverage_audit(
    stories: DataFrame,
    plan: DataFrame,
    range_start: Column,
    hours: int = WINDOW_HOURS,
    cap: int = HIT_CAP,
) -> DataFrame:
    """Stories per planned window, flagging windows at the cap and empty ones.

    Stories are counted by bucket number before they meet the plan, so the join
    sees one row per window on either side.  The last window holds the end of the
    range.
    """
    created = epoch_seconds("created_at")
    bucket = F.floor((created - epoch_seconds(range_start)) / F.lit(hours * 3600))
    # one row each
    end = epoch_seconds(plan.agg(F.max("window_end")).scalar())
    last = plan.agg(F.max("bucket")).scalar()
    counts = stories.groupBy(F.when(created == end, last).otherwise(bucket).alias("bucket")).agg(
        F.count("*").alias("n_stories")
    )
    return _flag(plan.join(counts, "bucket", "left"), "n_stories", cap)


def page_audit(pages: DataFrame, window: str, cap: int = HIT_CAP) -> DataFrame:
    """The same audit from the totals the first landed page of each window reports."""
    first = pages.filter(F.coalesce("page", F.lit(0)) == 0)
    reported = F.coalesce("nbHits", F.size("hits").cast("long"))
    totals = first.groupBy(window).agg(F.max(reported).alias("n_stories"))
    return _flag(totals, "n_stories", cap)


def _flag(windows: DataFrame, count: str, cap: int) -> DataFrame:
    counted = windows.withColumn(count, F.coalesce(count, F.lit(0).cast("long")))
    return counted.withColumn("maybe_truncated", F.col(count) >= cap).withColumn(
        "is_empty", F.col(count) == 0
    )
