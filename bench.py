"""Wall time of the headline queries; prints one JSON line.

Part one builds the stored tables (load, rebuild, emerging terms), part two reads
them as a dashboard would, first cold (from opening the tables on, nothing of it run
before) and then warm, part three runs catalogue queries from the raw tables.
Everything else is run once to warm up; then parts one and three are timed once and
the short reads of part two BENCH_RUNS times, of which the median counts.
Detection runs over titles that hold names of the built-in taxonomy, and with 100 and
5,000 names of two words over documents.
Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS, BENCH_MEMORY.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risewatch.catalog.feeds import (
    PART_TAXONOMY,
    STOP_WORDS,
    TREND_ORDER,
    default_titles,
    scratch,
    table,
    trend_feed,
)
from risewatch.catalog.queries import all_queries
from risewatch.operators import reports
from risewatch.operators.detect import matched_stories
from risewatch.plans.jobs import discover, rebuild
from risewatch.plans.views import emerging_view, hype_cycle_view, trending_view
from risewatch.sources.tables import Tables
from risewatch.taxonomy import DEFAULT, Taxonomy

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

FROM_RAW = [
    "parse_hits",
    "insert_ignore_dedup",
    "keyword_events",
    "weekly_mentions",
    "keyword_velocity",
    "trending_keywords",
    "anomaly_feed",
    "hype_pivot",
    "detect_documents",
    "tfidf_scores",
    "emerging_by_source",
    "emerging_terms",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median(action, runs: int = RUNS) -> float:
    """Median time of so many runs, after one to warm up."""
    action()
    return statistics.median(timed(action) for _ in range(runs))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # the default of 64 MB would leave the writing of small tables to one task
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    # part one: build, once to warm up and once timed
    for _ in range(2):
        tables = Tables(spark, scratch(spark))
        seconds["load_stories"] = timed(
            lambda: tables.insert_stories(trend_feed(spark, SF_DIR), TREND_ORDER)
        )
        seconds["rebuild"] = timed(lambda: rebuild(tables, PART_TAXONOMY))
        seconds["discover_terms"] = timed(
            lambda: discover(tables, PART_TAXONOMY, stop_words=STOP_WORDS)
        )

    # part two: read
    def dashboard() -> None:
        own = Tables(spark, tables.root, create=False)
        week = own.read("keyword_velocity").filter("is_trending").agg(F.max("iso_week").alias("w")).first()["w"]
        for df in [
            *trending_view(own, week, "Noun", PART_TAXONOMY).values(),
            *hype_cycle_view(own, ["gizmo", "blue"], 104).values(),
            emerging_view(own, week),
        ]:
            run(df)

    seconds["dashboard_cold"] = timed(dashboard)
    seconds["dashboard_all_views"] = timed(dashboard)
    stories = tables.read("raw_stories")
    mentions, velocity = tables.read("weekly_mentions"), tables.read("keyword_velocity")
    week = velocity.filter("is_trending").agg(F.max("iso_week").alias("w")).first()["w"]
    view = trending_view(tables, week, "Noun", PART_TAXONOMY)
    reads = {
        "read_trending": reports.trending_keywords(velocity, mentions, week),
        "read_two_year_pivot": reports.hype_pivot(mentions, PART_TAXONOMY.category_of(), 104),
        "read_hype_cycle": reports.hype_cycle(mentions, "gizmo", 104),
        "read_anomaly_stories": view["anomalies"],
        "read_top_trending": reports.top_trending(velocity),
        "read_emerging": reports.stored_emerging_terms(tables.read("emerging_terms"), week),
    }
    for name, df in reads.items():
        seconds[name] = median(lambda df=df: run(df))

    # detection alone, with the built-in taxonomy over titles that hold its names
    titles = default_titles(spark, SF_DIR)
    n_titles = titles.count()
    seconds["detect_default_taxonomy"] = median(lambda: run(matched_stories(titles, DEFAULT)))
    texts = table(spark, SF_DIR, "documents").select("doc_id", F.col("text").alias("title"), F.lit(None).cast("string").alias("url"))
    for n in (100, 5_000):
        many = Taxonomy({"Many": [f"the word{i}" for i in range(n // 2)] + [f"name{i}" for i in range(n // 2)]})
        seconds[f"detect_{n}_names"] = median(lambda many=many: run(matched_stories(texts, many)), runs=1)

    # part three: from the raw tables
    for name in FROM_RAW:
        query = all_queries()[name]
        seconds[name] = median(lambda query=query: run(query(spark, SF_DIR)), runs=1)

    n_stories = stories.count()
    rate = n_titles / seconds["detect_default_taxonomy"]
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "stories": n_stories,
                "detect_stories_per_sec": round(rate),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
