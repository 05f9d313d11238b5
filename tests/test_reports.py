import pytest
from pyspark.sql import functions as F

from risewatch.operators import quality, reports
from risewatch.operators.velocity import keyword_velocity
from risewatch.taxonomy import DEFAULT
from risewatch.functions.time import ntz

WEEK = "2023-W37"
DAY = "2023-09-12 06:15:00"


@pytest.fixture
def data(spark, make_stories):
    stories = make_stories([(70 + i, f"Kafka, part {i} " + "y" * 90, 40 - 3 * i, i, DAY) for i in range(7)])
    events = stories.select("story_id", F.lit("Kafka").alias("keyword"), "score", "created_at", "iso_week")
    mentions = spark.createDataFrame(
        [("Kafka", WEEK, 7, 31.0, 3.0, 62.5), ("Zig", WEEK, 2, 9.0, 1.5, 12.5), ("Docker", WEEK, 4, 8.0, 2.0, 33.0), ("Kafka", "2023-W36", 1, 1.0, 1.0, None)],
        "keyword string, iso_week string, mention_count long, weighted_score double, avg_comments double, hype_score double",
    )
    velocity = spark.createDataFrame(
        [("Kafka", WEEK, 140.0, 26.0, 3.25, True, False), ("Zig", WEEK, -37.5, 20.0, -1.1, False, False), ("Docker", WEEK, 10.0, 30.0, 0.4, False, False)],
        "keyword string, iso_week string, velocity double, rolling_avg double, z_score double, is_trending boolean, is_crashing boolean",
    )
    return stories, events, mentions, velocity


def test_trending(data):
    _, _, mentions, velocity = data
    rows = reports.trending_keywords(velocity, mentions, WEEK).collect()
    assert [r.keyword for r in rows] == ["Kafka", "Docker", "Zig"] and rows[0].hype_score == 62.5
    by_scalar = reports.trending_keywords(velocity, mentions, reports.latest_week(mentions).scalar())
    assert by_scalar.collect() == rows


def test_trending_now_equals_the_join(spark):
    rows = [(k, f"2023-W{w:02d}", w, 1.0, 1.0, float((w * 7 + len(k)) % 90)) for k in ("Kafka", "Zig", "Go") for w in range(1, 20) if (w, k) != (19, "Go")]
    mentions = spark.createDataFrame(rows, "keyword string, iso_week string, mention_count long, weighted_score double, avg_comments double, hype_score double")
    joined = reports.trending_keywords(keyword_velocity(mentions), mentions, "2023-W19")
    now = reports.trending_now(mentions)
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert now.collect() == joined.collect() and now.count() == 2
    assert plan.count("Scan ExistingRDD") == 1 and "Join" not in plan


def test_category_filter(data):
    _, _, mentions, velocity = data
    trending = reports.trending_keywords(velocity, mentions, WEEK)
    assert reports.in_category(trending, DEFAULT, "All").count() == 3
    assert reports.in_category(trending, DEFAULT, "Languages").count() == 1
    assert reports.in_category(trending, DEFAULT, "Companies").count() == 0


def test_movers(data):
    _, _, mentions, velocity = data
    trending = reports.trending_keywords(velocity, mentions, WEEK)
    top = reports.risers(trending, 1).first()
    assert (top.keyword, top.score_text, top.change_text) == ("Kafka", "62.5", "+140.0% WoW")
    low = reports.fallers(trending, 1).first()
    assert (low.keyword, low.change_text) == ("Zig", "-37.5% WoW")


def test_anomaly_feed(data):
    stories, events, _, velocity = data
    feed = reports.anomaly_feed(velocity, events, stories, WEEK, limit=3)
    assert [r.story_id for r in feed.collect()] == [70, 71, 72]
    assert reports.anomaly_feed(velocity, events.drop("iso_week"), stories.drop("iso_week"), WEEK, 3).collect() == feed.collect()
    assert reports.anomaly_feed(velocity, events, stories, "2023-W36").count() == 0
    matched = stories.withColumn("keyword", F.lit("Kafka"))
    assert reports.anomalies_now(matched, velocity, 3).collect() == feed.collect()
    (best,) = reports.top_story_per_keyword(feed).collect()
    assert best.story_id == 70 and best.z_text == "3.25" and len(best.title) == 80
    assert best.link.endswith("id=70")


def test_no_broadcast_hints(data):
    stories, events, _, velocity = data
    plan = reports.anomaly_feed(velocity, events, stories, WEEK)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


def test_hype_cycle(data):
    _, _, mentions, _ = data
    rows = reports.hype_cycle(mentions, "Kafka", 12).collect()
    assert [(r.iso_week, r.hype_score) for r in rows] == [(WEEK, 62.5)]
    assert reports.hype_cycle(mentions, "Cobol").count() == 0


def test_latest_weeks_of_a_keyword(spark):
    rows = [(k, f"2024-W{w:02d}", float(w), w) for k in ("a", "b") for w in range(10, 30)]
    mentions = spark.createDataFrame(rows, "keyword string, iso_week string, hype_score double, mention_count long")
    assert [r.iso_week for r in reports.hype_cycle(mentions, "a", 2).collect()] == ["2024-W28", "2024-W29"]
    assert reports.hype_cycles(mentions, ["a", "b"], 3).count() == 6


def test_pivot_and_difference(spark):
    rows = [("a", "w1", 5.0, 1), ("b", "w1", 2.0, 1), ("a", "w2", 4.0, 1)]
    mentions = spark.createDataFrame(rows, "keyword string, iso_week string, hype_score double, mention_count long")
    pivot = reports.hype_pivot(mentions, ["a", "b"]).orderBy("iso_week").collect()
    assert [(r.iso_week, r.a, r.b) for r in pivot] == [("w1", 5.0, 2.0), ("w2", 4.0, None)]
    diff = reports.compare_keywords(mentions, "a", "b").orderBy("iso_week").collect()
    assert [r.difference for r in diff] == [3.0, None]


def test_names_with_dots_can_be_compared(spark):
    rows = [("Next.js", "w1", 5.0, 1), ("Fly.io", "w1", 2.0, 1)]
    mentions = spark.createDataFrame(rows, "keyword string, iso_week string, hype_score double, mention_count long")
    assert reports.compare_keywords(mentions, "Next.js", "Fly.io").first().difference == 3.0


def test_default_selection(spark):
    frame = spark.createDataFrame([(k,) for k in ("Go", "Zig", "Python", "Go")], "keyword string")
    assert [r.keyword for r in reports.default_selection(frame).orderBy("position").collect()] == ["Python", "Go"]
    other = spark.createDataFrame([(k,) for k in "fedcba"], "keyword string")
    assert [r.keyword for r in reports.default_selection(other, ["x", "y"]).orderBy("position").collect()] == list("abcd")
    assert [r.keyword for r in reports.default_selection(other, ["x"], 2).orderBy("position").collect()] == list("ab")
    assert [r.keyword for r in reports.default_selection(other).orderBy("position").collect()] == list("abcd")


def test_latest_week_and_metadata(data, spark):
    stories, _, mentions, _ = data
    assert reports.latest_week(mentions).first()[0] == WEEK
    fallback = reports.latest_week(mentions.limit(0), F.lit("2024-12-31").cast("date"))
    assert fallback.first()[0] == "2024-W53"
    meta = reports.load_metadata(stories.withColumn("fetched_at", F.col("created_at"))).first()
    assert meta.total_stories == 7 and meta.last_run is not None
    assert reports.load_metadata(stories.limit(0).withColumn("fetched_at", F.col("created_at"))).first().total_stories == 0


def test_top_trending_spans_all_weeks(data):
    assert [r.keyword for r in reports.top_trending(data[3]).collect()] == ["Kafka"]


def test_quality_gates(data, spark):
    stories, events, mentions, _ = data
    young = quality.freshness(stories, ntz("2023-09-13 05:45:00")).first()
    assert young.passed and young.observed == 23.5
    assert not quality.freshness(stories, ntz("2023-09-13 08:30:00")).first().passed
    assert quality.freshness(stories.limit(0), ntz("2023-09-13 08:30:00")).first().passed
    assert quality.has_events(events).first().passed
    assert not quality.has_events(events.limit(0)).first().passed
    assert not quality.new_stories(spark.range(0)).first().passed
    assert quality.unique_key(mentions, ["keyword", "iso_week"], "m").first().passed
    repeated = quality.unique_key(mentions, ["keyword"], "m")
    assert repeated.first().observed == 1.0
    quality.raise_on_failure(quality.has_events(events))
    with pytest.raises(quality.QualityError, match="unique_m"):
        quality.raise_on_failure(repeated)
