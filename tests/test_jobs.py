import json

import pytest
from pyspark.sql import functions as F

from risewatch.operators import reports
from risewatch.operators.quality import QualityError
from risewatch.plans.jobs import affected_weeks, detect_new, discover, rebuild, recent_weeks, refresh, rescore, scored_tables
from risewatch.plans.views import emerging_view, hype_cycle_view, trending_view
from risewatch.sources.tables import Tables
from risewatch.streaming.ingest import page_stream, start_stream
from risewatch.taxonomy import DEFAULT

TITLES = ["Rust at sea", "Go, slowly", "Docker beside Rust", "A fern", "Python; python", "Go go to"]


def feed(n, first=0):
    """Stories spread over 20 weeks, busier for Rust towards the end."""
    rows = []
    for i in range(first, first + n):
        day = i % 140
        title = "Rust again" if day > 120 and i % 3 else TITLES[i % len(TITLES)]
        rows.append((i, title, i % 50, i % 7, f"2024-{1 + day // 28:02d}-{1 + day % 28:02d} 10:00:00"))
    return rows


def content(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_rebuild_equals_the_lazy_tables(tables, make_stories):
    tables.insert_stories(make_stories(feed(700)))
    counts = rebuild(tables, DEFAULT)
    lazy = scored_tables(tables.read("raw_stories"), DEFAULT)
    for name, df in lazy.items():
        assert counts[name] == df.count() > 0
        assert content(tables.read(name)) == content(df)
    # a second run replaces and does not add
    assert rebuild(tables, DEFAULT) == counts
    assert tables.row_count("keyword_events") == counts["keyword_events"]


def test_refresh_equals_rebuild(spark, tables, make_stories, tmp_path):
    rows = feed(700)
    late = "2024-05-16"
    stories = make_stories(rows)
    tables.insert_stories(stories.filter(F.col("created_at") < late))
    rebuild(tables, DEFAULT)
    checks = refresh(tables, stories, "2024-05-28 12:00:00", DEFAULT, raise_failures=False)
    assert [r.passed for r in checks.orderBy("check_name").collect()] == [True, True, True]
    whole = Tables(spark, str(tmp_path / "whole"))
    whole.insert_stories(stories)
    rebuild(whole, DEFAULT)
    weeks = [r.iso_week for r in recent_weeks(spark, "2024-05-28").collect()]
    for name in ("weekly_mentions", "keyword_velocity"):
        old = whole.read(name).filter(F.col("iso_week") < "2024-W19")
        assert content(tables.read(name).filter(F.col("iso_week") < "2024-W19")) == content(old)
        recent = F.col("iso_week").isin(weeks)
        assert content(tables.read(name).filter(recent)) == content(whole.read(name).filter(recent))
    assert content(tables.read("keyword_events")) == content(whole.read("keyword_events"))


def test_refresh_fails_without_new_stories(tables, make_stories):
    tables.insert_stories(make_stories(feed(50)))
    with pytest.raises(QualityError, match="new_stories"):
        refresh(tables, make_stories(feed(50)), "2024-03-01", DEFAULT)


def test_refresh_ignores_stories_older_than_the_mark(tables, make_stories):
    tables.insert_stories(make_stories([(1, "Rust", 1, 1, "2024-03-01")]))
    old = make_stories([(2, "Rust", 1, 1, "2024-02-01"), (3, "Go", 1, 1, "2024-03-02")])
    refresh(tables, old, "2024-03-02", DEFAULT)
    assert sorted(r.story_id for r in tables.read("raw_stories").collect()) == [1, 3]
    refresh(tables, old, "2024-03-02", DEFAULT, newer_only=False)
    assert tables.row_count("raw_stories") == 3


def test_detection_is_incremental(tables, make_stories):
    tables.insert_stories(make_stories([(1, "Rust", 1, 1, "2024-03-01"), (2, "cat", 1, 1, "2024-03-01")]))
    assert detect_new(tables) == {"stories_processed": 2, "hits_written": 1}
    assert detect_new(tables) == {"stories_processed": 1, "hits_written": 0}
    tables.insert_stories(make_stories([(3, "Go and Rust", 1, 1, "2024-03-09")]))
    assert detect_new(tables, weeks=["2024-W08"])["hits_written"] == 0
    assert detect_new(tables) == {"stories_processed": 2, "hits_written": 2}


def test_refresh_looks_at_its_own_load_unless_the_taxonomy_is_new(tables, make_stories):
    tables.insert_stories(make_stories([(1, "Rust", 1, 1, "2024-03-01"), (2, "Docker", 1, 1, None)]))
    refresh(tables, make_stories([(3, "Go!", 1, 1, "2024-03-02")]), "2024-03-02")
    assert {r.keyword for r in tables.read("keyword_events").collect()} == {"Go"}
    refresh(tables, make_stories([(4, "Kafka", 1, 1, "2024-03-03")]), "2024-03-03", new_taxonomy=True)
    assert {r.keyword for r in tables.read("keyword_events").collect()} == {"Go", "Kafka", "Rust", "Docker"}


def test_only_weeks_with_changed_history_are_flagged_again(spark):
    rows = [("a", f"2023-W{w:02d}", 1.0) for w in range(1, 41)] + [("b", "2023-W05", 1.0), ("b", "2023-W39", 1.0), ("b", "2023-W40", None)]
    mentions = spark.createDataFrame(rows, "keyword string, iso_week string, hype_score double")
    assert affected_weeks(mentions, ["2023-W05"]) == [f"2023-W{w:02d}" for w in [*range(5, 18), 39]]


def test_rescore_keeps_vanished_rows_and_other_weeks(spark, tables, make_stories):
    tables.insert_stories(make_stories([(1, "Rust", 5, 1, "2024-03-01"), (2, "Go", 3, 1, "2024-03-09")]))
    detect_new(tables)
    stored = spark.createDataFrame(
        [("Zig", 4, 1.0, 1.0, 12.5, "2024-W09"), ("Zig", 4, 1.0, 1.0, 99.0, "2024-W01")],
        "keyword string, mention_count long, weighted_score double, avg_comments double, hype_score double, iso_week string",
    )
    tables.append("weekly_mentions", stored)
    rescore(tables, ["2024-W09"])
    rows = {(r.keyword, r.iso_week): r.hype_score for r in tables.read("weekly_mentions").collect()}
    assert rows[("Zig", "2024-W01")] == 99.0
    assert ("Zig", "2024-W09") in rows and ("Rust", "2024-W09") in rows and ("Go", "2024-W10") not in rows
    assert {r.iso_week for r in tables.read("keyword_velocity").collect()} == {"2024-W09"}


def test_recent_weeks(spark):
    assert sorted(r[0] for r in recent_weeks(spark, "2024-01-03").collect()) == ["2023-W52", "2024-W01"]


def test_views(spark, tables, make_stories):
    tables.insert_stories(make_stories(feed(700)))
    rebuild(tables, DEFAULT)
    assert discover(tables, DEFAULT) > 0
    assert discover(tables, DEFAULT) == 0
    week = reports.latest_week(tables.read("weekly_mentions")).scalar()
    view = trending_view(tables, week)
    trending = view["trending"].collect()
    assert trending and view["risers"].first().keyword == trending[0].keyword
    assert trending_view(tables, week, "Tools")["trending"].count() < len(trending)
    history = hype_cycle_view(tables, ["Rust", "Go"], 4)
    # each keyword's own latest four weeks, side by side
    assert 4 <= history["history"].count() <= 8
    assert history["difference"].count() == history["history"].count()
    terms = emerging_view(tables, "2024-W03").collect()
    assert terms == sorted(terms, key=lambda r: (-r.tfidf_score, r.term))


def page_file(path, rows):
    hits = [
        {"objectID": str(i), "title": t, "points": s, "num_comments": c, "created_at": d.replace(" ", "T") + ".000Z"}
        for i, t, s, c, d in rows
    ]
    path.write_text(json.dumps({"hits": hits, "nbPages": 1, "nbHits": len(hits)}))


def test_stream_equals_batch(spark, tmp_path, make_stories):
    rows, landed = feed(300), tmp_path / "landed"
    landed.mkdir()
    tables, checkpoint = Tables(spark, str(tmp_path / "tables")), str(tmp_path / "checkpoint")

    def run():
        start_stream(page_stream(spark, str(landed), max_files=2), tables, checkpoint).awaitTermination()

    # overlapping pages, and the oldest stories come last
    page_file(landed / "1.json", rows[100:220])
    page_file(landed / "2.json", rows[150:300])
    page_file(landed / "3.json", rows[200:260])
    run()
    assert tables.row_count("raw_stories") == 200
    page_file(landed / "4.json", rows[0:120])
    run()
    run()  # nothing landed
    batch = Tables(spark, str(tmp_path / "batch"))
    batch.insert_stories(make_stories(rows))
    rebuild(batch, DEFAULT)
    for name in ("keyword_events", "weekly_mentions", "keyword_velocity"):
        assert content(tables.read(name)) == content(batch.read(name)), name


def test_what_a_stream_cannot_store_is_kept_with_a_reason(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    page_file(landed / "1.json", feed(5))
    (landed / "2.json").write_text((landed / "1.json").read_text()[:-20])
    (landed / "3.json").write_text(json.dumps({"hits": ["x", {"objectID": "9", "title": "t", "points": 1.5}]}))
    tables = Tables(spark, str(tmp_path / "tables"))
    assert tables.rejects().count() == 0
    start_stream(page_stream(spark, str(landed)), tables, str(tmp_path / "checkpoint")).awaitTermination()
    assert tables.row_count("raw_stories") == 5
    reasons = {(r.arrival.file[-6:], r.reason) for r in tables.rejects().collect()}
    assert reasons == {("2.json", "unreadable page"), ("3.json", "hit is not an object"), ("3.json", "unreadable points")}


def test_a_replayed_batch_changes_nothing(spark, tmp_path, make_stories):
    from risewatch.streaming.ingest import load_batch

    tables, stories = Tables(spark, str(tmp_path / "t")), make_stories(feed(120))
    load_batch(tables, stories)
    before = {n: content(tables.read(n)) for n in ("keyword_events", "weekly_mentions", "keyword_velocity")}
    load_batch(tables, stories)
    assert {n: content(tables.read(n)) for n in before} == before
    assert tables.row_count("raw_stories") == 120


def test_undated_stories_are_detected_in_a_stream_too(spark, tmp_path, make_stories):
    from risewatch.streaming.ingest import load_batch

    tables = Tables(spark, str(tmp_path / "t"))
    load_batch(tables, make_stories([(1, "Rust", 1, 1, None), (2, "Go!", 1, 1, "2024-03-01")]))
    assert {r.keyword for r in tables.read("keyword_events").collect()} == {"Rust", "Go"}
    assert {r.keyword for r in tables.read("weekly_mentions").collect()} == {"Go"}


def test_events_are_written_where_their_stories_are_read(spark, tables, make_stories, monkeypatch):
    asked, frame = [], type(spark.range(1))
    monkeypatch.setattr(frame, "hint", lambda self, *given, real=frame.hint: asked.append(given) or real(self, *given))
    for first in range(0, 700, 350):
        tables.insert_stories(make_stories(feed(350, first)))
    assert ("rebalance", "iso_week") in asked and not tables.in_pieces("raw_stories")
    asked.clear()
    rebuild(tables, DEFAULT)
    assert asked == [("rebalance", "iso_year")] * 2
    found = content(tables.read("keyword_events"))
    assert found == content(scored_tables(tables.read("raw_stories"), DEFAULT)["keyword_events"])
    # stories in many small files: their events are gathered
    for first in range(700, 706):
        tables.append("raw_stories", make_stories(feed(1, first) * 3).repartition(3).withColumn("fetched_at", F.col("created_at")))
    assert not tables.in_pieces("raw_stories")
    monkeypatch.setattr("risewatch.sources.tables.FILES_A_FOLDER", 0.5)
    assert tables.in_pieces("raw_stories")
    asked.clear()
    rebuild(tables, DEFAULT)
    assert asked == [("rebalance", "iso_week"), *[("rebalance", "iso_year")] * 2]
    assert len(tables.read("keyword_events").inputFiles()) <= 2 * len({r.iso_week for r in tables.read("raw_stories").collect()})
