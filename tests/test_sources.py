import datetime
import json

import pytest
from pyspark.sql import functions as F

from risewatch.functions.time import ntz
from risewatch.operators.keyed import first_per_key, merge_replace, not_yet_stored
from risewatch.schemas import TABLES
from risewatch.sources.pages import (
    high_water_mark,
    in_time_range,
    parse_hits,
    parse_pages,
    read_pages,
    rejected_hits,
    total_hits,
)
from risewatch.sources.tables import Tables
from risewatch.sources.windows import coverage_audit, page_audit, window_plan


def hit(number, **fields):
    """A hit as the search returns it, with some fields changed."""
    given = {"objectID": number, "title": f"Story {number}", "points": 31, "num_comments": 4}
    return given | {"created_at": "2023-11-07T08:30:00.000Z", "url": "https://example.net/s"} | fields


def pages_of(spark, *pages):
    return parse_pages(spark.createDataFrame([(json.dumps(p),) for p in pages], "value string"))


def test_valid_hit(spark):
    (story,) = parse_hits(pages_of(spark, {"hits": [hit("801")], "nbPages": 1})).collect()
    assert (story.story_id, story.score, story.num_comments) == (801, 31, 4)
    assert story.created_at == datetime.datetime(2023, 11, 7, 8, 30) and story.iso_week == "2023-W45"


def test_invalid_hits_are_dropped_with_a_reason(spark):
    cases = [
        (hit("1", title=None), "missing title"),
        (hit("2", title=""), "missing title"),
        (hit(None), "missing id"),
        (hit(""), "missing id"),
        (hit("abc"), "id is not an integer"),
        (hit("4.0"), "id is not an integer"),
        (hit("1e3"), "id is not an integer"),
        (hit("9" * 30), "id is not an integer"),
        (hit("3", points=3.5), "unreadable points"),
        (hit("4", points=3_000_000_000), "unreadable points"),
        (hit("5", num_comments="many"), "unreadable comments"),
        ("stray", "hit is not an object"),
        (None, "hit is not an object"),
        ([hit("6")], "hit is not an object"),
    ]
    pages = pages_of(spark, {"hits": [*(c for c, _ in cases), hit(" +7 ", points="12"), hit(8)], "nbPages": 1})
    assert sorted((r.story_id, r.score) for r in parse_hits(pages).collect()) == [(7, 12), (8, 31)]
    rejected = rejected_hits(pages).orderBy("arrival").collect()
    assert [r.reason for r in rejected] == [reason for _, reason in cases]
    assert [r.arrival.position for r in rejected] == list(range(len(cases)))


def test_pages_that_cannot_be_read_are_rejected(spark, tmp_path):
    whole = json.dumps({"hits": [hit("1"), hit("2")], "page": 0, "nbHits": 2})
    (tmp_path / "a.json").write_text(whole)
    (tmp_path / "b.json").write_text(whole[:-30])
    (tmp_path / "c.json").write_text(json.dumps({"hits": [17, hit("3")], "page": "x", "nbHits": None}))
    pages = read_pages(spark, str(tmp_path))
    assert sorted(r.story_id for r in parse_hits(pages).collect()) == [1, 2, 3]
    rejected = {r.arrival.file[-6:]: r.reason for r in rejected_hits(pages).collect()}
    assert rejected == {"b.json": "unreadable page", "c.json": "hit is not an object"}
    texts = spark.createDataFrame([(whole,), (whole[:-1],), ("[1]",), (None,), ("",)], "value string")
    assert rejected_hits(parse_pages(texts)).count() == 4 and parse_hits(parse_pages(texts)).count() == 2


def test_offsets_are_brought_to_utc(spark):
    times = ["2024-03-01T10:00:00+02:00", "2024-03-01T10:00:00-0530", "2024-03-01T10:00:00Z", "2024-03-01 10:00:00.25", "soon", None]
    pages = pages_of(spark, {"hits": [hit(i + 1, created_at=t) for i, t in enumerate(times)]})
    got = [r.created_at for r in parse_hits(pages).orderBy("story_id").collect()]
    at = datetime.datetime(2024, 3, 1, 10)
    hours = datetime.timedelta(hours=1)
    assert got == [at - 2 * hours, at + 5.5 * hours, at, at + datetime.timedelta(milliseconds=250), None, None]


def test_first_copy_of_an_id_is_stored(spark, tables):
    first = {"hits": [hit("1", points=90), hit("1", points=5), hit("2", points=1)], "page": 0}
    later = {"hits": [hit("2", points=70), hit("3", points=4), hit("3", points=3)], "page": 1}
    assert tables.insert_stories(parse_hits(pages_of(spark, later, first))) == 3
    assert {r.story_id: r.score for r in tables.read("raw_stories").collect()} == {1: 90, 2: 1, 3: 4}


def test_missing_counts_are_zero(spark):
    (story,) = parse_hits(pages_of(spark, {"hits": [hit("1", points=None, num_comments=None)]})).collect()
    assert (story.score, story.num_comments) == (0, 0)


@pytest.mark.parametrize("multi_line", [True, False])
def test_pages_from_files(spark, tmp_path, multi_line):
    indent = 2 if multi_line else None
    for n in range(2):
        page = {"hits": [hit(str(n))], "nbPages": 2, "nbHits": 2, "page": n}
        (tmp_path / f"{n}.json").write_text(json.dumps(page, indent=indent))
    (tmp_path / "2.json").write_text(json.dumps({"hits": [], "nbPages": 5, "page": 2}))
    pages = read_pages(spark, str(tmp_path), multi_line)
    assert sorted(r.story_id for r in parse_hits(pages).collect()) == [0, 1]
    assert total_hits(pages).first().nb_hits == 2


def test_total_hits_falls_back_to_the_first_page(spark):
    assert total_hits(pages_of(spark, {"hits": [hit("1"), hit("x")], "nbPages": 1})).first().nb_hits == 2


def test_totals_of_fetches_do_not_mix(spark):
    pages = pages_of(spark, {"hits": [], "nbHits": 10, "page": 0}, {"hits": [], "nbHits": 20}, {"hits": [], "nbHits": 99, "page": 1})
    fetches = pages.withColumn("fetch", F.when(F.col("nbHits") == 10, "a").otherwise("b"))
    assert {r.fetch: r.nb_hits for r in total_hits(fetches, "fetch").collect()} == {"a": 10, "b": 20}


def test_time_range_is_open_at_both_ends(spark, make_stories):
    stories = make_stories([(i, "t", 1, 1, f"2024-01-15 10:00:0{i}") for i in range(5)])
    base = 1705312800
    assert [r.story_id for r in in_time_range(stories, base, base + 3).collect()] == [1, 2]
    assert [r.story_id for r in in_time_range(stories, base, base + 3, "left").collect()] == [0, 1, 2]
    assert [r.story_id for r in in_time_range(stories, base + 3).collect()] == [4]
    with pytest.raises(ValueError):
        in_time_range(stories, base, closed="right")


def test_high_water_mark(spark, make_stories):
    stories = make_stories([(1, "a", 1, 1, "2024-06-15 00:00:00"), (2, "b", 1, 1, "2024-06-20 10:00:00")])
    assert high_water_mark(stories).first().since_ts == 1718877600
    assert high_water_mark(stories.limit(0)).first().since_ts == 0


def test_window_plan_covers_two_years(spark):
    plan = window_plan(spark=spark, as_of="2024-06-20 10:00:00").orderBy("bucket").collect()
    assert len(plan) == 1460 and plan[0].window_start == datetime.datetime(2022, 6, 21, 10)
    assert all(a.window_end == b.window_start for a, b in zip(plan, plan[1:]))


def test_window_plan_clips_the_end(spark):
    bounds = spark.range(1).select(
        ntz("2024-01-01 00:00:00").alias("range_start"), ntz("2024-01-01 13:00:00").alias("range_end")
    )
    rows = window_plan(bounds).collect()
    assert [(r.window_end - r.window_start).seconds // 3600 for r in rows] == [12, 1]


def test_coverage_audit_flags(spark, make_stories):
    start, end = "2024-01-01 00:00:00", "2024-01-02 12:00:00"
    bounds = spark.range(1).select(ntz(start).alias("range_start"), ntz(end).alias("range_end"))
    stories = make_stories([(i, "t", 1, 1, "2024-01-01 03:00:00") for i in range(4)] + [(9, "t", 1, 1, "2024-01-02 00:00:00")])
    audit = coverage_audit(stories, window_plan(bounds), ntz(start), cap=4).orderBy("bucket").collect()
    assert [(r.n_stories, r.maybe_truncated, r.is_empty) for r in audit] == [(4, True, False), (0, False, True), (1, False, False)]


def test_coverage_audit_counts_the_end_of_the_range(spark, make_stories):
    start, end = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    bounds = spark.range(1).select(ntz(start).alias("range_start"), ntz(end).alias("range_end"))
    stories = make_stories([(i, "t", 1, 1, t) for i, t in enumerate(("2024-01-01 01:00:00", "2024-01-01 12:00:00", end, "2024-01-02 00:00:01"))])
    audit = coverage_audit(stories, window_plan(bounds), ntz(start)).orderBy("bucket").collect()
    assert [r.n_stories for r in audit] == [1, 2]


def test_page_audit_reads_reported_totals(spark):
    pages = pages_of(spark, {"hits": [hit("1")], "nbHits": 1000, "page": 0}, {"hits": [], "nbHits": 7, "page": 1})
    (row,) = page_audit(pages.withColumn("window", F.lit("w")), "window").collect()
    assert (row.n_stories, row.maybe_truncated) == (1000, True)


def test_first_per_key_takes_the_first(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c")], "k int, o int, v string")
    assert sorted((r.k, r.v) for r in first_per_key(df, ["k"], ["o"]).collect()) == [(1, "a"), (2, "c")]


def test_first_per_key_limits_each_task_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2)], "k int, o int")
    plan = first_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    shuffled = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in shuffled and "Partial" in shuffled


def test_not_yet_stored(spark):
    new = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert sorted(r.k for r in not_yet_stored(new, new.filter("k < 3"), ["k"]).collect()) == [3]
    assert not_yet_stored(new, new.limit(0), ["k"]).count() == 3


def test_merge_replace_keeps_rows_and_columns(spark):
    stored = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0)], "k string, v int, kept double")
    new = spark.createDataFrame([("b", None), ("c", 30)], "k string, v int")
    got = sorted(map(tuple, merge_replace(new, stored, ["k"], ["kept"]).select("k", "v", "kept").collect()))
    assert got == [("a", 1, 1.0), ("b", None, 2.0), ("c", 30, None)]


# --- stored tables -----------------------------------------------------------


def test_tables_are_created_empty_and_typed(tables):
    tables.create_missing()
    for name, (schema, _) in TABLES.items():
        df = tables.read(name)
        assert df.count() == 0
        assert {(f.name, f.dataType) for f in df.schema} == {(f.name, f.dataType) for f in schema}


def test_a_table_that_does_not_exist_is_empty(spark, tmp_path):
    reader = Tables(spark, str(tmp_path / "nowhere"), create=False)
    assert reader.read("emerging_terms").collect() == []
    assert not (tmp_path / "nowhere").exists()


def story(i, day=15, score=1):
    return (i, f"story {i}", score, 1, f"2024-01-{day} 10:00:00")


def test_insert_ignores_known_ids(tables, make_stories):
    assert tables.insert_stories(make_stories([story(1), story(2), story(3)])) == 3
    assert tables.insert_stories(make_stories([story(1, score=99), story(4)])) == 1
    rows = {r.story_id: r for r in tables.read("raw_stories").collect()}
    assert set(rows) == {1, 2, 3, 4} and rows[1].score == 1
    assert all(r.fetched_at is not None for r in rows.values())
    assert tables.row_count("raw_stories") == 4


def test_first_of_a_batch_wins(tables, make_stories):
    batch = make_stories([story(1, day=16, score=5), story(1, day=15, score=6)])
    assert tables.insert_stories(batch) == 1
    assert tables.read("raw_stories").first().score == 6


def test_insert_nothing_and_null_counts(tables, make_stories):
    assert tables.insert_stories(make_stories([story(1)]).limit(0)) == 0
    tables.insert_stories(make_stories([(1, "t", None, None, "2024-01-15")]))
    row = tables.read("raw_stories").first()
    assert (row.score, row.num_comments) == (0, 0)
    assert tables.insert_stories(make_stories([story(1)])) == 0


def test_insert_terms_keeps_old_scores(spark, tables):
    schema = "term string, iso_week string, tfidf_score double"
    week = "2024-W01"
    assert tables.insert_terms(spark.createDataFrame([("a", week, 1.0), ("b", week, 2.0)], schema)) == 2
    assert tables.insert_terms(spark.createDataFrame([("a", week, 9.0), ("c", week, 3.0)], schema)) == 1
    assert {r.term: r.tfidf_score for r in tables.read("emerging_terms").collect()} == {"a": 1.0, "b": 2.0, "c": 3.0}


def mentions_of(spark, *weeks):
    rows = [("k", 1, 1.0, 1.0, float(n), w) for n, w in enumerate(weeks)]
    return spark.createDataFrame(rows, "keyword string, mention_count long, weighted_score double, avg_comments double, hype_score double, iso_week string")


def test_replacing_weeks_leaves_the_others(spark, tables):
    tables.append("weekly_mentions", mentions_of(spark, "2023-W50", "2024-W01", "2024-W02"))
    stored = tables.read("weekly_mentions")
    changed = stored.filter("iso_week = '2024-W01'").withColumn("hype_score", F.lit(7.0))
    assert tables.replace_weeks("weekly_mentions", changed, ["2024-W01"]) == 1
    rows = {r.iso_week: r.hype_score for r in tables.read("weekly_mentions").collect()}
    assert rows == {"2023-W50": 0.0, "2024-W01": 7.0, "2024-W02": 2.0}
    assert tables.replace_weeks("weekly_mentions", changed.limit(0), ["2024-W01"]) == 0
    assert tables.row_count("weekly_mentions") == 2 and len(tables.versions("weekly_mentions")) == 2


def test_a_replacement_leaves_the_files_of_other_years(spark, tables, tmp_path):
    root = tmp_path / "tables/weekly_mentions"
    files = lambda: {str(x.relative_to(root)) for x in root.rglob("*.parquet")}
    tables.append("weekly_mentions", mentions_of(spark, "2022-W10", "2023-W50", "2024-W01", None))
    before = {x for x in files() if "iso_year=2024" not in x}
    for n in range(4):
        assert tables.replace_weeks("weekly_mentions", mentions_of(spark, "2024-W01", "2024-W02"), ["2024-W01", "2024-W02"]) == 2
        assert before <= files()
        assert {x.split("/")[1] for x in files() - before} == {"iso_year=2024"}
    rows = sorted((r.iso_week or "") for r in tables.read("weekly_mentions").collect())
    assert rows == ["", "2022-W10", "2023-W50", "2024-W01", "2024-W02"]
    assert [r.iso_week for r in tables.read("weekly_mentions", weeks=["2023-W50"]).collect()] == ["2023-W50"]
    assert tables.versions("weekly_mentions") == [4, 5]
    # a year that loses all its rows, an older year, rows of weeks that are not replaced, and an append
    assert tables.replace_weeks("weekly_mentions", mentions_of(spark).limit(0), ["2024-W01", "2024-W02"]) == 0
    assert tables.replace_weeks("weekly_mentions", mentions_of(spark, "2022-W11", "2023-W01"), ["2022-W11"]) == 1
    assert sorted((r.iso_week or "") for r in tables.read("weekly_mentions").collect()) == ["", "2022-W10", "2022-W11", "2023-W50"]
    assert tables.read("weekly_mentions", weeks=["2024-W01"]).count() == 0
    emptied = ["2022-W10", "2022-W11", "2023-W50"]
    assert tables.read("weekly_mentions", weeks=["2023-W01", "2024-W01"]).count() == 0
    assert tables.append("weekly_mentions", mentions_of(spark, "2025-W01")) == 1
    assert tables.row_count("weekly_mentions") == 5
    assert tables.replace_weeks("weekly_mentions", mentions_of(spark).limit(0), emptied) == 0
    assert [r.iso_week for r in tables.read("weekly_mentions").collect() if r.iso_week] == ["2025-W01"]
    assert tables.read("weekly_mentions", weeks=["2022-W10", "2023-W50"]).count() == 0
    assert tables.overwrite("weekly_mentions", mentions_of(spark, "2021-W01")) == 1 and tables.row_count("weekly_mentions") == 1


def test_a_replacement_that_dies_loses_nothing(spark, tables, tmp_path):
    tables.append("weekly_mentions", mentions_of(spark, "2023-W50", "2024-W01"))
    before = sorted(map(tuple, tables.read("weekly_mentions").collect()))
    broken = tables.read("weekly_mentions").withColumn("hype_score", F.raise_error(F.lit("died")).cast("double"))
    with pytest.raises(Exception, match="died"):
        tables.replace_weeks("weekly_mentions", broken, ["2024-W01"])
    # a job that wrote its files and died before its mark
    tables.replace_weeks("weekly_mentions", mentions_of(spark, "2024-W01"), ["2024-W01"])
    (tmp_path / "tables/weekly_mentions/v000002/_SUCCESS").unlink()
    assert sorted(map(tuple, tables.read("weekly_mentions").collect())) == before
    assert tables.replace_weeks("weekly_mentions", mentions_of(spark, "2024-W01"), ["2024-W01"]) == 1
    assert tables.row_count("weekly_mentions") == 2


def test_a_failure_to_count_is_no_zero(spark, tables, monkeypatch):
    import risewatch.sources.tables as module

    class Broken(module.Observation):
        @property
        def get(self):
            spark._jvm.java.lang.Integer.parseInt("no number")

    monkeypatch.setattr(module, "Observation", Broken)
    with pytest.raises(Exception, match="no number"):
        tables.append("weekly_mentions", mentions_of(spark, "2024-W01"))


@pytest.mark.parametrize("name", sorted(TABLES))
def test_week_filter_prunes_every_table(tables, name):
    plan = tables.read(name, weeks=["2024-W03"])._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].splitlines()[0]
    assert "iso_week" in filters or "iso_year" in filters


def test_week_filter_keeps_the_rows_of_the_week(tables, make_stories):
    tables.insert_stories(make_stories([story(1, 15), story(2, 25)]))
    assert [r.story_id for r in tables.read("raw_stories", weeks=["2024-W03"]).collect()] == [1]


def test_each_text_is_parsed_once(spark):
    """No column and no filter has its own copy of the parsing."""
    texts = spark.range(2).selectExpr("""concat('{"page": 0, "hits": [{"objectID": "', id, '", "title": "a"}]}') AS value""")
    for rows in (parse_hits(parse_pages(texts)), rejected_hits(parse_pages(texts).drop("unreadable"))):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 2  # the page, the hit
    assert sorted(r.story_id for r in parse_hits(parse_pages(texts)).collect()) == [0, 1]


def test_a_first_load_is_not_bound_to_the_buckets_of_ids(spark, tables, make_stories, monkeypatch):
    dealt, added = [], []
    monkeypatch.setattr(tables.ids, "dealt", lambda rows, real=tables.ids.dealt: dealt.append(rows.columns) or real(rows))
    monkeypatch.setattr(tables.ids, "append", lambda ids, real=tables.ids.append: added.append(ids.inputFiles()) or real(ids))
    day = "2024-01-02 10:00:00"
    assert tables.insert_stories(make_stories([(1, "a", 1, 1, day), (1, "b", 1, 1, day), (2, "c", 1, 1, day)]), ["title"]) == 2
    assert all(columns == ["story_id"] for columns in dealt)
    assert all("raw_stories" in path for paths in added for path in paths) and added[-1]
    # the next one is dealt as the ids are, and finds them
    dealt.clear()
    assert tables.insert_stories(make_stories([(2, "d", 1, 1, day), (3, "e", 1, 1, day)]), ["title"]) == 1
    assert any("title" in columns for columns in dealt)
    assert sorted((r.story_id, r.title) for r in tables.read("raw_stories").collect()) == [(1, "a"), (2, "c"), (3, "e")]
    assert sorted(r.story_id for r in tables.ids.read().collect()) == [1, 2, 3]


def test_ids_of_a_first_load_are_shuffled_once(spark, tables, make_stories, monkeypatch):
    plans = []

    def dealt(rows, real=tables.ids.dealt):
        out = real(rows)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    day = "2024-01-02 10:00:00"
    monkeypatch.setattr(tables.ids, "dealt", dealt)
    assert tables.insert_stories(make_stories([(1, "a", 1, 1, day), (1, "b", 1, 1, day), (None, "c", 1, 1, day)]), ["title"]) == 2
    assert plans[-1].count("Exchange") == 1 and "Aggregate" not in plans[-1]
    # copies in a later load leave one id
    assert tables.insert_stories(make_stories([(2, "d", 1, 1, day), (2, "e", 1, 1, day), (1, "f", 1, 1, day)]), ["title"]) == 1
    assert sorted(r.story_id for r in tables.ids.read().collect()) == [1, 2]
