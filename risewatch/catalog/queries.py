"""Named queries: ``(spark, sf_dir) -> DataFrame`` over the whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from risewatch.catalog.feeds import (
    EVENT_TAXONOMY,
    PAGE_TAXONOMY,
    PART_TAXONOMY,
    STOP_WORDS,
    TREND_ORDER,
    default_titles,
    event_pages,
    link_feed,
    scratch,
    table,
    trend_feed,
    trend_stories,
)
from risewatch.functions.numbers import round_stable
from risewatch.functions.text import match_text, term_tokens, url_text, with_bigrams
from risewatch.functions.time import ntz, week_label
from risewatch.operators import quality, reports
from risewatch.operators.detect import (
    detect_keywords,
    keyword_events,
    matched_by_word_join,
    matched_stories,
    name_table,
    unprocessed,
    with_category,
)
from risewatch.operators.emerging import (
    emerging_terms,
    inverse_frequency,
    term_counts,
    terms_by_document,
    tfidf_scores,
    top_terms,
)
from risewatch.operators.keyed import first_per_key, merge_replace, not_yet_stored
from risewatch.operators.rollup import (
    available_keywords,
    distinct_weeks,
    rollup_mentions,
    weekly_mentions,
)
from risewatch.operators.score import hype_scores, minmax
from risewatch.operators.velocity import keyword_velocity, rolling_stats
from risewatch.plans.jobs import (
    detection_totals,
    discover,
    rebuild,
    recent_weeks_of,
    refresh,
    scored_tables,
)
from risewatch.plans.views import emerging_view, hype_cycle_view, trending_view
from risewatch.schemas import TABLES
from risewatch.sources.pages import (
    high_water_mark,
    in_time_range,
    parse_hits,
    parse_pages,
    rejected_hits,
    total_hits,
)
from risewatch.sources.tables import Tables
from risewatch.sources.windows import coverage_audit, page_audit, window_plan
from risewatch.streaming.ingest import page_stream, start_distinct_stream, start_mentions, start_stream
from risewatch.taxonomy import DEFAULT, Taxonomy

STORED_BEFORE = "1997-06-01"
REFRESH_FROM = "2001-11-26"
REFRESH_AS_OF = "2001-12-05"
AUDIT_CAP = 170
NOUNS = Taxonomy({"Noun": PART_TAXONOMY.categories["Noun"]})
FEW_NAMES = Taxonomy({"Some": ["blue", "ring", "large", "gizmo", "old"]})
STORY_COLUMNS = ["story_id", "title", "url", "score", "num_comments", "created_at", "iso_week"]
STREAM_FILES = 8


def _scored(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return scored_tables(trend_stories(spark, sf), PART_TAXONOMY)


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf)["weekly_mentions"]


def _velocity(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf)["keyword_velocity"]


# --- sources -----------------------------------------------------------------


def q_week_label(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", week_label("o_orderdate").alias("iso_week"))


def _page_texts(spark, sf):
    packed = event_pages(spark, sf).select(
        "page", "day", F.to_json(F.struct("hits", "page", "nbPages", "nbHits")).alias("value")
    )
    # every 4th page from the 2nd on carries things that are no hits
    stray = F.regexp_replace("value", r'"hits":\[', '"hits":["stray",17,null,')
    return packed.withColumn("value", F.when(F.col("page") % 4 == 1, stray).otherwise(F.col("value")))


def _json_pages(spark, sf):
    """All pages, and some of them once more, cut off."""
    texts = _page_texts(spark, sf)
    cut = texts.filter("page % 10 = 3").withColumn("value", F.expr("substring(value, 1, length(value) - 9)"))
    return parse_pages(texts.unionByName(cut))


def q_parse_hits(spark, sf):
    return parse_hits(_json_pages(spark, sf)).select(*STORY_COLUMNS)


def q_rejected_hits(spark, sf):
    rejected = rejected_hits(_json_pages(spark, sf))
    return rejected.groupBy("reason").agg(F.count("*").alias("n_hits"))


def q_total_hits(spark, sf):
    return total_hits(_json_pages(spark, sf))


def q_total_hits_by_window(spark, sf):
    # a fetch per day: its first page reports that day's hits, a later one something else
    of_day = event_pages(spark, sf).groupBy("day").agg(F.sum(F.size("hits")).alias("n"))
    pages = of_day.withColumn("page", F.explode(F.array(F.lit(0), F.lit(1))))
    reported = pages.select("day", "page", (F.col("n") + F.col("page") * 1_000_000).alias("nbHits"), F.array().alias("hits"))
    return total_hits(reported, "day")


def q_insert_first_copy(spark, sf):
    """Every hit three times on its page, the second with other points: the first is stored."""
    again = F.transform("hits", lambda h: h.withField("points", F.when(h["points"].rlike("^[0-9]{1,9}$"), F.lit("77777")).otherwise(h["points"])))
    pages = event_pages(spark, sf).withColumn("hits", F.concat("hits", again, "hits"))
    texts = pages.select(F.to_json(F.struct("hits", "page", "nbPages", "nbHits")).alias("value"))
    tables = Tables(spark, scratch(spark))
    tables.insert_stories(parse_pages_text(texts))
    return tables.read("raw_stories").select("story_id", "score")


def parse_pages_text(texts):
    return parse_hits(parse_pages(texts))


def q_time_range_filter(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("ts", "created_at")
    since, until = 1704672000, 1705276800
    return reduce(
        DataFrame.unionByName,
        [
            in_time_range(events, since, until, closed).select(
                "event_id", F.lit(closed).alias("closed")
            )
            for closed in ("neither", "left")
        ],
    )


def _event_bounds(spark, sf):
    return table(spark, sf, "events").agg(
        F.min("ts").alias("range_start"), F.max("ts").alias("range_end")
    )


def q_window_plan(spark, sf):
    return window_plan(_event_bounds(spark, sf))


def q_coverage_audit(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("ts", "created_at")
    bounds = _event_bounds(spark, sf)
    start = bounds.select("range_start").scalar()
    return coverage_audit(events, window_plan(bounds), start, cap=AUDIT_CAP)


def q_page_audit(spark, sf):
    # every day's first page, reporting the hits of that day
    of_day = event_pages(spark, sf).groupBy("day").agg(
        F.sum(F.size("hits")).alias("nbHits"), F.lit(0).alias("page"), F.array().alias("hits")
    )
    return page_audit(of_day, "day", cap=2 * AUDIT_CAP)


def q_high_water_mark(spark, sf):
    return high_water_mark(trend_feed(spark, sf))


def q_insert_ignore_dedup(spark, sf):
    feed = trend_feed(spark, sf)
    stored = first_per_key(
        feed.filter(F.col("created_at") < ntz(STORED_BEFORE)), ["story_id"], TREND_ORDER
    )
    new = first_per_key(feed, ["story_id"], TREND_ORDER)
    return not_yet_stored(new, stored, ["story_id"]).select(*STORY_COLUMNS)


def q_merge_replace(spark, sf):
    stories = trend_stories(spark, sf)
    stored = hype_scores(
        rollup_mentions(matched_stories(stories.filter("score < 40"), PART_TAXONOMY))
    )
    fresh = rollup_mentions(
        matched_stories(stories.filter(F.col("iso_week") >= "1998-W00"), NOUNS)
    )
    return merge_replace(fresh, stored, ["keyword", "iso_week"], keep=["hype_score"])


def q_row_counts(spark, sf):
    scored = _scored(spark, sf)
    # the rollup is small and read twice: stored, so that stories are not detected for each reader
    path = f"{scratch(spark)}/mentions"
    scored["weekly_mentions"].write.parquet(path)
    mentions = spark.read.parquet(path)
    scored |= {"weekly_mentions": mentions, "keyword_velocity": keyword_velocity(mentions)}
    frames = {"raw_stories": trend_stories(spark, sf), **scored}
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name, df in frames.items()
        ],
    )


# --- detection ---------------------------------------------------------------


def q_url_text(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", url_text("url").alias("url_text"))


def q_match_text(spark, sf):
    feed = link_feed(spark, sf)
    return feed.select("story_id", match_text("title", "url").alias("match_text"))


def q_detect_keywords(spark, sf):
    found = detect_keywords(link_feed(spark, sf), PAGE_TAXONOMY)
    return found.select("story_id", F.concat_ws("|", "keywords").alias("keywords"))


def q_detect_by_word_join(spark, sf):
    links = link_feed(spark, sf)
    found = matched_by_word_join(links, name_table(links, PAGE_TAXONOMY))
    return found.select("story_id", "keyword")


def q_detect_documents(spark, sf):
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("story_id"), F.col("text").alias("title"), F.lit(None).alias("url")
    )
    matched = with_category(matched_stories(documents, DEFAULT), DEFAULT)
    return matched.select("story_id", "keyword", "category")


def q_detect_default_taxonomy(spark, sf):
    matched = matched_stories(default_titles(spark, sf), DEFAULT)
    return matched.groupBy("keyword").agg(F.count("*").alias("n_stories"), F.sum("story_id").alias("id_sum"))


def q_detection_totals(spark, sf):
    stories = trend_stories(spark, sf)
    return detection_totals(stories, keyword_events(stories, NOUNS))


def q_keyword_events(spark, sf):
    return keyword_events(trend_stories(spark, sf), PART_TAXONOMY)


def q_category_lookup(spark, sf):
    matched = matched_stories(trend_stories(spark, sf), PART_TAXONOMY)
    counted = matched.groupBy("keyword").agg(F.count("*").alias("n_events"))
    return with_category(counted, NOUNS)


def q_unprocessed_stories(spark, sf):
    stories = trend_stories(spark, sf)
    return unprocessed(stories, keyword_events(stories, FEW_NAMES)).select("story_id", "title")


# --- rollup, scores, velocity ------------------------------------------------


def q_weekly_mentions(spark, sf):
    stories = trend_stories(spark, sf)
    return weekly_mentions(keyword_events(stories, PART_TAXONOMY), stories)


def q_distinct_weeks(spark, sf):
    return distinct_weeks(_mentions(spark, sf))


def q_available_keywords(spark, sf):
    return available_keywords(_mentions(spark, sf))


def q_latest_week(spark, sf):
    return reports.latest_week(_mentions(spark, sf))


def q_load_metadata(spark, sf):
    arrived = F.col("created_at") + F.make_dt_interval(days=F.col("num_comments"))
    return reports.load_metadata(trend_stories(spark, sf).withColumn("fetched_at", arrived))


def q_minmax_norm(spark, sf):
    matched = matched_stories(trend_stories(spark, sf), PART_TAXONOMY)
    week = Window.partitionBy("iso_week")
    return rollup_mentions(matched).select(
        "keyword",
        "iso_week",
        *[
            round_stable(minmax(metric, week), 6).alias(f"norm_{metric}")
            for metric in ("mention_count", "weighted_score", "avg_comments")
        ],
    )


def q_flat_histories(spark, sf):
    """Scores that stay level for weeks, then move: every keyword's score by quarter, zero in the first."""
    quarter = F.floor(F.substring("iso_week", 7, 2).cast("int") / 13)
    level = F.when(quarter == 0, 0.0).otherwise(20.0 + quarter * 15)
    return keyword_velocity(_mentions(spark, sf).withColumn("hype_score", level))


def q_hype_scores(spark, sf):
    return _mentions(spark, sf).select("keyword", "iso_week", "hype_score")


def q_wow_velocity(spark, sf):
    return _velocity(spark, sf).select("keyword", "iso_week", "velocity")


def q_rolling_stats(spark, sf):
    return rolling_stats(_mentions(spark, sf)).select(
        "keyword",
        "iso_week",
        "prev_score",
        "history",
        round_stable("mean_before", 6).alias("mean_before"),
        round_stable("std_before", 6).alias("std_before"),
    )


def q_keyword_velocity(spark, sf):
    return _velocity(spark, sf)


# --- reports -----------------------------------------------------------------


def q_trending_keywords(spark, sf):
    return reports.trending_now(_mentions(spark, sf))


def q_category_trending(spark, sf):
    return reports.in_category(reports.trending_now(_mentions(spark, sf)), PART_TAXONOMY, "Noun")


def q_risers(spark, sf):
    return reports.risers(reports.trending_now(_mentions(spark, sf)))


def q_fallers(spark, sf):
    return reports.fallers(reports.trending_now(_mentions(spark, sf)))


def _feed(spark, sf):
    matched = matched_stories(trend_stories(spark, sf), PART_TAXONOMY)
    velocity = keyword_velocity(hype_scores(rollup_mentions(matched)))
    return reports.anomalies_now(matched, velocity)


def q_anomaly_feed(spark, sf):
    return _feed(spark, sf)


def q_anomaly_top_story(spark, sf):
    return reports.top_story_per_keyword(_feed(spark, sf))


def q_top_trending_all(spark, sf):
    return reports.top_trending(_velocity(spark, sf))


def q_hype_cycle(spark, sf):
    return reports.hype_cycle(_mentions(spark, sf), "gizmo", 52)


def q_hype_cycles(spark, sf):
    return reports.hype_cycles(_mentions(spark, sf), ["gizmo", "ring", "blue", "old"], 26)


def q_hype_pivot(spark, sf):
    return reports.hype_pivot(_mentions(spark, sf), ["gizmo", "ring", "blue", "old"], 52)


def q_compare_keywords(spark, sf):
    difference = reports.compare_keywords(_mentions(spark, sf), "gizmo", "blue", 52)
    return difference.select("iso_week", F.round("difference", 4).alias("difference"))


def q_default_selection(spark, sf):
    return reports.default_selection(_mentions(spark, sf), ["Python", "ring", "Go", "blue"])


def q_default_selection_fallback(spark, sf):
    return reports.default_selection(_mentions(spark, sf))


# --- emerging terms ----------------------------------------------------------


def q_tokens_ngrams(spark, sf):
    documents = table(spark, sf, "documents")
    tokens = documents.select("doc_id", term_tokens("text", STOP_WORDS).alias("tokens"))
    terms = tokens.withColumn("terms", with_bigrams(F.col("tokens")))
    return terms.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.size("terms").cast("long").alias("n_terms"),
        F.array_join("tokens", " ").alias("tokens"),
        F.try_element_at("terms", F.lit(-1)).alias("last_term"),
    )


def q_term_frequencies(spark, sf):
    documents = table(spark, sf, "documents")
    terms = terms_by_document(documents, "source", "doc_id", "text", STOP_WORDS)
    return term_counts(terms, "source", "doc_id").groupBy("source", "doc_id").agg(
        F.count("*").alias("n_terms"),
        F.sum("tf").alias("n_occurrences"),
        F.max("tf").alias("max_tf"),
    )


def q_document_frequencies(spark, sf):
    documents = table(spark, sf, "documents")
    terms = terms_by_document(documents, "source", "doc_id", "text", STOP_WORDS)
    idf = inverse_frequency(documents, terms, "source", "text", 5)
    return idf.select("source", "term", "df", F.round("idf", 6).alias("idf"))


def q_tfidf_scores(spark, sf):
    scores = tfidf_scores(
        table(spark, sf, "documents"), "source", "doc_id", "text", stop_words=STOP_WORDS
    )
    return scores.select("source", "term", F.round("tfidf_score", 6).alias("tfidf_score"))


def q_emerging_by_source(spark, sf):
    scores = tfidf_scores(
        table(spark, sf, "documents"), "source", "doc_id", "text", stop_words=STOP_WORDS
    )
    top = top_terms(scores, DEFAULT, "source")
    return top.select("term", "source", F.round("tfidf_score", 6).alias("tfidf_score"))


def q_emerging_terms(spark, sf):
    terms = emerging_terms(trend_stories(spark, sf), PART_TAXONOMY, stop_words=STOP_WORDS)
    return terms.select("term", "iso_week", F.round("tfidf_score", 6).alias("tfidf_score"))


def q_emerging_view(spark, sf):
    tables = Tables(spark, scratch(spark))
    tables.insert_stories(trend_feed(spark, sf), TREND_ORDER)
    discover(tables, PART_TAXONOMY, stop_words=STOP_WORDS)
    # stored scores win: the same terms with other scores change nothing
    again = tables.read("emerging_terms").withColumn("tfidf_score", F.col("tfidf_score") * 2 + 1)
    tables.insert_terms(again)
    week = tables.read("emerging_terms").agg(F.max("iso_week")).scalar()
    return emerging_view(tables, week)


def q_emerging_without_titles(spark, sf):
    """Every 4th story lacks its title: it counts nowhere, not even as a document."""
    stories = trend_stories(spark, sf)
    some = stories.withColumn("title", F.when(F.col("story_id") % 4 != 1, F.col("title")))
    terms = emerging_terms(some, PART_TAXONOMY, stop_words=STOP_WORDS)
    return terms.select("term", "iso_week", F.round("tfidf_score", 6).alias("tfidf_score"))


# --- jobs --------------------------------------------------------------------


def q_quality_checks(spark, sf):
    stories = trend_stories(spark, sf)
    mentions = _mentions(spark, sf)
    recent = table(spark, sf, "events").withColumnRenamed("ts", "created_at")
    return reduce(
        DataFrame.unionByName,
        [
            quality.new_stories(stories.filter(F.col("created_at") > ntz(STORED_BEFORE))),
            quality.has_events(keyword_events(stories, PART_TAXONOMY)),
            quality.freshness(stories, ntz("2024-01-31 00:00:00")),
            quality.freshness(recent, ntz("2024-01-31 00:00:00")).withColumn(
                "check_name", F.lit("freshness_events")
            ),
            quality.unique_key(mentions, ["keyword", "iso_week"], "weekly_mentions"),
            quality.unique_key(trend_feed(spark, sf), ["story_id"], "raw_feed"),
        ],
    ).withColumn("observed", F.round("observed", 4))


def q_recent_weeks(spark, sf):
    return recent_weeks_of(table(spark, sf, "orders"), "o_orderdate")


def q_rebuild_tables(spark, sf):
    tables = Tables(spark, scratch(spark))
    tables.insert_stories(trend_feed(spark, sf), TREND_ORDER)
    rebuild(tables, PART_TAXONOMY)
    return (
        tables.read("weekly_mentions")
        .join(tables.read("keyword_velocity"), ["keyword", "iso_week"])
        .select("keyword", "iso_week", "mention_count", "hype_score", "velocity", "z_score")
    )


def q_refresh_tables(spark, sf):
    feed = trend_feed(spark, sf)
    tables = Tables(spark, scratch(spark))
    tables.insert_stories(feed.filter(F.col("created_at") < ntz(REFRESH_FROM)), TREND_ORDER)
    rebuild(tables, PART_TAXONOMY)
    refresh(tables, feed, REFRESH_AS_OF, PART_TAXONOMY, order=TREND_ORDER, raise_failures=False)
    return tables.read("keyword_velocity").select(
        "keyword", "iso_week", "velocity", "rolling_avg", "z_score", "is_trending", "is_crashing"
    )


def q_trending_view(spark, sf):
    tables = Tables(spark, scratch(spark))
    tables.insert_stories(trend_feed(spark, sf), TREND_ORDER)
    rebuild(tables, PART_TAXONOMY)
    week = tables.read("keyword_velocity").filter("is_trending").agg(F.max("iso_week").alias("w")).first()["w"]
    view = trending_view(tables, week, "Noun", PART_TAXONOMY)
    movers = [
        view[part].select(F.lit(part).alias("part"), "keyword", "hype_score", "velocity", F.lit(None).cast("long").alias("story_id"), F.col("change_text").alias("shown"))
        for part in ("risers", "fallers")
    ]
    trending = view["trending"].select(
        F.lit("trending").alias("part"), "keyword", "hype_score", "velocity", F.col("mention_count").alias("story_id"), F.format_string("%.2f", "z_score").alias("shown")
    )
    anomalies = view["anomalies"].select(
        F.lit("anomalies").alias("part"), "keyword", F.col("score").cast("double").alias("hype_score"), F.lit(None).cast("double").alias("velocity"), "story_id", F.concat("z_text", "link").alias("shown")
    )
    return reduce(DataFrame.unionByName, [trending, *movers, anomalies])


def q_hype_cycle_view(spark, sf):
    tables = Tables(spark, scratch(spark))
    tables.insert_stories(trend_feed(spark, sf), TREND_ORDER)
    rebuild(tables, PART_TAXONOMY)
    view = hype_cycle_view(tables, ["gizmo", "blue"], 52)
    difference = F.round("difference", 4).alias("difference")
    return view["history"].join(view["difference"].select("iso_week", difference), "iso_week")


def q_table_states(spark, sf):
    """Rows of tables that do not exist, that were just created, and that hold the feed."""
    root = scratch(spark)
    missing = Tables(spark, root, create=False)
    states = [("missing", name, missing.read(name)) for name in TABLES]
    tables = Tables(spark, root)
    created = [("created", name, tables.row_count(name)) for name in TABLES]
    tables.insert_stories(trend_feed(spark, sf), TREND_ORDER)
    tables.append("keyword_events", keyword_events(tables.read("raw_stories"), PART_TAXONOMY), like="raw_stories")
    states += [("filled", name, tables.read(name)) for name in ("raw_stories", "keyword_events")]
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(s).alias("state"), F.lit(n).alias("table_name"), "n_rows") for s, n, df in states]
    fresh = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(s).alias("state"), F.lit(n).alias("table_name"), F.lit(k).cast("long").alias("n_rows")) for s, n, k in created])).alias("r")).select("r.*")
    return reduce(DataFrame.unionByName, [*counted, fresh])


# --- streaming ---------------------------------------------------------------


def _landed_stream(spark, sf, root: str) -> DataFrame:
    """Every page landed twice, and some cut off, as a stream of files."""
    pages = _page_texts(spark, sf)
    cut = pages.filter("page % 10 = 3").withColumn("value", F.expr("substring(value, 1, length(value) - 9)"))
    landed = pages.unionByName(pages).unionByName(cut).repartition(STREAM_FILES, "page")
    landed.select("value").write.text(f"{root}/pages")
    return page_stream(spark, f"{root}/pages", multi_line=False, max_files=STREAM_FILES // 2)


def _stream_tables(spark, sf, score: bool) -> Tables:
    root = scratch(spark)
    tables = Tables(spark, f"{root}/tables")
    stream = _landed_stream(spark, sf, root)
    start_stream(stream, tables, f"{root}/checkpoint", EVENT_TAXONOMY, score).awaitTermination()
    return tables


def _distinct_stream_tables(spark, sf) -> tuple[Tables, str]:
    root = scratch(spark)
    tables = Tables(spark, f"{root}/tables")
    for query in start_distinct_stream(_landed_stream(spark, sf, root), tables, f"{root}/checkpoint", EVENT_TAXONOMY):
        query.awaitTermination()
    return tables, root


def q_stream_distinct(spark, sf):
    """Copies of a story land in other files: the stream's state drops them."""
    return _distinct_stream_tables(spark, sf)[0].read("raw_stories").select(*STORY_COLUMNS)


def q_stream_state_refresh(spark, sf):
    """Weekly mentions as the state of a stream over the stored stories."""
    tables, root = _distinct_stream_tables(spark, sf)
    start_mentions(tables, f"{root}/mentions", EVENT_TAXONOMY, max_files=STREAM_FILES).awaitTermination()
    return tables.read("keyword_velocity").select(
        "keyword", "iso_week", "velocity", "rolling_avg", "z_score", "is_trending", "is_crashing"
    )


def q_stream_rejects(spark, sf):
    return _stream_tables(spark, sf, score=False).rejects().groupBy("reason").agg(F.count("*").alias("n_hits"))


def q_stream_ingest(spark, sf):
    return _stream_tables(spark, sf, score=False).read("raw_stories").select(*STORY_COLUMNS)


def q_stream_refresh(spark, sf):
    return _stream_tables(spark, sf, score=True).read("keyword_velocity").select(
        "keyword", "iso_week", "velocity", "rolling_avg", "z_score", "is_trending", "is_crashing"
    )


def all_queries():
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
