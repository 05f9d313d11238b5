"""Explicit schemas of the stored tables and of the search-result envelope.

Schemas are never inferred: a landed page with an unexpected field must not
change a table.  Stories and events are partitioned by week, the small tables by
year.
"""

from pyspark.sql import types as T

# Pages and hits are read as text and cast field by field, so that one odd value
# never takes a page with it.
HIT_TEXT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("objectID", "title", "created_at", "points", "num_comments", "url")
    ]
)

UNREADABLE = "_unreadable"
PAGE_TEXT = T.StructType(
    [
        T.StructField("hits", T.ArrayType(T.StringType())),
        T.StructField("page", T.StringType()),
        T.StructField("nbPages", T.StringType()),
        T.StructField("nbHits", T.StringType()),
        T.StructField(UNREADABLE, T.StringType()),
    ]
)

RAW_STORIES = T.StructType(
    [
        T.StructField("story_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("num_comments", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
        T.StructField("iso_week", T.StringType()),
    ]
)

KEYWORD_EVENTS = T.StructType(
    [
        T.StructField("story_id", T.LongType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("iso_week", T.StringType()),
    ]
)

WEEKLY_MENTIONS = T.StructType(
    [
        T.StructField("keyword", T.StringType()),
        T.StructField("mention_count", T.LongType()),
        T.StructField("weighted_score", T.DoubleType()),
        T.StructField("avg_comments", T.DoubleType()),
        T.StructField("hype_score", T.DoubleType()),
        T.StructField("iso_week", T.StringType()),
    ]
)

KEYWORD_VELOCITY = T.StructType(
    [
        T.StructField("keyword", T.StringType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("rolling_avg", T.DoubleType()),
        T.StructField("z_score", T.DoubleType()),
        T.StructField("is_trending", T.BooleanType()),
        T.StructField("is_crashing", T.BooleanType()),
        T.StructField("iso_week", T.StringType()),
    ]
)

EMERGING_TERMS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("tfidf_score", T.DoubleType()),
        T.StructField("iso_week", T.StringType()),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField(
            "arrival",
            T.StructType(
                [
                    T.StructField("file", T.StringType()),
                    T.StructField("page", T.IntegerType()),
                    T.StructField("position", T.IntegerType()),
                ]
            ),
        ),
        T.StructField("reason", T.StringType()),
        T.StructField("json", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)

# table name -> (schema, logical key)
TABLES = {
    "raw_stories": (RAW_STORIES, ["story_id"]),
    "keyword_events": (KEYWORD_EVENTS, ["story_id", "keyword"]),
    "weekly_mentions": (WEEKLY_MENTIONS, ["keyword", "iso_week"]),
    "keyword_velocity": (KEYWORD_VELOCITY, ["keyword", "iso_week"]),
    "emerging_terms": (EMERGING_TERMS, ["term", "iso_week"]),
}
