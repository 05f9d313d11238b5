"""Story feeds derived from the given tables.

* trend feed: an order line is a story, its part's name the title; ids repeat.
* page feed: events packed into search-result pages, some hits invalid.
* link feed: web pages with their title and link.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risewatch.functions.time import week_label
from risewatch.operators.keyed import first_per_key
from risewatch.taxonomy import DEFAULT, Taxonomy

PART_TAXONOMY = Taxonomy(
    {
        "Adjective": ["blue", "cold", "hot", "large", "new", "old", "red", "small"],
        "Noun": ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"],
    }
)
EVENT_TAXONOMY = Taxonomy({"Reading": ["click", "view"], "Account": ["signup", "purchase", "error"]})
PAGE_TAXONOMY = Taxonomy(
    {
        "Word": ["the", "De", "que", "for", "are", "and", "un", "les", "la", "en"],
        "Phrase": ["of the", "de la", "casino win", "free-bets", "ist der"],
        "Link": ["www", "blog", "casino", "com", "org"],
        "Symbol": ["of+", "Th&"],
    },
    {"la": r"\bla\b(?!\s+(?:de|que|éo))", "en": r"\ben\b(?=\s+(?:el|la|un)|\s*$)"},
)
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "for", "it", "on", "as", "was", "de", "la"]

TREND_ORDER = [
    "created_at", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "num_comments",
]
HITS_PER_PAGE = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trend_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trend feed; one id may come with several dates and titles."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("story_id"),
        F.col("p_name").alias("title"),
        F.lit(None).cast("string").alias("url"),
        F.floor("l_quantity").cast("int").alias("score"),
        F.floor(F.col("l_tax") * 100).cast("int").alias("num_comments"),
        F.col("l_shipdate").alias("created_at"),
        week_label("l_shipdate").alias("iso_week"),
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
    )


def trend_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend feed with one row per id: the first by date."""
    stories = first_per_key(trend_feed(spark, sf_dir), ["story_id"], TREND_ORDER)
    return stories.select(
        "story_id", "title", "url", "score", "num_comments", "created_at", "iso_week"
    )


def event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as search hits: every 7th lacks its id, every 11th has a bad one,
    every 13th lacks its title, every 17th has an empty one, every 5th lacks points,
    every 23rd has points that are no integer, every 29th too many."""
    e, n = table(spark, sf_dir, "events"), F.col("event_id")
    return e.select(
        (n / HITS_PER_PAGE).cast("long").alias("page_no"),
        n.alias("position"),
        F.when(n % 7 == 3, None)
        .when(n % 11 == 5, F.concat(F.lit("x"), n.cast("string")))
        .otherwise(n.cast("string"))
        .alias("objectID"),
        F.when(n % 13 == 4, None)
        .when(n % 17 == 6, F.lit(""))
        .otherwise(F.concat_ws(" ", "event_type", "props"))
        .alias("title"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
        F.when(n % 5 == 0, None)
        .when(n % 23 == 8, F.lit("3.5"))
        .when(n % 29 == 9, F.lit("3000000000"))
        .otherwise(F.floor("value").cast("int").cast("string"))
        .alias("points"),
        (F.col("user_id") % 50).cast("int").alias("num_comments"),
        F.concat(F.lit("https://example.com/u/"), F.col("user_id").cast("string")).alias("url"),
        "ts",
    )


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of at most 100 hits each, with page number, totals and day."""
    hit = F.struct("objectID", "title", "created_at", "points", "num_comments", "url")
    hits = event_hits(spark, sf_dir)
    total = hits.select(
        F.count("*").alias("nbHits"), (F.max("page_no") + 1).cast("int").alias("nbPages")
    )
    pages = hits.groupBy("page_no").agg(
        F.sort_array(F.collect_list(F.struct("position", hit.alias("hit")))).alias("ordered"),
        F.to_date(F.min("ts")).alias("day"),
    )
    # one row of totals, looked up as a scalar
    return pages.select(
        F.transform("ordered", lambda h: h["hit"]).alias("hits"),
        F.col("page_no").cast("int").alias("page"),
        total.select("nbPages").scalar().alias("nbPages"),
        total.select("nbHits").scalar().alias("nbHits"),
        "day",
    )


def link_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("story_id"),
        F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        "url",
    )


def scratch(spark: SparkSession) -> str:
    """A new folder for tables in the shared folder the cluster names (spark.checkpoint.dir), else in the warehouse.

    It goes when the driver's JVM ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    root = shared or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not shared and root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    path = f"{root.rstrip('/')}/risewatch-{os.urandom(8).hex()}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def default_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose titles hold names of the built-in taxonomy: by index, at a start, an end or inside, some
    followed by words that forbid a match, every 10th missing."""
    names = list(DEFAULT.category_of())
    n = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    name = F.element_at(F.array(*map(F.lit, names)), (F.pmod(n, F.lit(len(names))) + 1).cast("int"))
    tail = F.element_at(F.array(*map(F.lit, TITLE_TAILS)), (F.pmod(F.col("l_partkey"), F.lit(len(TITLE_TAILS))) + 1).cast("int"))
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("story_id"),
        F.when(n % 10 == 3, None)
        .when(n % 3 == 0, F.concat(name, tail))
        .when(n % 3 == 1, F.concat("p_name", F.lit(" "), name, tail))
        .otherwise(F.concat("p_name", F.lit(" "), name))
        .alias("title"),
        F.lit(None).cast("string").alias("url"),
    )


TITLE_TAILS = ["", " to bed", " language", "20", " 2", "s", " back", "-like", " in", ", cran", "  package"]
