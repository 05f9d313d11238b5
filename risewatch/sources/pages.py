"""Landed search-result pages: reading, and turning hits into stories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from risewatch.functions.time import epoch_seconds, utc_timestamp, week_label
from risewatch.schemas import HIT_TEXT, PAGE_TEXT, UNREADABLE


# (file, page number, position on the page): the order in which hits were found.
ARRIVAL = "arrival"


def _once(parsed: Column) -> Column:
    """``parsed`` as a generator of one row.

    The optimiser would put an expression itself into every column and filter that
    reads a field of it, and parse the text anew for each.
    """
    return F.explode_outer(F.array(parsed))


def page_columns(text: DataFrame, file: Column) -> DataFrame:
    """(hits, page, nbPages, nbHits, unreadable, file) of pages read as text.

    ``hits`` holds each hit's JSON.  A page that is no JSON object has its text in
    ``unreadable`` and no hits.
    """
    # Spark reads no file for the unreadable text alone, so another column takes part
    bad = F.coalesce(F.col(UNREADABLE), F.when(F.size("hits") < -1, ""))
    return text.select(
        F.when(bad.isNull(), F.col("hits")).alias("hits"),
        F.col("page").try_cast("int").alias("page"),
        F.col("nbPages").try_cast("int").alias("nbPages"),
        F.col("nbHits").try_cast("bigint").alias("nbHits"),
        bad.alias("unreadable"),
        file.alias("file"),
    )


def read_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Result pages from JSON files: one page per file, or one per line."""
    reader = spark.read.schema(PAGE_TEXT).option("columnNameOfCorruptRecord", UNREADABLE)
    text = reader.option("multiLine", multi_line).json(path)
    return page_columns(text, F.col("_metadata.file_path"))


def parse_pages(json_text: DataFrame, column: str = "value") -> DataFrame:
    """Result pages from a text column holding one page per row."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}
    page = F.from_json(column, PAGE_TEXT, options)
    # a null text is as unreadable as a broken one
    whole = F.when(F.col(column).rlike(r"(?s)^\s*\{"), page)
    text = json_text.select(_once(whole).alias("p"), F.col(column).alias("_text")).select(
        *[f"p.{f.name}" for f in PAGE_TEXT if f.name != UNREADABLE],
        F.when(F.col("p").isNull(), F.coalesce("_text", F.lit(""))).otherwise(F.col(f"p.{UNREADABLE}")).alias(UNREADABLE),
    )
    return page_columns(text, F.lit(None).cast("string"))


def total_hits(pages: DataFrame, *window: str) -> DataFrame:
    """``nb_hits``: the total the first page reports, else its length; by window columns, if given.

    Totals of different fetches do not mix: without window columns the pages must
    be those of one fetch.
    """
    first = F.coalesce("nbHits", F.size("hits").cast("long"), F.lit(0))
    return (
        pages.filter(F.coalesce("page", F.lit(0)) == 0)
        .groupBy(*window)
        .agg(F.coalesce(F.max(first), F.lit(0).cast("long")).alias("nb_hits"))
    )


def _integer(text: str, kind: str) -> Column:
    text = F.trim(text)
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast(kind))


def hits(pages: DataFrame) -> DataFrame:
    """Every hit with its text fields, its JSON, its arrival, and ``reason`` if it cannot be stored."""
    given = pages.filter(F.col("unreadable").isNull()) if "unreadable" in pages.columns else pages
    rows = given.select(_file(pages), F.col("page").alias("page_no"), F.posexplode("hits").alias("position", "json"))
    return _parsed(rows).withColumn("reason", _reason())


def _file(pages: DataFrame) -> Column:
    return (F.col("file") if "file" in pages.columns else F.lit(None).cast("string")).alias("file")


def _parsed(rows: DataFrame, *carry: str) -> DataFrame:
    """(arrival, json, the hit's text fields) of rows (file, page_no, position, json)."""
    return rows.select("*", _once(F.from_json("json", HIT_TEXT)).alias("hit")).select(
        F.struct("file", F.col("page_no").alias("page"), "position").alias(ARRIVAL), "json", *carry, "hit.*"
    )


def _reason() -> Column:
    odd = lambda name: F.col(name).isNotNull() & _integer(name, "int").isNull()
    return (
        F.when(~F.coalesce(F.col("json").rlike(r"(?s)^\s*\{"), F.lit(False)), "hit is not an object")
        .when(F.coalesce(F.length("objectID"), F.lit(0)) == 0, "missing id")
        .when(F.coalesce(F.length("title"), F.lit(0)) == 0, "missing title")
        .when(_integer("objectID", "bigint").isNull(), "id is not an integer")
        .when(odd("points"), "unreadable points")
        .when(odd("num_comments"), "unreadable comments")
    )


def parse_hits(pages: DataFrame) -> DataFrame:
    """Stories from the valid hits of ``pages``; missing counts become 0.

    ``arrival`` tells where a hit was found; of an id's copies the first is stored.
    """
    return (
        hits(pages)
        .filter(F.col("reason").isNull())
        .select(
            _integer("objectID", "bigint").alias("story_id"),
            "title",
            "url",
            F.coalesce(_integer("points", "int"), F.lit(0)).alias("score"),
            F.coalesce(_integer("num_comments", "int"), F.lit(0)).alias("num_comments"),
            utc_timestamp("created_at").alias("created_at"),
            ARRIVAL,
        )
        .withColumn("iso_week", week_label("created_at"))
    )


def rejected_hits(pages: DataFrame) -> DataFrame:
    """(arrival, reason, json) of what :func:`parse_hits` does not return: bad hits, and whole pages nobody can read.

    An unreadable page goes through as if its text were a hit, without a place on a
    page, so that the pages are read and parsed once for both.
    """
    if "unreadable" not in pages.columns:
        return hits(pages).filter(F.col("reason").isNotNull()).select(ARRIVAL, "reason", "json")
    whole = F.col("unreadable").isNull()
    rows = pages.select(
        _file(pages),
        F.when(whole, F.col("page")).alias("page_no"),
        whole.alias("whole"),
        F.posexplode(F.when(whole, F.col("hits")).otherwise(F.array("unreadable"))).alias("position", "json"),
    ).withColumn("position", F.when(F.col("whole"), F.col("position")))
    reason = F.when(~F.col("whole"), "unreadable page").otherwise(_reason())
    bad = _parsed(rows, "whole").withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return bad.select(ARRIVAL, "reason", "json")


def in_time_range(
    stories: DataFrame,
    since: int | Column,
    until: int | Column | None = None,
    closed: str = "neither",
) -> DataFrame:
    """Stories created between two epoch seconds.

    Both ends are open by default, so a story created on the second two windows
    share belongs to neither; ``closed="left"`` makes windows seamless.
    """
    if closed not in ("neither", "left"):
        raise ValueError(f"closed must be 'neither' or 'left', not {closed!r}")
    created = epoch_seconds("created_at")
    since = F.lit(since) if isinstance(since, int) else since
    kept = stories.filter(created >= since if closed == "left" else created > since)
    return kept if until is None else kept.filter(created < until)


def high_water_mark(stories: DataFrame) -> DataFrame:
    """One row, ``since_ts``: epoch second of the newest story, 0 if there is none."""
    return stories.agg(
        F.coalesce(epoch_seconds(F.max("created_at")), F.lit(0).cast("long")).alias("since_ts")
    )
