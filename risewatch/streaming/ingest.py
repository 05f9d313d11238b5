"""Continuous ingest of landed pages with Structured Streaming.

Every micro-batch is loaded, detected and re-scored with the batch operators.
All three steps can be repeated: a batch that is replayed after a failure finds
its stories and events stored already and re-scores the same weeks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from risewatch.operators.detect import matched_stories
from risewatch.plans.jobs import detect_new, rescore, store_mentions
from risewatch.schemas import PAGE_TEXT, RAW_STORIES, UNREADABLE
from risewatch.sources.pages import page_columns, parse_hits, rejected_hits
from risewatch.sources.tables import Tables
from risewatch.taxonomy import DEFAULT, Taxonomy

ADAPTIVE = "spark.sql.adaptive.enabled"


def page_stream(
    spark: SparkSession, path: str, multi_line: bool = True, max_files: int | None = None
) -> DataFrame:
    """Landed pages as a stream; ``max_files`` limits the files of a micro-batch."""
    reader = spark.readStream.schema(PAGE_TEXT).option("columnNameOfCorruptRecord", UNREADABLE)
    reader = reader.option("multiLine", multi_line)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return page_columns(reader.json(path), F.col("_metadata.file_path"))


def load_batch(
    tables: Tables,
    stories: DataFrame,
    taxonomy: Taxonomy = DEFAULT,
    score: bool = True,
    order: Sequence[str | Column] | None = None,
) -> None:
    """Store one batch of parsed stories and bring the other tables up to date."""
    stories = stories.persist()
    try:
        tables.insert_stories(stories, order)
        # labels, so bounded by the calendar and not by the stories
        weeks = [row["iso_week"] for row in stories.select("iso_week").distinct().collect()]
        detect_new(tables, taxonomy, ids=stories, weeks=weeks)
        weeks = [week for week in weeks if week is not None]
        if score and weeks:
            rescore(tables, weeks, later_weeks=True)
    finally:
        stories.unpersist()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the stream that owns a checkpoint: it stays over restarts, and a new checkpoint has another."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _reject_writer(tables: Tables, checkpoint: str):
    known: list[str] = []

    def write(batch: DataFrame, number: int) -> None:
        own = Tables(batch.sparkSession, tables.root, create=False)
        if not known:
            known.append(stream_id(batch.sparkSession, checkpoint))
        own.write_rejects(rejected_hits(batch), number, known[0])

    return write


def start_stream(
    pages: DataFrame,
    tables: Tables,
    checkpoint: str,
    taxonomy: Taxonomy = DEFAULT,
    score: bool = True,
    order: Sequence[str | Column] | None = None,
) -> StreamingQuery:
    """Start loading ``pages``; ends when everything landed so far is stored.

    Run it again, or on a schedule, with the same checkpoint to continue.  What
    cannot be stored goes to ``tables.rejects()``.
    """
    reject = _reject_writer(tables, checkpoint)

    def on_batch(batch: DataFrame, number: int) -> None:
        reject(batch, number)
        load_batch(Tables(batch.sparkSession, tables.root), parse_hits(batch), taxonomy, score, order)

    return _start(pages, checkpoint, on_batch)


@contextmanager
def _planned_as(adaptive: str, session: SparkSession) -> Iterator[None]:
    """Within a micro-batch, set adaptive execution in the stream's session."""
    of_stream = session.conf.get(ADAPTIVE)
    session.conf.set(ADAPTIVE, adaptive)
    try:
        yield
    finally:
        session.conf.set(ADAPTIVE, of_stream)


def _start(stream: DataFrame, checkpoint: str, on_batch, mode: str = "append") -> StreamingQuery:
    """Start a query whose work on a micro-batch is planned as in the session that starts it.

    Spark turns adaptive execution off in the stream's own session, for the state's sake.  What
    ``on_batch`` does has no state; without adaptive execution the rebalancing before a write is
    left out, every task of a shuffle writes a file for every week, and whoever reads these files
    as a stream gets that many more micro-batches.
    """
    adaptive = stream.sparkSession.conf.get(ADAPTIVE)

    def planned(batch: DataFrame, number: int) -> None:
        with _planned_as(adaptive, batch.sparkSession):
            on_batch(batch, number)

    return (
        stream.writeStream.foreachBatch(planned)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_stories(pages: DataFrame, delay: str = "2 days") -> DataFrame:
    """Stories of a stream of pages, without the copies that land within ``delay`` of the first.

    The watermark follows the time of landing, not the story's own date, so no story is
    late, however old it is.  The state holds the ids of one delay; a copy that lands
    later is met by the stored ids.  Of copies in one micro-batch any may be kept, so this is for
    feeds whose copies are alike; :func:`start_stream` keeps the first.
    """
    landed = parse_hits(pages).withColumn("_landed", F.current_timestamp())
    return landed.withWatermark("_landed", delay).dropDuplicatesWithinWatermark(["story_id"]).drop("_landed")


def start_distinct_stream(
    pages: DataFrame,
    tables: Tables,
    checkpoint: str,
    taxonomy: Taxonomy = DEFAULT,
    delay: str = "2 days",
    score: bool = False,
) -> list[StreamingQuery]:
    """Like :func:`start_stream`, with copies dropped by the stream's state before any batch is loaded.

    Two queries: the stories, and the rejects, which have no id to be told apart by.
    """
    def on_batch(batch: DataFrame, number: int) -> None:
        load_batch(Tables(batch.sparkSession, tables.root), batch, taxonomy, score)

    stories = _start(distinct_stories(pages, delay), f"{checkpoint}/stories", on_batch)
    rejects = f"{checkpoint}/rejects"
    return [stories, _start(pages, rejects, _reject_writer(tables, rejects))]


def mention_sums(stories: DataFrame, taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """(keyword, iso_week) sums of a stream of stories, kept in its state: whole numbers, so totals are exact."""
    matched = matched_stories(stories, taxonomy).filter(F.col("iso_week").isNotNull())
    return matched.groupBy("keyword", "iso_week").agg(
        F.count("*").alias("mention_count"),
        F.sum("score").alias("scores"),
        F.sum("num_comments").alias("comments"),
        F.count("num_comments").alias("commented"),
    )


def start_mentions(
    tables: Tables, checkpoint: str, taxonomy: Taxonomy = DEFAULT, max_files: int | None = None
) -> StreamingQuery:
    """Keep the weekly mentions, their scores and flags up to date with the stored stories.

    The stories' table is the stream: every stored story arrives once, so the state needs no
    start value and no removal of copies.  A micro-batch brings the new totals of the
    keywords and weeks it has touched and reads neither stories nor events again.  Totals
    replace stored ones, so a batch may be replayed.  The state has a row per keyword and
    week, as the table itself.
    """
    reader = tables.spark.readStream.schema(RAW_STORIES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stories = reader.parquet(tables.path("raw_stories"))

    def on_batch(batch: DataFrame, number: int) -> None:
        own = Tables(batch.sparkSession, tables.root)
        batch = batch.persist()
        try:
            # labels, so bounded by the calendar
            weeks = sorted(row["iso_week"] for row in batch.select("iso_week").distinct().collect())
            fresh = batch.select(
                "keyword",
                "iso_week",
                "mention_count",
                (F.col("scores").cast("double") / F.col("mention_count")).alias("weighted_score"),
                F.try_divide("comments", "commented").alias("avg_comments"),
            )
            if weeks:
                store_mentions(own, fresh, weeks, later_weeks=True)
        finally:
            batch.unpersist()

    return _start(mention_sums(stories, taxonomy), checkpoint, on_batch, "update")
