import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        # several writers even for tiny tables
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        # results must not depend on the session time zone
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    from risewatch.sources.tables import Tables

    return Tables(spark, str(tmp_path / "tables"))


@pytest.fixture
def make_stories(spark):
    """Stories from (id, title, score, comments, created_at[, url]) tuples."""
    from pyspark.sql import functions as F

    from risewatch.functions.time import week_label

    def make(rows):
        rows = [(*r, None)[:6] if len(r) == 5 else r for r in rows]
        df = spark.createDataFrame(
            rows,
            "story_id long, title string, score int, num_comments int, created_at string, url string",
        )
        return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz")).withColumn(
            "iso_week", week_label("created_at")
        )

    return make
