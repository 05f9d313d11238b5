"""Ids of the stored stories, bucketed by id.

An insert-or-ignore meets only the ids that hash like its own: the batch is dealt
to the buckets, and each bucket of stored ids is read where it is, without being
shuffled.  The table grows by one small file per bucket and load.

The stories are the truth, the ids an index over them.  A mark is set before a
load writes and goes when stories and ids are both written.  A load that finds the
mark, or no ids at all, first makes the ids anew from the stories.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16


class StoredIds:
    """Bucketed ids below ``root``; ``buckets`` is fixed by the first load (16 by default, thousands for billions of ids)."""

    def __init__(self, spark: SparkSession, root: str, key: str = "story_id", buckets: int = BUCKETS):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.root = f"{root}/story_ids"
        self.table = "risewatch_ids_" + hashlib.md5(f"{self.root} {buckets}".encode()).hexdigest()[:16]

    def _folder(self, name: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _register(self) -> None:
        """Tell this session's catalogue what is in the folder; data stay when a session ends."""
        folder, fs = self._folder(f"b{self.buckets}")
        if not self.spark.catalog.tableExists(self.table):
            place = folder.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString().replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table} ({self.key} BIGINT) USING parquet "
                f"CLUSTERED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
            )
        self.spark.catalog.refreshTable(self.table)

    def read(self) -> DataFrame:
        self._register()
        return self.spark.table(self.table)

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows dealt out as the buckets are."""
        return rows.repartition(self.buckets, self.key)

    def append(self, ids: DataFrame) -> None:
        """Store ids that come once each: they are shuffled to their buckets only, not to find copies as well."""
        self._register()
        ids = self.dealt(ids.select(self.key).filter(F.col(self.key).isNotNull()))
        ids.write.format("parquet").mode("append").bucketBy(self.buckets, self.key).saveAsTable(self.table)

    def begin(self, stories: DataFrame) -> DataFrame:
        """The stored ids, after making them anew from ``stories`` if the last load did not end; sets the mark."""
        mark, fs = self._folder("_loading")
        data, _ = self._folder(f"b{self.buckets}")
        if fs.exists(mark) or not fs.exists(data):
            fs.create(mark, True).close()
            fs.delete(data, True)
            self.append(stories.select(self.key).distinct())
        else:
            fs.create(mark, True).close()
        return self.read()

    def end(self) -> None:
        mark, fs = self._folder("_loading")
        fs.delete(mark, False)
