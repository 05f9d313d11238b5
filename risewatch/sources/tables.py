"""The stored tables: Parquet below one root.

Stories and events, which grow with the feed, are partitioned by week.  The
other tables hold one row per keyword (or top term) and week whatever the number
of stories; they are partitioned by year, so that a refresh rewrites a file or
two and not hundreds of tiny ones.

A table is a folder of versions (``v000001``, ...).  The newest version with a
``_SUCCESS`` mark is the table; Spark sets the mark as the last step of a job.
Appends add to that version, replacements write the next one, so a replacement
that dies leaves the table as it was and can be run again.  A replacement of weeks
writes the years of these weeks only.  The name of an empty file beside it, its map
(``_v000003.2023-1.2024-3``), tells which version holds each year.  Writers are
meant to be alone on a table; a version that has been replaced goes with the
replacement after it, which gives its readers time to end, and leaves behind the
years that later versions still use.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risewatch.operators.keyed import first_per_key, not_yet_stored
from risewatch.schemas import REJECTS, TABLES
from risewatch.sources.ids import BUCKETS, StoredIds
from risewatch.sources.pages import ARRIVAL

WEEK, YEAR = "iso_week", "iso_year"
WEEK_PARTITIONED = ("raw_stories", "keyword_events")
# A map is a file's name, which stores limit to 255 bytes; beyond this the table is written whole.
MAP_LENGTH = 200
# A table is in pieces if it has more files than this for each folder and they are smaller than this on average.
FILES_A_FOLDER, SMALL_FILE = 4, 4 << 20


def years_of(weeks: Sequence[str]) -> list[str]:
    return sorted({week[:4] for week in weeks})


class Tables:
    """Access to the tables below ``root``; missing ones are created empty."""

    def __init__(self, spark: SparkSession, root: str, create: bool = True, id_buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ids = StoredIds(spark, self.root, buckets=id_buckets)
        if create:
            self.create_missing()

    def _folder(self, path: str):
        """A Hadoop path with its file system: tables may be in any store Spark reads."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self, name: str) -> list[int]:
        """Complete versions of a table, oldest first."""
        folder, fs = self._folder(f"{self.root}/{name}")
        if not fs.exists(folder):
            return []
        found = [entry.getPath() for entry in fs.listStatus(folder)]
        marked = [p.getName() for p in found if fs.exists(self._folder(f"{p}/_SUCCESS")[0])]
        return sorted(int(version[1:]) for version in marked if version[:1] == "v" and version[1:].isdigit())

    def _listed(self, path: str) -> list[str]:
        folder, fs = self._folder(path)
        return [entry.getPath().getName() for entry in fs.listStatus(folder)] if fs.exists(folder) else []

    def _years_in(self, path: str) -> list[str]:
        return [x[len(YEAR) + 1 :] for x in self._listed(path) if x.startswith(f"{YEAR}=")]

    def _map(self, name: str, version: int) -> dict[str, int] | None:
        """The version that holds each year of a version's rows; None for a version written whole."""
        mark = f"_v{version:06d}."
        for entry in self._listed(f"{self.root}/{name}"):
            if entry.startswith(mark):
                held = (x.rsplit("-", 1) for x in entry[len(mark) :].split("."))
                return {year: int(v) for year, v in held}
        return None

    def _whole_map(self, name: str, version: int) -> dict[str, int]:
        found = self._map(name, version)
        if found is None:
            found = dict.fromkeys(self._years_in(self.path(name, version)), version)
        return found

    def path(self, name: str, version: int | None = None) -> str:
        if version is None:
            version = (self.versions(name) or [1])[-1]
        return f"{self.root}/{name}/v{version:06d}"

    def create_missing(self) -> None:
        for name, (schema, _) in TABLES.items():
            if not self.versions(name):
                empty = self._partitioned(name, self.spark.createDataFrame([], schema))
                empty.write.mode("overwrite").partitionBy(_partition(name)).parquet(self.path(name, 1))

    def read(self, name: str, years: Sequence[str] | None = None, weeks: Sequence[str] | None = None) -> DataFrame:
        """The table, or its rows of some years or weeks; empty if it does not exist.

        Both limits name the folders that are read, so the folders of other weeks are
        not even listed; weeks of a table by year also name its years.  They are
        partition filters besides.
        """
        schema, _ = TABLES[name]
        stored = schema if name in WEEK_PARTITIONED else _with_year(schema)
        if weeks is not None and years is None:
            years = years_of(weeks)
        done = self.versions(name)
        if done:
            df = self._stored(name, done[-1], stored, weeks if name in WEEK_PARTITIONED else years)
        else:
            df = self.spark.createDataFrame([], stored)
        if weeks is not None:
            df = df.filter(F.col(WEEK).isin(list(weeks)))
        if years is not None and YEAR in df.columns:
            df = df.filter(F.col(YEAR).isin(list(years)))
        elif years is not None and weeks is None:
            df = df.filter(F.substring(WEEK, 1, 4).isin(list(years)))
        return df.drop(YEAR)

    def _stored(self, name: str, version: int, schema: T.StructType, values: Sequence[str] | None) -> DataFrame:
        """The folders of these values in a version, from the versions that hold them."""
        held = None if name in WEEK_PARTITIONED else self._map(name, version)
        if held is None:
            places = {version: values}
        else:
            of = lambda v: [y for y, holder in held.items() if holder == v and (values is None or y in values)]
            places = {v: years for v in sorted(set(held.values())) if (years := of(v))} or {version: values}
        parts = []
        for v, wanted in places.items():
            path = self.path(name, v)
            folders = self._folders(path, _partition(name), wanted)
            if len(places) == 1 or folders != [path]:
                parts.append(self.spark.read.schema(schema).option("basePath", path).parquet(*folders))
            # a year that a replacement has emptied has no folder
        if not parts:
            path = self.path(name, version)
            parts = [self.spark.read.schema(schema).option("basePath", path).parquet(path)]
        return reduce(DataFrame.unionByName, parts)

    def _folders(self, path: str, partition: str, values: Sequence[str] | None) -> list[str]:
        """The folders of these values, or the whole table's if no value is given or none has a folder."""
        if values is None:
            return [path]
        named = [f"{path}/{partition}={value}" for value in sorted(set(values))]
        there = [x for x in named if (found := self._folder(x))[1].exists(found[0])]
        return there or [path]

    def rejects(self) -> DataFrame:
        """(arrival, reason, json, stream, batch) of everything the streams could not store."""
        folder, fs = self._folder(f"{self.root}/rejects")
        if not fs.exists(folder):
            return self.spark.createDataFrame([], REJECTS)
        return self.spark.read.schema(REJECTS).parquet(f"{self.root}/rejects")

    def write_rejects(self, rejected: DataFrame, batch: int, stream: str = "none") -> None:
        """Keep what a batch of a stream could not store; a batch that is replayed replaces its own rows."""
        rejected.write.mode("overwrite").parquet(f"{self.root}/rejects/stream={stream}/batch={batch}")

    def row_count(self, name: str) -> int:
        return self.read(name).count()

    def in_pieces(self, name: str) -> bool:
        """Whether a table lies in many small files, as many small loads leave it."""
        folder, fs = self._folder(self.path(name))
        held = fs.getContentSummary(folder)
        files = held.getFileCount()
        return files > FILES_A_FOLDER * held.getDirectoryCount() and held.getLength() < SMALL_FILE * files

    def append(self, name: str, df: DataFrame, like: str | None = None) -> int:
        """Add rows; returns how many.  A table whose years lie in several versions is written anew.

        ``like`` names the stored table that ``df`` goes through row by row, if both are
        partitioned by week: its files hold a week each, so the tasks that read them write
        the rows of their weeks, without a shuffle, unless that table lies in pieces.
        """
        done = self.versions(name)
        if name not in WEEK_PARTITIONED and done and self._map(name, done[-1]) is not None:
            return self._replace(name, df, self.read(name))
        return self._write(name, df, self.path(name), "append", like=like)

    def overwrite(self, name: str, df: DataFrame, like: str | None = None) -> int:
        """Replace the whole table; ``df`` may read it.  For ``like`` see :meth:`append`."""
        return self._replace(name, df, like=like)

    def replace_weeks(self, name: str, df: DataFrame, weeks: Sequence[str]) -> int:
        """Replace all rows of some weeks by those that ``df`` has of them; returns their number.

        For the small tables: the rows of other weeks of the same years are copied to the
        new version; other years stay where they are.  ``df`` may read the table itself.
        """
        mine = F.col(WEEK).isin(list(weeks))
        done = self.versions(name)
        touched = years_of(weeks)
        held = {}
        if name not in WEEK_PARTITIONED and done:
            held = {y: v for y, v in self._whole_map(name, done[-1]).items() if y not in touched}
        if not held or len(_map_name(0, held)) > MAP_LENGTH:
            others = self.read(name).filter(~mine | F.col(WEEK).isNull())
            return self._replace(name, df.filter(mine), others)
        others = self.read(name, years=touched).filter(~mine)
        return self._replace(name, df.filter(mine), others, held | dict.fromkeys(touched, done[-1] + 1))

    def _replace(
        self,
        name: str,
        df: DataFrame,
        others: DataFrame | None = None,
        held: dict[str, int] | None = None,
        like: str | None = None,
    ) -> int:
        """Write the next version; ``held`` is its map if it has some years only."""
        done = self.versions(name)
        new = (done or [0])[-1] + 1
        self._delete_maps(name, new)  # of an attempt that died
        if held is not None:
            mark, fs = self._folder(f"{self.root}/{name}/{_map_name(new, held)}")
            fs.create(mark, True).close()
        written = self._write(name, df, self.path(name, new), "overwrite", others, like)
        self._tidy(name, [*done[-1:], new])
        return written

    def _delete_maps(self, name: str, version: int) -> None:
        for entry in self._listed(f"{self.root}/{name}"):
            if entry.startswith(f"_v{version:06d}."):
                mark, fs = self._folder(f"{self.root}/{name}/{entry}")
                fs.delete(mark, False)

    def _tidy(self, name: str, kept: Sequence[int]) -> None:
        """Remove what no kept version uses: whole older versions, or the years that newer ones have replaced."""
        used = {(v, y) for version in kept for y, v in (self._map(name, version) or {}).items()}
        older = [x for x in self._listed(f"{self.root}/{name}") if x[:1] == "v" and x[1:].isdigit()]
        for version in sorted(int(x[1:]) for x in older):
            if version >= min(kept):
                continue
            path = self.path(name, version)
            if any(v == version for v, _ in used):
                # the mark first: from here on this is no table, but a place of years
                gone = ["_SUCCESS", *(f"{YEAR}={y}" for y in self._years_in(path) if (version, y) not in used)]
                gone = [f"{path}/{x}" for x in gone]
            else:
                gone = [path]
            for x in gone:
                folder, fs = self._folder(x)
                fs.delete(folder, True)
            self._delete_maps(name, version)

    def _partitioned(self, name: str, df: DataFrame) -> DataFrame:
        schema, _ = TABLES[name]
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        return typed if name in WEEK_PARTITIONED else typed.withColumn(YEAR, F.substring(WEEK, 1, 4))

    def _write(
        self,
        name: str,
        df: DataFrame,
        path: str,
        mode: str,
        others: DataFrame | None = None,
        like: str | None = None,
    ) -> int:
        rows = Observation()
        out = self._partitioned(name, df).observe(rows, F.count("*").alias("n"))
        if others is not None:
            out = out.unionByName(self._partitioned(name, others))
        if like is None or self.in_pieces(like):
            # few files per partition, and several tasks for one too large for a single task
            out = out.hint("rebalance", _partition(name))
        # the rows are counted by the tasks that write them
        out.write.mode(mode).partitionBy(_partition(name)).parquet(path)
        return observed_rows(rows)

    def insert_stories(
        self,
        stories: DataFrame,
        order: Sequence[str | Column] | None = None,
        fetched_at: Column | None = None,
    ) -> int:
        """Append the stories whose id is new; returns how many.

        A stored story always wins.  Among rows of one id in the batch the first
        by ``order`` wins, and what remains tied by the other columns.  By default
        that is the order in which parsed hits were found, else that of their dates.
        """
        if order is None:
            order = (ARRIVAL,) if ARRIVAL in stories.columns else ("created_at",)
        stamp = F.current_timestamp().cast("timestamp_ntz") if fetched_at is None else fetched_at
        known = self.ids.begin(self.read("raw_stories"))
        first = known.isEmpty()
        # a first load meets no ids, so it need not lie in their few buckets
        dealt = stories.repartition("story_id") if first else self.ids.dealt(stories)
        new = first_per_key(dealt, ["story_id"], [*order, *_tie_break(stories, order)])
        if not first:
            new = not_yet_stored(new, known, ["story_id"])
        written = self.append(
            "raw_stories",
            new.withColumn("score", F.coalesce("score", F.lit(0)))
            .withColumn("num_comments", F.coalesce("num_comments", F.lit(0)))
            .withColumn("fetched_at", stamp),
        )
        if written and first:
            # where nothing was stored the stories are this load, without its copies
            self.ids.append(self.read("raw_stories"))
        elif written:
            self.ids.append(not_yet_stored(stories.select("story_id").distinct(), known, ["story_id"]))
        self.ids.end()
        return written

    def insert_terms(self, terms: DataFrame) -> int:
        """Append the emerging terms whose (term, week) is new; returns how many."""
        key = ["term", "iso_week"]
        new = first_per_key(terms, key, [F.desc("tfidf_score")])
        return self.append(
            "emerging_terms", not_yet_stored(new, self.read("emerging_terms"), key)
        )


def observed_rows(rows: Observation, name: str = "n") -> int:
    """A count that a finished write has observed."""
    try:
        return rows.get[name]
    except Py4JJavaError as error:
        # adaptive execution removes the counter with the rest of an empty plan,
        # and there is no row of counts to convert
        if "PythonSQLUtils.toPyRow" not in str(error):
            raise
        return 0


def _tie_break(df: DataFrame, order: Sequence[str | Column]) -> list[str]:
    named = {o for o in order if isinstance(o, str)}
    return [c for c in df.columns if c not in named and c != "story_id"]


def _map_name(version: int, held: dict[str, int]) -> str:
    return f"_v{version:06d}." + ".".join(f"{year}-{v}" for year, v in sorted(held.items()))


def _partition(name: str) -> str:
    return WEEK if name in WEEK_PARTITIONED else YEAR


def _with_year(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(YEAR, T.StringType())])
