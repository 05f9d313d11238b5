"""Helpers of the operators in this folder: shared scratch tables, table access, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

#: White space of the contracts: these six characters and no others.
SPACES = " \t\n\x0b\x0c\r"
SLICE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder: spark.checkpoint.dir, or the session's warehouse where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    root = shared or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not shared and root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return root


def settle(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """The same rows, written once to the shared folder and read back: cuts the lineage and survives lost executors.

    The folder is deleted when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = _scratch_path(spark)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_by(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """settle, in buckets of a key: a join on the key alone moves its other side only. A task that writes makes a file a bucket."""
    spark = df.sparkSession
    name = f"risewatch_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", _scratch_path(spark)).option("compression", "snappy").bucketBy(buckets, key).saveAsTable(name)
    stored = spark.table(name)
    # the catalogue forgets the name; the frame knows the files, which stay
    spark.sql(f"DROP TABLE {name}")
    return stored


def _scratch_path(spark: SparkSession) -> str:
    path = f"{scratch_root(spark)}/risewatch-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def with_row(docs: DataFrame, name: str = "row") -> DataFrame:
    """Adds a row number for a single read: splits, and so the numbers, follow the executors alive when a read is planned."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def numbered(docs: DataFrame, name: str = "row") -> DataFrame:
    """docs with a row number, written once: every later read finds the same numbers, whatever its splits are."""
    return settle(with_row(docs, name), "zstd")


def without_rows(docs: DataFrame, dropped: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """docs without the rows whose numbers dropped(stored docs, name of their number) gives as column row, with docs' columns.

    Both see the same stored numbers. Texts are shuffled only if the planner finds the dropped rows too many to send to
    every task.
    """
    key = "_row_" + uuid.uuid4().hex[:8]
    stored = numbered(docs, key)
    gone = dropped(stored, key).select(F.col("row").alias(key))
    return stored.join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_others(docs: DataFrame, groups: Callable[[DataFrame, str], DataFrame], id_col: str = "doc_id") -> DataFrame:
    """One row of docs for each group, with docs' columns and without a stored copy of docs.

    groups(docs with a key, name of the key) gives row (the key), doc_id, keep_row and keep_id (key and id of the row that
    stays). The key is a hash of all columns, so every read finds the same one; with the id it tells rows apart. Rows that
    are alike in all columns share it: where such rows stay, one of them does.
    """
    key = "_key_" + uuid.uuid4().hex[:8]
    plain = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (MapType, VariantType))]
    marked = docs.withColumn(key, F.xxhash64(*plain))
    found = settle(groups(marked, key).select("row", F.col("doc_id").alias("id"), "keep_row", "keep_id"))
    stays = (F.col("row") == F.col("keep_row")) & F.col("id").eqNullSafe(F.col("keep_id"))
    often = settle(found.where(stays).groupBy("row", "id").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    gone = settle(found.where(~stays).select("row", "id").distinct())
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def beside(rows: DataFrame, kind: str) -> DataFrame:
        rows = rows.select(F.col("row").alias(key + "r"), F.col("id").alias(key + "i"))
        same = (F.col(key) == F.col(key + "r")) & F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(key + "i"))
        return marked.join(rows, same, kind)

    if often.isEmpty():
        return beside(gone, "left_anti").select(*columns)
    alike = beside(often, "left_semi").groupBy(key, F.col(f"`{id_col}`").alias(key + "id")).agg(F.first(F.struct(*columns)).alias(key + "row"))
    return beside(gone.union(often), "left_anti").select(*columns).union(alike.select(f"{key}row.*"))


def map_batches(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow of a function from batch to batch, SLICE rows at a time, so that few texts are Python objects at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                yield each(batch.slice(at, SLICE))

    return df.mapInArrow(run, schema)


#: A-Z in lower case, other ASCII but letters as blanks, bytes of other characters as they are.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
PIECE = 1 << 20


def token_lists(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a list for each piece of about PIECE bytes; pieces end between terms."""
    low = data.translate(TERM_BYTES)
    at = 0
    while len(low) - at > PIECE:
        end = low.rfind(b" ", at, at + PIECE)
        end = end if end > at else low.find(b" ", at + PIECE)
        if end < 0:
            break
        yield low[at:end].split()
        at = end
    yield low[at:].split()


def running_total(df: DataFrame, order: Column, value: str, name: str) -> DataFrame:
    """Adds the sum of `value` over all rows before this one; for tables of bins or sources, not of documents."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links of one task, each node linked to its root; memory is at most that task's links."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top and x != top:
            parent[x], x = top, up
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
            else:
                parent.setdefault(x, x)
    nodes = [x for x in parent if root(x) != x]
    for k in range(0, len(nodes), 100_000):
        part = nodes[k : k + 100_000]
        yield pa.record_batch([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a long, b long): one row (node, root) for each node that is not the least of its component.

    Each task first reduces its links to a forest; then large-star and small-star rounds (minimum label over neighbours,
    alternately towards larger and smaller nodes) until nothing changes, each round written to shared storage. A round
    moves one row per link; no node's links are gathered in one place.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges = settle(edges.mapInArrow(_forest, "a long, b long").distinct())
    state = None
    while True:
        new = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum((F.xxhash64("b", "a") % 1_000_003).cast("long"))).first()
        if new == state or not new[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = new
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        # stored, so that both sides of the join are shuffled for it and a node with many neighbours can be split there
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = settle(small.select("e.a", "e.b").where("a <> b").distinct())
