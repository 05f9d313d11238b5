"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records uniformly into buckets by a seeded hash; the number of buckets follows from the bytes, so that
one bucket fits a task. Pass 2 gives each bucket a Fisher-Yates permutation seeded by (seed, bucket) and writes it. The
buckets in order are one random order of the whole table, which is cut into shards of equal row counts (at most one apart):
law `rows`. A task keeps the permutation (8 bytes per row) and one Arrow batch, never the bucket's texts.

Defined cases: a null text has no bytes; rows with equal id and text stay distinct rows with their own slots
(they share a bucket; rows that share only an id, or have none, do not); with fewer
rows than shards some shards are empty; other columns are carried along, but for columns named shard or slot, which the
new ones replace.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risewatch.llm.shared import running_total

BUCKET_BYTES = 32 << 20
ROW_BYTES = 16


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of 0..n-1: Generator.permutation is a Fisher-Yates shuffle of the index array."""
    return np.random.Generator(np.random.PCG64([seed, bucket])).permutation(n)


def shuffle_shards(docs: DataFrame, n_shards: int, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs with shard (0 to n_shards - 1) and slot (position in the shard, gapless from 0), sorted by both in each bucket.

    The same rows and seed give the same result whatever the partitions, as rows are ordered by hash before the permutation.
    """
    text, record = F.coalesce(F.col(text_col), F.lit("")), F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    weigh = docs.select((F.octet_length(text) + ROW_BYTES).alias("b")).agg(F.count("*"), F.sum("b")).first()
    n_rows, n_bytes = weigh[0], weigh[1] or 0
    n_buckets = max(1, -(-n_bytes // bucket_bytes))
    mixed = docs.select(record.alias("record"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("mix"), F.xxhash64(text).alias("tie"))
    mixed = mixed.withColumn("bucket", F.pmod(F.xxhash64("mix"), F.lit(n_buckets)))
    counts = mixed.groupBy("bucket").agg(F.count("*").alias("in_bucket"))
    counts = running_total(counts, F.col("bucket"), "in_bucket", "offset")

    # Texts cross the network once, by bucket; the table of buckets joins them there.
    scattered = mixed.repartition(max(1, n_buckets), "bucket").join(counts.hint("shuffle_hash"), "bucket")
    ordered = scattered.sortWithinPartitions("bucket", "mix", "tie").select("bucket", "in_bucket", "offset", "record")
    schema = T.StructType([ordered.schema["record"], T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, at, order = None, 0, np.zeros(0, np.int64)
        for batch in batches:
            numbers, sizes, offsets = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            place = np.zeros(batch.num_rows, np.int64)
            starts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for a, b in zip(starts, starts[1:], strict=False):
                if numbers[a] != bucket:
                    bucket, at, order = numbers[a], 0, fisher_yates(int(sizes[a]), seed, int(numbers[a]))
                place[a:b] = offsets[a] + order[at : at + b - a]
                at += b - a
            # a * b // n without overflow: places and shard counts stay far below 2 ** 62
            shard = place * n_shards // max(n_rows, 1)
            first = -(-shard * n_rows // n_shards)
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], pa.array(shard.astype(np.int32)), pa.array(place - first)], names=schema.names)

    kept = [F.col(f"record.`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    return ordered.mapInArrow(permute, schema).select(*kept, "shard", "slot")


def write_shards(docs: DataFrame, path: str, n_shards: int, **kind) -> None:
    """One folder per shard, its files sorted by slot. Only rows of neighbouring buckets meet in a shard."""
    shuffle_shards(docs, n_shards, **kind).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
