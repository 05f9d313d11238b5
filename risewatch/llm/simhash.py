"""Near-duplicates by SimHash, linked by meet-in-the-middle ball hashing.

Fingerprints at most 3 bits apart have a point between them that is at most 1 bit from one and 2 from the other. So
fingerprints emit the points of a ball around them, the points are shuffled, and fingerprints that meet in a point are
linked. Three savings lose no pair. (1) Equal fingerprints are one node. (2) An odd distance joins an even and an odd
number of set bits, so at points with an even number the even side stands 0 or 2 bits away and the odd side 1 bit away:
only even fingerprints emit two-bit variants. (3) Of three differing bits two lie in the same half of the word, so
two-bit variants within a half are enough (992 of 2,016); a distance of 2 is met by one-bit variants. On average 560
points for a fingerprint.

In a point, those at most 1 bit away are within 3 bits of all others there, so linking all to one of them gives the same
components as all pairs would. The links are verified. At most 2,081 fingerprints can meet in one point, however large the
group of near copies.

Defined cases: null counts as empty; texts without words have fingerprint 0 and are linked like any other; with fewer
words than a shingle the whole sequence is one shingle; repeated rows share a fingerprint; null ids are ignored as
component names unless a component has no other; other columns play no part.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risewatch.llm.shared import components, map_batches, settle, with_row, without_others

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Points a bucket of the shuffle holds on average (10 bytes each): fixes the number of buckets.
BUCKET_POINTS = 1_000_000
BLOCK = 1024
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle, repeats included; shingles are slices of the words joined by single spaces."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    starts = np.concatenate(([0], np.cumsum(lengths)))
    ends = (starts[size:] - 1).tolist()
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(ends)].tolist(), ends, strict=True)], np.uint64)


def simhash(text: str | None, size: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _print_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    prints = np.array([simhash(x) for x in batch.column(2).to_pylist()], np.uint64).view(np.int64)
    return pa.record_batch([batch.column(0), batch.column(1), pa.array(prints)], names=["row", "doc_id", "print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """row (row_col, or a number given here), doc_id, print (the unsigned fingerprint's bits as a long)."""
    key = row_col or "_row"
    rows = (docs if row_col else with_row(docs, key)).select(F.col(key).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, _print_batch, "row long, doc_id long, print long")


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


_ONE = np.uint64(1) << np.arange(64, dtype=np.uint64)
_FIRST, _SECOND = (np.concatenate([np.triu_indices(32, 1)[i], np.triu_indices(32, 1)[i] + 32]) for i in (0, 1))
_TWO = _ONE[_FIRST] | _ONE[_SECOND]
#: Flips by number: none, one bit, two bits of the same half. A point and a flip number give the fingerprint back.
FLIPS = np.concatenate([np.zeros(1, np.uint64), _ONE, _TWO])
_NEAR = 65  # flips of at most one bit have lower numbers


def ball(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points and flip numbers that these fingerprints emit."""
    even = prints[_bits(prints) % 2 == 0]
    odd = prints[_bits(prints) % 2 == 1]
    points = np.concatenate([(even[:, None] ^ FLIPS[None, :]).ravel(), (odd[:, None] ^ FLIPS[None, 1:_NEAR]).ravel()])
    flips = np.concatenate([np.tile(np.arange(len(FLIPS), dtype=np.uint16), len(even)), np.tile(np.arange(1, _NEAR, dtype=np.uint16), len(odd))])
    return points, flips


def _spread(points: np.ndarray) -> np.ndarray:
    x = (points ^ (points >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(32)


def meet(points: np.ndarray, flips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, hub) of the fingerprints that meet in these points."""
    order = np.argsort(points, kind="stable")
    points, flips = points[order], flips[order]
    same = np.flatnonzero(points[1:] == points[:-1])
    if not len(same):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    met = np.unique(np.concatenate([same, same + 1]))
    points, flips = points[met], flips[met]
    owners = points ^ FLIPS[flips]
    order = np.lexsort((owners, flips >= _NEAR, points))  # in a point those nearest come first
    points, flips, owners = points[order], flips[order], owners[order]
    first = np.concatenate(([True], points[1:] != points[:-1]))
    lead = np.maximum.accumulate(np.where(first, np.arange(len(points)), 0))
    hub, linked = owners[lead], (flips[lead] < _NEAR) & (owners != owners[lead])
    linked &= _bits(owners ^ hub) <= RADIUS
    return owners[linked], hub[linked]


def near_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints (column print, distinct) within RADIUS bits."""
    n_nodes = nodes.count()
    n_points = n_nodes * 560
    n_buckets = max(8, -(-n_points // BUCKET_POINTS))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(prints), BLOCK):
                points, flips = ball(prints[at : at + BLOCK])
                bucket = (_spread(points) % np.uint64(n_buckets)).astype(np.uint32)
                order = np.argsort(bucket, kind="stable")
                numbers, starts = np.unique(bucket[order], return_index=True)
                points, flips = points[order], flips[order]
                ends = [*starts[1:].tolist(), len(points)]
                packed = [(points[a:b].tobytes(), flips[a:b].tobytes()) for a, b in zip(starts.tolist(), ends, strict=True)]
                yield pa.record_batch([pa.array(numbers.astype(np.int64)), pa.array([x for x, _ in packed], pa.binary()), pa.array([y for _, y in packed], pa.binary())], names=["bucket", "points", "flips"])

    def links(group: pa.Table) -> pa.Table:
        points = np.frombuffer(b"".join(group.column("points").to_pylist()), np.uint64)
        flips = np.frombuffer(b"".join(group.column("flips").to_pylist()), np.uint16)
        a, b = meet(points, flips)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    spread = nodes.select("print").repartition(max(8, n_nodes // (4 * BLOCK)))
    emitted = spread.mapInArrow(emit, "bucket long, points binary, flips binary")
    return emitted.groupBy("bucket").applyInArrow(links, "a long, b long")


def near_groups(docs: DataFrame, **columns: str) -> DataFrame:
    """row, doc_id, print, component_id (smallest id of the component), keep_row (its first row with that id)."""
    prints = settle(fingerprints(docs, **columns))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), F.col("row").alias("row"))).alias("least")
    nodes = settle(prints.groupBy("print").agg(least))
    roots = components(near_links(nodes))
    rooted = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    best = rooted.groupBy("root").agg(F.min("least").alias("best"))
    named = rooted.join(best, "root").select("print", F.col("best.id").alias("component_id"), F.col("best.row").alias("keep_row"))
    return prints.join(named, "print").select("row", "doc_id", "print", "component_id", "keep_row")


def near_deduplicated(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: the one with the smallest id (null last), then with the smallest hash of its columns."""
    return without_others(docs, lambda marked, key: near_groups(marked, row_col=key).withColumnRenamed("component_id", "keep_id"))
