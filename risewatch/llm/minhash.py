"""Near-duplicates by MinHash: many universal hash minima, bands, verified links, components by large-star and small-star.

A document's set are the hashes of its distinct shingles. Documents with equal sets are one node. A node's signature are
the least values of BANDS * ROWS universal hashes (multiply and add modulo 2 ** 64, upper half kept); nodes that agree on
all rows of a band meet in a bucket. At similarity 0.85 a pair meets in no bucket with a probability below 1e-10.

No bucket is expanded into its pairs. First each bucket sends its members to one of them, the pivot: the member with the
largest buckets, as the text that all copies come from has. Pairs whose signatures agree in fewer than LEAST_EQUAL places are
left out (eight standard deviations below what 0.85 gives), the others are confirmed on full sets, and the links give
components. Members of a bucket that are in one component need no more comparing. In the buckets that are left with
several components, the members outside the largest one are compared with all others, in blocks of CHUNK members, each
pair in the first bucket that both share: by signature, and what agrees on full sets at once. A block gives out only links
that join two components, so never more than it has members. Buckets with the same members count as one.

Defined cases: null and blank texts have empty sets and are linked with nothing; with fewer words than a shingle the
whole sequence is the one shingle; repeated rows have equal sets; null ids name a component only if it has no other; a row
is kept if its id is the component's, null and null being equal; other columns play no part.

Memory: a text and its set; a block of two times CHUNK signatures and sets; a pair of sets. Sets are made and stored only of nodes
that share a bucket, one text for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risewatch.llm.shared import components, map_batches, settle
from risewatch.llm.simhash import shingle_hashes

SHINGLE, PERCENT = 5, 85
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
LEAST_EQUAL = int(HASHES * PERCENT / 100 - 8 * (HASHES * PERCENT * (100 - PERCENT)) ** 0.5 / 100)
CHUNK = 1024
BLOCK = 256  # a block of hashes times shingles stays in a core's cache
_RANDOM = np.random.default_rng(11)
_TIMES = _RANDOM.integers(0, 1 << 31, (HASHES, 1), np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RANDOM.integers(0, 1 << 32, (HASHES, 1), np.uint32)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    return np.unique(shingle_hashes(text, SHINGLE))


def signature(hashes: np.ndarray) -> np.ndarray:
    keys = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    space = np.empty((HASHES, min(BLOCK, len(keys))), np.uint32)
    for at in range(0, len(keys), BLOCK):
        part = keys[at : at + BLOCK]
        found = space[:, : len(part)]
        np.multiply(_TIMES, part, out=found)
        np.add(found, _PLUS, out=found)
        np.minimum(least, found.min(axis=1), out=least)
    return least.astype("<u2")


def _sign_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes, digests, signatures = [], [], []
    for text in batch.column(1).to_pylist():
        hashes = shingle_set(text)
        sizes.append(len(hashes))
        digests.append(xxhash.xxh128_digest(hashes.tobytes()) if len(hashes) else None)
        signatures.append(signature(hashes).tobytes() if len(hashes) else None)
    return pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary()), batch.column(2), batch.column(3)], names=["doc_id", "size", "digest", "signature", "t1", "t2"])


def _set_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingle_set(text).tobytes() for text in batch.column(1).to_pylist()]
    return pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["node", "hashes"])


def _band_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row for each band: node, band, bucket (a hash of the band's number and values)."""
    nodes, bands, buckets = [], [], []
    width = ROWS * 2
    for node, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        nodes += [node] * BANDS
        bands += range(BANDS)
        buckets += [xxhash.xxh64_intdigest(data[b * width : (b + 1) * width], b) for b in range(BANDS)]
    return pa.record_batch([pa.array(nodes, pa.int64()), pa.array(bands, pa.int32()), pa.array(np.array(buckets, np.uint64).view(np.int64))], names=["node", "band", "bucket"])


def _text_keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def _agree_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The pairs (a, b, one, two) whose signatures agree in LEAST_EQUAL places."""
    one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, HASHES) for i in (2, 3))
    alike = (one == two).sum(axis=1) >= LEAST_EQUAL
    return batch.select(["a", "b"]).filter(pa.array(alike))


def _confirm_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    alike = []
    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
        one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(one, two, assume_unique=True))
        alike.append(100 * both >= PERCENT * (len(one) + len(two) - both))
    return batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))


def _beside(pairs: DataFrame, nodes: DataFrame, value: str) -> DataFrame:
    """a, b, and the value of each."""
    one = nodes.select(F.col("node").alias("a"), F.col(value).alias("one"))
    two = nodes.select(F.col("node").alias("b"), F.col(value).alias("two"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")


def set_table(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, hashes: the full sets of these nodes (node, first), from one of their texts in docs (doc_id, text)."""
    wanted = nodes.select("node", "first.*")
    texts = docs.select("doc_id", "text", *_text_keys(F.col("text")))
    same = texts["doc_id"].eqNullSafe(wanted["id"]) & (texts["t1"] == wanted["t1"]) & (texts["t2"] == wanted["t2"])
    sets = map_batches(texts.join(wanted, same).select("node", "text"), _set_batch, "node long, hashes binary")
    return settle(sets.groupBy("node").agg(F.first("hashes").alias("hashes")))  # a node's row may be repeated


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are similar by their full sets."""
    return settle(map_batches(_beside(pairs, sets, "hashes"), _confirm_batch, "a long, b long"))


def _links(rows: list[tuple]) -> Iterator[tuple[int, int]]:
    """Links between components of one block, at most one fewer than it has components.

    rows: node, root, asks (0: of the largest component, which never asks; 1: asks; 2: one that is asked and asks elsewhere),
    band, signature, hashes.
    """
    node, root, asks = (np.array([x[i] for x in rows], np.int64) for i in range(3))
    signs = np.frombuffer(b"".join(x[4] for x in rows), "<u2").reshape(-1, HASHES)
    sets = [np.frombuffer(x[5], np.uint64) for x in rows]
    sizes = np.array([len(x) for x in sets])
    others = np.flatnonzero(asks != 1)
    for i in np.flatnonzero(asks == 1):
        at = others[root[others] != root[i]]
        at = at[(asks[at] == 0) | (node[at] > node[i])]
        same = signs[at] == signs[i]
        fine = same.sum(axis=1) >= LEAST_EQUAL
        at, same = at[fine], same[fine]
        at = at[same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == rows[0][3]] if len(at) else at
        if not len(at):
            continue
        own, flat = sets[i], np.concatenate([sets[k] for k in at])
        found = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
        both = np.add.reduceat(found, np.concatenate(([0], np.cumsum(sizes[at])[:-1])), dtype=np.int64)
        for k in at[100 * both >= PERCENT * (sizes[i] + sizes[at] - both)]:
            if root[k] != root[i]:
                yield int(node[i]), int(node[k])
                root[root == root[k]] = root[i]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of each block of rows sorted by (bucket, low, high)."""
    now, held = None, []

    def close() -> pa.RecordBatch:
        found = list(_links(held))
        return pa.record_batch([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for key, row in zip(zip(*columns[:3], strict=True), zip(*columns[3:], strict=True), strict=True):
            if key != now:
                if held:
                    yield close()
                held, now = [], key
            held.append(row)
    if held:
        yield close()


def crossing(members: DataFrame, nodes: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a, b) between components by pairs that share a bucket; sets: the full sets of the nodes."""
    rooted = members.join(roots, "node", "left").select("bucket", "band", "node", F.coalesce("root", "node").alias("root"))
    marks = [F.min("node").alias("first"), F.max("node").alias("last"), F.bit_xor(F.xxhash64("node")).alias("mark"), F.min("band").alias("band")]
    sizes = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"), *marks)
    largest = F.max(F.struct("n", "root")).alias("largest")
    marks = [F.min("first").alias("first"), F.max("last").alias("last"), F.bit_xor("mark").alias("mark"), F.min("band").alias("band")]
    mixed = sizes.groupBy("bucket").agg(largest, F.sum("n").alias("n"), F.count("*").alias("roots"), *marks).where("roots > 1")
    # of buckets with the same members the first band's stays: it is the first that any two of them share
    mixed = mixed.groupBy("n", "first", "last", "mark", "largest").agg(F.min(F.struct("band", "bucket"))["bucket"].alias("bucket"))
    mixed = settle(mixed.select("bucket", F.col("largest.root").alias("main"), F.ceil(F.col("n") / CHUNK).alias("parts"), F.ceil((F.col("n") - F.col("largest.n")) / CHUNK).alias("askers")))
    rows = rooted.join(mixed, "bucket").withColumn("stray", F.col("root") != F.col("main"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), "parts")).withColumn("own_ask", F.pmod(F.xxhash64("node"), "askers"))
    all_of = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    # as one that is asked: in the blocks of every part of askers; as one that asks: in those of every part of members
    asked = rows.select("*", F.explode(all_of("askers")).alias("low"), F.col("own").alias("high"), F.when(F.col("stray"), 2).otherwise(0).alias("asks"))
    asking = rows.where("stray").select("*", F.col("own_ask").alias("low"), F.explode(all_of("parts")).alias("high"), F.lit(1).alias("asks"))
    blocks = asked.union(asking).join(nodes.select("node", "signature").join(sets, "node"), "node")
    blocks = blocks.select("bucket", "low", "high", "node", "root", "asks", "band", "signature", "hashes")
    blocks = blocks.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return blocks.mapInArrow(_compare, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of the component), kept."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = map_batches(docs.select("doc_id", "text", *_text_keys(F.col("text"))), _sign_batch, "doc_id long, size long, digest binary, signature binary, t1 long, t2 long")
    rows = settle(rows)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), "t1", "t2")).alias("first")
    nodes = rows.where("digest is not null").groupBy("digest").agg(first, F.first("signature").alias("signature"))
    nodes = settle(nodes.withColumn("node", F.monotonically_increasing_id()))  # stored once: numbers stay

    spread = settle(map_batches(nodes.select("node", "signature"), _band_batch, "node long, band int, bucket long"))
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = settle(spread.join(sizes, "bucket"))
    met = settle(nodes.join(members.select("node").distinct(), "node"))
    degrees = members.groupBy("node").agg(F.sum("n").alias("degree"))
    pivots = members.join(degrees, "node").groupBy("bucket").agg(F.max(F.struct(F.col("degree").alias("d"), (-F.col("node")).alias("node"))).alias("pivot"))
    pivots = settle(pivots.select("bucket", (-F.col("pivot.node")).alias("b")))
    pairs = members.join(pivots, "bucket").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    pairs = settle(map_batches(_beside(pairs, met, "signature"), _agree_batch, "a long, b long"))
    sets = set_table(met, docs)
    roots = components(confirmed(pairs, sets))
    more = settle(crossing(members, met, sets, roots))
    if not more.isEmpty():
        roots = components(roots.toDF("a", "b").union(more))

    named = nodes.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"), "first")
    best = named.groupBy("root").agg(F.min("first").alias("best"))
    # stored, so that both sides of the join are shuffled for it and a large group can be split there
    named = settle(named.join(best, "root").select("digest", F.col("best.id").alias("component_id")))
    own = rows.where("digest is null").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    found = rows.join(named, "digest").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    return found.union(own).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
