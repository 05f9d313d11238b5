"""Exact de-duplication with composable polynomial fingerprints.

A text without white space, as bytes, is a number in base R modulo two primes. Chunks are hashed side by side, and two
pieces combine by length-shifted arithmetic: H(ab) = H(a) * R ** len(b) + H(b). A text of up to `dealt_from` bytes is
hashed by the task that reads it, chunk by chunk. A longer one is cut into rows of `piece` bytes, which are dealt out to
all tasks, hashed and shifted by the bytes that follow them; the sums of a text's pieces are its fingerprint, in any order.
Its SHA-256, a column of the result, is taken by the task that cuts it, as that hash does not combine.
Texts of equal length and fingerprint are then compared with one of them chunk by chunk, long ones piece by piece where
the pieces lie; whatever differs forms groups of its own by its SHA-256, so a collision never joins texts.

Defined cases: null counts as the empty text; empty texts are equal to each other; of equal texts the row with the most
code points, then the smallest id (null last), then the first row stays; repeated rows are copies of each other; other
columns play no part. Nothing is gathered per group: groups are aggregated and joined, and a large group is split by
adaptive execution.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risewatch.llm.shared import SLICE, SPACES, map_batches, settle, with_row, without_rows

CHUNK = 4096
PRIMES = np.array([2147483647, 2147483629], np.uint64)
BASES = (911382323, 972663749)
COMPARE_CHUNK = 1 << 16
#: Bytes above which a text's pieces are dealt out, and bytes of a piece. Results do not depend on either.
DEALT_FROM, PIECE = 8 << 20, 1 << 20
PRINTS = "row long, doc_id long, points long, length long, print long, sha string, packed binary"
PIECES = "at int, behind long, piece binary"


def _powers() -> np.ndarray:
    out = np.ones((CHUNK + 1, 2), np.uint64)
    for i in range(1, CHUNK + 1):
        out[i] = [int(out[i - 1][j]) * BASES[j] % int(PRIMES[j]) for j in range(2)]
    return out


_POWERS = _powers()
_FALLING = _POWERS[:CHUNK][::-1].astype(np.float64)  # of the first to the last byte of a chunk


def combine(left: tuple[int, int], right: tuple[int, int], right_length: int) -> tuple[int, int]:
    """Fingerprint of left followed by right."""
    return tuple((a * pow(r, right_length, int(p)) + b) % int(p) for a, b, r, p in zip(left, right, BASES, PRIMES, strict=True))


def fingerprint(data: bytes) -> tuple[int, int]:
    """Chunks are hashed as the rows of a matrix (sums below 2 ** 52 are exact in doubles) and combined from the left."""
    values = np.frombuffer(data, np.uint8)
    full = len(values) // CHUNK
    out = (0, 0)
    for at in range(0, full, 256):
        rows = values[at * CHUNK : min(at + 256, full) * CHUNK].reshape(-1, CHUNK).astype(np.float64) @ _FALLING
        for a, b in (rows.astype(np.uint64) % PRIMES).tolist():
            shift = _POWERS[CHUNK].tolist()
            out = ((out[0] * shift[0] + a) % int(PRIMES[0]), (out[1] * shift[1] + b) % int(PRIMES[1]))
    if rest := len(values) - full * CHUNK:
        tail = (values[full * CHUNK :].astype(np.float64) @ _FALLING[CHUNK - rest :]).astype(np.uint64) % PRIMES
        out = combine(out, (int(tail[0]), int(tail[1])), rest)
    return out


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, SPACES.encode())


def _print_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    pack = zstandard.ZstdCompressor(level=1).compress
    points, lengths, prints, digests, packed = [], [], [], [], []
    for text in batch.column(2).to_pylist():
        data = normalised(text)
        a, b = fingerprint(data)
        points.append(len(text or ""))
        lengths.append(len(data))
        prints.append(a << 31 | b)
        digests.append(hashlib.sha256(data).hexdigest())
        packed.append(pack(data))
    return pa.record_batch([batch.column(0), batch.column(1), pa.array(points, pa.int64()), pa.array(lengths, pa.int64()), pa.array(prints, pa.int64()), pa.array(digests), pa.array(packed, pa.binary())], names=["row", "doc_id", "points", "length", "print", "sha", "packed"])


def _printer(dealt_from: int, piece: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of PRINTS, PIECES: one per text, and one per piece of a long text, whose own row has no print and no packed copy."""
    prints, schema = _print_batch, pa.schema(
        [(x, pa.int64()) for x in ("row", "doc_id", "points", "length", "print")]
        + [("sha", pa.string()), ("packed", pa.binary()), ("at", pa.int32()), ("behind", pa.int64()), ("piece", pa.binary())]
    )

    def rows(**values) -> pa.RecordBatch:
        return pa.record_batch([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

    def whole(part: pa.RecordBatch) -> pa.RecordBatch:
        out = prints(part)
        return pa.record_batch([*out.columns, *(pa.nulls(out.num_rows, schema.field(x).type) for x in ("at", "behind", "piece"))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                long = pc.fill_null(pc.greater(pc.binary_length(part.column(2)), dealt_from), False)
                yield whole(part.filter(pc.invert(long)))
                for i in np.flatnonzero(long.to_numpy(zero_copy_only=False)).tolist():
                    text = part.column(2)[i].as_py()
                    data, row, doc_id = normalised(text), part.column(0)[i].as_py(), part.column(1)[i].as_py()
                    if len(data) <= dealt_from:
                        yield whole(part.slice(i, 1))
                        continue
                    yield rows(row=row, doc_id=doc_id, points=len(text), length=len(data), sha=hashlib.sha256(data).hexdigest())
                    for at in range(0, len(data), piece):
                        cut = data[at : at + piece]
                        yield rows(row=row, at=at // piece, behind=len(data) - at - len(cut), piece=cut)

    return run


def _shifted_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """What each piece adds to its text's fingerprint: its own, shifted by the bytes behind it."""
    found = [combine(fingerprint(x), (0, 0), n) for n, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
    return pa.record_batch([batch.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["row", "a", "b"])


def _long_prints(heads: DataFrame, pieces: DataFrame) -> DataFrame:
    """The rows of long texts with the fingerprints of their pieces; sums of numbers below 2 ** 31 fit for 2 ** 32 pieces."""
    mod = lambda name, i: F.sum(name) % int(PRIMES[i])
    shifted = map_batches(pieces.select("row", "behind", "piece"), _shifted_batch, "row long, a long, b long")
    sums = shifted.groupBy("row").agg((F.shiftleft(mod("a", 0), 31).bitwiseOR(mod("b", 1))).alias("sum"))
    return heads.join(sums, "row").withColumn("print", F.col("sum")).drop("sum")


def _long_differing(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """row, other (its SHA-256) of the long texts of which a piece differs from that of the text they are compared with."""
    mine = pairs.select("row", "sha", "first").join(pieces.select("row", "at", "piece"), "row")
    theirs = pieces.select(F.col("row").alias("first"), "at", F.col("piece").alias("first_piece"))
    return mine.join(theirs, ["first", "at"]).where("piece <> first_piece").select("row", F.col("sha").alias("other")).distinct()


def _same(one: bytes, other: bytes) -> bool:
    """Both streams are unpacked and compared a chunk at a time."""
    unpack = zstandard.ZstdDecompressor()
    with unpack.stream_reader(one) as a, unpack.stream_reader(other) as b:
        while True:
            x, y = a.read(COMPARE_CHUNK), b.read(COMPARE_CHUNK)
            if x != y:
                return False
            if not x:
                return True


def _compare_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
    differs = pa.array([not (a == b or _same(a, b)) for a, b in pairs])
    return pa.record_batch([batch.column(0), batch.column(1)], names=["row", "other"]).filter(differs)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    dealt_from: int = DEALT_FROM,
    piece: int = PIECE,
) -> DataFrame:
    """row, doc_id, keep_row, keep_id, group_size, kept, text_sha256 of every row; row is row_col, or a number given here."""
    key = row_col or "_row"
    rows = (docs if row_col else with_row(docs, key)).select(F.col(key).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    stored = settle(rows.mapInArrow(_printer(dealt_from, piece), f"{PRINTS}, {PIECES}"))
    prints = stored.where("at is null").drop("at", "behind", "piece")
    pieces = stored.where("at is not null").select("row", "at", "behind", "piece")
    some_long = not pieces.isEmpty()
    if some_long:
        pieces = settle(pieces.repartition("row", "at"))  # dealt out evenly, whichever task cut them
        long = settle(_long_prints(prints.where("print is null"), pieces).select(*prints.columns))
        prints = prints.where("print is not null").unionByName(long)

    shared = prints.groupBy("length", "print").agg(F.count("*").alias("n"), F.min("row").alias("first")).where("n > 1")
    firsts = prints.select("row", F.col("packed").alias("first_packed"))
    firsts = firsts.join(shared.select("length", "print", F.col("first").alias("row")), "row")
    pairs = prints.select("row", "sha", "packed", "length", "print")
    pairs = pairs.join(firsts.select("length", "print", "first_packed", F.col("row").alias("first")), ["length", "print"]).where("row <> first")
    differing = map_batches(pairs.select("row", "sha", "packed", "first_packed"), _compare_batch, "row long, other string")
    if some_long:  # of equal length, so both are long or neither
        differing = differing.union(_long_differing(pairs.where("packed is null"), pieces))
    differing = settle(differing)

    narrow = prints.drop("packed").join(differing, "row", "left").withColumn("other", F.coalesce("other", F.lit("")))
    best = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    # stored, so that both sides of the join are shuffled for it and a large group can be split there
    groups = settle(narrow.groupBy("length", "print", "other").agg(F.count("*").alias("group_size"), F.min(best).alias("best")))
    return narrow.join(groups, ["length", "print", "other"]).select(
        "row", "doc_id", F.col("best.row").alias("keep_row"), F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def exact_deduplicated(docs: DataFrame) -> DataFrame:
    """docs without the rows that are copies of the row that stays."""
    return without_rows(docs, lambda stored, key: exact_groups(stored, row_col=key).where("not kept").select("row"))
