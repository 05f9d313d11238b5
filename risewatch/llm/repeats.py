"""Removal of repeated passages by hashes of windows at anchors (winnowing), in place of distributed prefix doubling.

A rank ("name") of the string of length 2k at a position is made from the names of length k at the position and k further
on. Within a text the names of length 1, 2, 4, ..., 64 are doubled in place; from there on Spark takes over, and at each
length only positions that are not unique go on.

* Length 64, at anchors only. The anchor of a 200-byte window is the last of its 137 positions with the least name, so equal
  windows have equal anchors at equal places; an anchor owns a run of windows, 70 on average. Spark counts the names of
  anchors; unique ones are dropped.
* Up to length 336. The name of the bytes of all windows that an anchor owns. Where another anchor has the same, all of
  those windows are repeated: settled. This is the inside of copies. Of anchors that share a name but not these bytes
  (edges of passages, places of edits), one of each kind goes on, with its bytes.
* Lengths 185 and up to 215. The windows of those are cut into steps of 16: what all windows of a step share, its core,
  and what they cover together. Unique cores are dropped, repeated covers settled; of the rest one of each kind goes on.
* Length 200, at every window of the steps that go on: names that occur twice are repeated windows.

Names are 64-bit hashes, not dense ranks, so that no global order is needed; surroundings are compared by name and
surroundings (128 bits), windows by 96 bits. Texts move twice, compressed; positions move only as anchors and windows. The
numbered rows are stored once, and every later read takes their numbers from there.

Defined cases: null counts as empty; texts shorter than the length lose nothing; a text may repeat itself, overlapping
occurrences included; repeated rows are each other's copies and lose everything covered; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risewatch.llm.shared import SLICE, map_batches, numbered, settle

LENGTH, SEED_LENGTH = 200, 64
SPAN = LENGTH - SEED_LENGTH  # windows that hold an anchor start up to this far before it
#: Bytes that are named side by side: bounds the memory of a task (about 60 bytes for each).
SEGMENT = 1 << 20
_TABLE = np.random.Generator(np.random.PCG64(2024)).integers(1, 1 << 63, 256, np.uint64)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Name of two names in this order."""
    x = left * _A
    x += right * _B
    x ^= x >> np.uint64(32)
    x *= _C
    x ^= x >> np.uint64(29)
    return x


def names(data: np.ndarray) -> np.ndarray:
    """Name of the 64 bytes from each position on, by doubling."""
    out, k = _TABLE[data], 1
    while k < SEED_LENGTH:
        out = _join(out[:-k], out[k:])
        k *= 2
    return out


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best of x[i : i + width] for each i."""
    k = 1
    while 2 * k <= width:
        x = best(x[:-k], x[k:])
        k *= 2
    return best(x[: len(x) - (width - k)], x[width - k :]) if width > k else x


def _covered(name: np.ndarray, first: np.ndarray, length: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Name of the `length` bytes (64 to 384) from first on, together with a number."""
    last = first + length - SEED_LENGTH
    out = key.astype(np.uint64)
    for step in range(0, SPAN + LENGTH, SEED_LENGTH):
        out = _join(out, name[np.minimum(first + step, last)])
    return out


def _units(texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes, int]]:
    """row, bytes, where they start in the text; each window of the text is in one unit."""
    for row, data in texts:
        for a in range(0, len(data) - LENGTH + 1, SEGMENT):
            yield row, data[a : a + SEGMENT + LENGTH - 1] if len(data) > SEGMENT else data, a


def anchors(texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays row, position, most and least bytes that windows start before it, name, name of all its windows' bytes.

    Short texts are named together, long ones in pieces.
    """
    held: list[tuple[int, bytes, int]] = []
    size = 0
    for unit in _units(texts):
        if held and size + len(unit[1]) > SEGMENT:
            yield _anchors_of(held)
            held, size = [], 0
        held.append(unit)
        size += len(unit[1])
    if held:
        yield _anchors_of(held)


def _anchors_of(units: list[tuple[int, bytes, int]]) -> tuple[np.ndarray, ...]:
    ends = np.cumsum([len(x[1]) for x in units])
    begins = ends - np.array([len(x[1]) for x in units])
    name = names(np.frombuffer(b"".join(x[1] for x in units), np.uint8))
    least = _sliding(name, SPAN + 1, np.minimum)  # of the window that starts here
    whole = np.zeros(len(least), bool)
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        whole[a : b - LENGTH + 1] = True
    # runs of windows with one least name, never across texts
    cut = np.flatnonzero((least[1:] != least[:-1]) | (whole[1:] != whole[:-1])) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(least)])) - 1
    first, last = first[whole[first]], last[whole[first]]

    # where the least names are: positions that are the least of some window
    padded = np.concatenate([np.zeros(SPAN, np.uint64), np.where(whole, least, np.uint64(0)), np.zeros(SPAN, np.uint64)])
    at = np.flatnonzero(name == _sliding(padded, SPAN + 1, np.maximum)[: len(name)])
    of = name[at]

    def anchor(start: np.ndarray) -> np.ndarray:
        """The last position with the least name in the windows that start here."""
        i = np.searchsorted(at, start + SPAN, side="right") - 1
        while len(wrong := np.flatnonzero(of[i] != least[start])):
            i[wrong] -= 1
        return at[i]

    one, other = anchor(first), anchor(last)
    if len(tied := np.flatnonzero(one != other)):  # one name several times: window by window
        starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[tied].tolist(), last[tied].tolist(), strict=True)])
        picked = anchor(starts)
        cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(picked) != 0)) + 1
        alike = one == other
        one = np.concatenate([one[alike], picked[np.concatenate(([0], cut))]])
        first = np.concatenate([first[alike], starts[np.concatenate(([0], cut))]])
        last = np.concatenate([last[alike], starts[np.concatenate((cut, [len(starts)])) - 1]])
    unit = np.searchsorted(ends, one, side="right")
    row, start = (np.array([x[i] for x in units])[unit] for i in (0, 2))
    most, fewest = one - first, one - last
    return row, one - begins[unit] + start, most, fewest, name[one], _covered(name, first, last - first + LENGTH, most * 1009 + fewest)


#: Windows that start 16 k to 16 k + 15 bytes before their anchor are step k; they share CORE bytes.
STEP, PIECES = 16, 2000
CORE = LENGTH - STEP + 1


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and value, of all whole numbers from each first to its last."""
    counts = last - first + 1
    which = np.repeat(np.arange(len(first)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + first[which]


def _laid_out(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Names of the pieces laid end to end, and where each begins."""
    lengths = np.array([len(x) for x in pieces])
    return names(np.frombuffer(b"".join(pieces), np.uint8)), np.cumsum(lengths) - lengths


def steps(pieces: list[bytes], most: np.ndarray, fewest: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of anchors (all bytes of their windows): which anchor, step, name of the core, name of what its windows in the step cover."""
    name, base = _laid_out(pieces)
    which, k = _ranges(fewest // STEP, most // STEP)
    most, fewest, base = most[which], fewest[which], base[which]
    at = base + most - STEP * k
    core = _join(_join(name[at], name[at + 64]), _join(name[at + CORE - 64], k.astype(np.uint64)))
    high, low = np.minimum(most, STEP * k + STEP - 1), np.maximum(fewest, STEP * k)
    return which, k, core, _covered(name, base + most - high, high - low + LENGTH, high * 1009 + low)


def windows(pieces: list[bytes], most: np.ndarray, fewest: np.ndarray, wanted: list[list[int]]) -> tuple[np.ndarray, ...]:
    """Which anchor, start (in its bytes), names (64 and 32 bits) of the windows of the steps wanted."""
    name, base = _laid_out(pieces)
    anchor = np.repeat(np.arange(len(pieces)), [len(x) for x in wanted])
    k = np.array([x for ks in wanted for x in ks], np.int64)
    step, back = _ranges(np.maximum(fewest[anchor], STEP * k), np.minimum(most[anchor], STEP * k + STEP - 1))
    which = anchor[step]
    start = most[which] - back
    at = base[which] + start
    x = _join(_join(name[at], name[at + 64]), _join(name[at + 128], name[at + SPAN]))
    y = _join(_join(name[at + 64], name[at + SPAN]), _join(name[at], name[at + 128]))
    return which, start, x, (y >> np.uint64(33)).astype(np.int32)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        for row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            yield row, _bytes(text)


def _pack_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    pack = zstandard.ZstdCompressor(level=6).compress
    return pa.record_batch([*batch.columns[:-1], pa.array([pack(_bytes(x)) for x in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())], names=[*batch.schema.names[:-1], "packed"])


def _emit_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for found in anchors(_texts(batch)):
            yield pa.record_batch([pa.array(found[4].view(np.int64))], names=["name"])


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """place: position, most and fewest bytes before it, in one number."""
    for batch in batches:
        for row, position, most, fewest, name, cover in anchors(_texts(batch)):
            place = (position.astype(np.int64) << 16) | (most.astype(np.int64) << 8) | fewest.astype(np.int64)
            yield pa.record_batch([pa.array(c) for c in (name.view(np.int64), cover.view(np.int64), row.astype(np.int64), place)], names=["name", "cover", "row", "place"])


def _parts(place: int) -> tuple[int, int, int]:
    return place >> 16, place >> 8 & 255, place & 255


def _emit_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows, places, pieces = [], [], []
        for row, packed, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            data = unpack(packed)
            for place in found:
                position, most, fewest = _parts(place)
                rows.append(row)
                places.append(place)
                pieces.append(data[position - most : position - fewest + LENGTH])
        yield pa.record_batch([pa.array(rows, pa.int64()), pa.array(places, pa.int64()), pa.array(pieces, pa.binary())], names=["row", "place", "piece"])


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """row, place, pieces, most, fewest of a few thousand anchors at a time."""
    for at in range(0, batch.num_rows, PIECES):
        part = batch.slice(at, PIECES)
        row, place = part.column(0).to_numpy(), part.column(1).to_numpy()
        yield part, row, place, part.column(2).to_pylist(), place >> 8 & 255, place & 255


def _emit_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, row, place, pieces, most, fewest in _pieces(batch):
            which, k, core, cover = steps(pieces, most, fewest)
            yield pa.record_batch([pa.array(c) for c in (row[which], place[which], k.astype(np.int32), core.view(np.int64), cover.view(np.int64))], names=["row", "place", "step", "core", "cover"])


def _emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, row, place, pieces, most, fewest in _pieces(batch):
            which, at, one, two = windows(pieces, most, fewest, part.column(3).to_pylist())
            start = at + (place >> 16)[which] - most[which]
            yield pa.record_batch([pa.array(c) for c in (row[which], start, one.view(np.int64), two)], names=["row", "start", "one", "two"])


def _cut_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    removed, spans, digests = [], [], []
    unpack = zstandard.ZstdDecompressor().decompress
    lengths = []
    for packed, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
        data = unpack(packed)
        lengths.append(len(data))
        if not found:
            removed.append(0)
            spans.append(0)
            digests.append(hashlib.sha256(data).hexdigest())
            continue
        edges = np.array([(x["a"], x["b"]) for x in found], np.int64)
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, edges[:, 0], 1)
        np.add.at(change, edges[:, 1], -1)
        gone = np.cumsum(change[:-1]) > 0
        removed.append(int(gone.sum()))
        spans.append(int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum()))
        digests.append(hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return pa.record_batch([batch.column(1), pa.array(lengths, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _kinds(found: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of rows key, cover, row, place: those whose cover occurs again, and one of each cover where a key has several."""
    classes = settle(found.groupBy(*key, "cover").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("witness")))
    settled = found.join(classes.where("n > 1").select(*key, "cover"), [*key, "cover"], "left_semi")
    several = settle(classes.groupBy(*key).agg(F.count("*").alias("kinds")).where("kinds > 1").select(*key))
    return settled, classes.join(several, key, "left_semi").select(*key, "witness.*")


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """row, a, b: ranges of bytes whose windows are repeated; rows has row and text."""
    position, most, fewest = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(F.lit(255)), F.col("place").bitwiseAND(F.lit(255))
    long = rows.where(F.octet_length("text") >= LENGTH).select("row", "text")
    # tables of keys are stored before a join, so that both of its sides are shuffled for it and a frequent key can be split
    shared = settle(long.mapInArrow(_emit_names, "name long").groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"))
    again = settle(long.mapInArrow(_emit_anchors, "name long, cover long, row long, place long").join(shared, "name", "left_semi"))
    settled, open_ = _kinds(again, ["name"])
    ranges = settled.select("row", (position - most).alias("a"), (position - fewest + LENGTH).alias("b"))

    places = open_.groupBy("row").agg(F.collect_list("place").alias("places"))  # a text's own anchors at most
    texts = map_batches(long, _pack_batch, "row long, packed binary")
    pieces = settle(texts.join(places, "row").select("row", "packed", "places").mapInArrow(_emit_bytes, "row long, place long, piece binary"))
    of_step = settle(pieces.mapInArrow(_emit_steps, "row long, place long, step int, core long, cover long"))
    settled, open_ = _kinds(of_step, ["step", "core"])
    first = F.least(most, F.col("step") * STEP + (STEP - 1))
    ranges = ranges.union(settled.select("row", (position - first).alias("a"), (position - F.greatest(fewest, F.col("step") * STEP) + LENGTH).alias("b")))

    wanted = open_.groupBy("row", "place").agg(F.collect_list("step").alias("steps"))
    seen = settle(pieces.join(wanted, ["row", "place"]).select("row", "place", "piece", "steps").mapInArrow(_emit_windows, "row long, start long, one long, two int"))
    twice = settle(seen.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two"))
    return ranges.union(seen.join(twice, ["one", "two"], "left_semi").select("row", F.col("start").alias("a"), (F.col("start") + LENGTH).alias("b")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).select("row", "doc_id", "text")
    ranges = repeated_ranges(rows).groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    joined = map_batches(rows, _pack_batch, "row long, doc_id long, packed binary").join(ranges, "row", "left").select("row", "doc_id", "packed", "ranges")
    return map_batches(joined, _cut_batch, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
