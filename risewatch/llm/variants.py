"""Spelling variants: words one inserted, deleted or replaced code point apart, by a scan of the sorted vocabulary.

Two words one edit apart, the longer of m code points, share a prefix of `low` and a suffix of m - 1 - low code points. So
they meet in one range of a sorted list: the class (m, low, high) holds the pairs whose common prefix has at least `low` and
less than `high` code points; its ranges share the first `low` code points and the last m - high. The classes start with the
longer half as prefix or suffix. A range with more than RANGE words is cut in two classes at the middle of [low, high),
again and again; at high = low + 1 it holds the words with one place open, at most the alphabet. No word is left out, and
every pair is found once: by its common prefix and the length of its longer word.

Spark sorts the words by range and by what is left between prefix and suffix. A task scans each word's range from the word
on: the row of edit costs (three places wide) of a prefix is kept, the next word takes over the rows of the code points it
shares with the last one, and where a row has no cost below two, all words that share that prefix are skipped.

Defined cases: null texts have no words, a null id is written as nothing before the colon; repeated rows count as often as
they occur; ties between near words go to the smaller in code point order; other columns play no part.

Memory: a task holds HELD counts and one text, then one range of RANGE words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risewatch.llm.shared import SLICE, settle, token_lists

LEAST_LENGTH, LEAST_COUNT, NOISE, STRONGER = 5, 3, 97, 2
HELD, RANGE = 300_000, 64
#: Characters beyond ASCII but U+00C0 to U+00FF, which are C3 and a byte more in UTF-8.
_OTHER = re.compile(rb"[\xC2\xC4-\xF4][\x80-\xBF]+")
_FINE = bytes([*range(0x80), *range(0x80, 0xC0), 0xC3])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}

    def out() -> Iterator[pa.RecordBatch]:
        yield pa.record_batch([pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            for name, data in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if data.translate(None, _FINE):
                    data = _OTHER.sub(b" ", data)
                runs: Counter[bytes] = Counter()
                for words in token_lists(data):
                    runs.update(words)
                start = zlib.crc32(f"{name}:".encode())
                for run, n in runs.items():
                    if len(run) < LEAST_LENGTH:
                        continue
                    mark = zlib.crc32(run, start)
                    if mark % NOISE == 0:
                        points = run.decode()
                        cut = mark % len(points)
                        run = (points[:cut] + points[cut + 1 :]).encode()
                    held[run] = held.get(run, 0) + n
            if len(held) > HELD:
                yield from out()
    yield from out()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n of the words of LEAST_LENGTH code points with LEAST_COUNT occurrences."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col)]
    found = docs.select(*blank).mapInArrow(_counts, "word string, n long").where(F.length("word") >= LEAST_LENGTH)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _classes(*classes: tuple[Column, Column, Column]) -> Column:
    return F.explode(F.array(*[F.struct(m.cast("int").alias("m"), a.cast("int").alias("low"), b.cast("int").alias("high")) for m, a, b in classes])).alias("c")


def _keyed(rows: DataFrame) -> DataFrame:
    """word, n, m, low, high, range: the prefix and the suffix that the class fixes, parted by a blank."""
    fixed = F.concat_ws(" ", F.substr("word", F.lit(1), F.col("low")), F.right("word", F.col("m") - F.col("high")))
    return rows.select("word", "n", "m", "low", "high", fixed.alias("range"))


def ranges(words: DataFrame, most: int = RANGE) -> DataFrame:
    """word, n, m, low, high, range: each word in its ranges, none with over `most` words but those with one place open."""
    size = F.length("word")
    halves = [(m, a, b) for m in (size, size + 1) for a, b in ((F.floor(m / 2), m), (F.lit(0), F.floor(m / 2)))]
    rows = settle(_keyed(words.select("word", "n", _classes(*halves)).select("word", "n", "c.*")))
    parts = []
    key = ["m", "low", "high", "range"]
    while True:
        large = rows.where("high > low + 1").groupBy(*key).count().where(F.col("count") > most).drop("count")
        large = settle(large)
        if large.isEmpty():
            break
        parts.append(rows.join(large, key, "left_anti").select(rows.columns))
        middle = F.floor((F.col("low") + F.col("high")) / 2)
        cut = rows.join(large, key, "left_semi").select("word", "n", _classes((F.col("m"), middle, F.col("high")), (F.col("m"), F.col("low"), middle)))
        rows = settle(_keyed(cut.select("word", "n", "c.*")))
    for part in parts:
        rows = rows.union(part)
    return rows


def _shared(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            return n
        n += 1
    return n


def scan(words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs (i, j), i < j, of this sorted list that are exactly one edit apart."""
    count = len(words)
    shared = [0] * (count + 1)  # of a word with the one before; past the last nothing is shared
    for i in range(1, count):
        shared[i] = _shared(words[i - 1], words[i])
    for i in range(count - 1):
        word = words[i]
        size = len(word)
        # costs of a candidate's first d code points against the word's first d - 1, d, d + 1; rows[:valid + 1] hold
        rows = [(1, 0, 1)] * size + [(1, 0, 9)]
        valid, j = size, i + 1
        while j < count:
            valid = min(valid, shared[j])
            other = words[j]
            d, dead = valid, False
            left, mid, right = rows[d] if d else (9, 0, 1 if size else 9)
            del rows[d + 1 :]
            for d in range(valid + 1, len(other) + 1):
                c = other[d - 1]
                # from the row above: left comes from the places d - 2 and d - 1, and so on
                a = min(mid + 1, left + (d < 2 or d - 2 >= size or word[d - 2] != c)) if d - 1 <= size else 9
                b = min(mid + (word[d - 1] != c), right + 1, a + 1) if d <= size else 9
                e = min(right + (word[d] != c), b + 1) if d < size else 9
                if a > 1 and b > 1 and e > 1:
                    dead = True
                    break
                rows.append((a, b, e))
                left, mid, right = a, b, e
            if dead:
                valid = d - 1
                j += 1
                while shared[j] >= d:
                    j += 1
                continue
            valid = len(other)
            gap = size - len(other)
            if -1 <= gap <= 1 and (left, mid, right)[gap + 1] == 1:
                yield i, j
            j += 1


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, other, n (of the other), both ways, for sorted rows (m, low, high, range, middle, word, n)."""
    found: tuple[list, list, list] = ([], [], [])
    held: list[tuple] = []
    now = None

    def close() -> None:
        key, middles = now, [x[0] for x in held]
        m, low, high, _ = key
        for i, j in scan(middles):
            (_, a, n), (_, b, k) = held[i], held[j]
            if max(len(a), len(b)) == m and _shared(a, b) < high:
                found[0].extend((a, b))
                found[1].extend((b, a))
                found[2].extend((k, n))

    def out() -> Iterator[pa.RecordBatch]:
        yield pa.record_batch([pa.array(found[0], pa.string()), pa.array(found[1], pa.string()), pa.array(found[2], pa.int64())], names=["word", "other", "n"])
        for x in found:
            x.clear()

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for key, row in zip(zip(*columns[:4], strict=True), zip(*columns[4:], strict=True), strict=True):
            if key != now:
                if len(held) > 1:
                    close()
                held.clear()
                now = key
            held.append(row)
        if len(found[0]) > 10_000:
            yield from out()
    if len(held) > 1:
        close()
    yield from out()


def near_words(words: DataFrame, most: int = RANGE) -> DataFrame:
    """word, other, n (of the other) for all words (word, n) one edit apart, both ways; distinct words of any length."""
    key = ["m", "low", "high", "range"]
    middle = F.substr("word", F.col("low") + 1, F.length("word") - F.col("low") - (F.col("m") - F.col("high")))
    rows = ranges(words, most).select(*key, middle.alias("middle"), "word", "n")
    rows = rows.repartition(*key).sortWithinPartitions(*key, "middle")
    return rows.mapInArrow(_near, "word string, other string, n long")


def roots(links: DataFrame) -> DataFrame:
    """word, root of links (word, form): every round a link takes over its target's link, so a chain halves each time."""
    links = settle(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = settle(links.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        links = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return links


def variants(docs: DataFrame, **columns: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = settle(vocabulary(docs, **columns))
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col("other").alias("word"))).alias("first")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), first)
    strong = F.col("first.n") * -1 >= F.col("n") * STRONGER
    found = words.join(near, "word", "left").select(
        "word", F.when(strong, F.col("first.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, -F.col("first.n")).alias("form_n")
    )
    found = settle(found)
    return found.join(roots(found.where("form is not null")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
