"""Source divergence audit: how far the sources of a language lie apart, and by which terms.

Tasks count terms by language and source and hand over sums. Each language keeps the terms of at least MIN_DOCS of its
documents. A kept term's share p = 1 + floor(1e9 * (count + 2) / (N + 2 * V)) is exact: its product is a decimal of 31
digits, the quotient a long. Two shares differ by f = floor((p - q) ** 2 / (p + q)).

Terms of a group are ranked by dominance. f grows with p and falls with q where p > q, and both follow the counts; so a
term with no lower count in the group, no higher one in the language and an earlier name stands before another for
certain. Tasks keep the terms that fewer than k others dominate (their skyband); a term is in the skyband of all rows only
if it is in that of its task, so skybands are merged by the same function, and what is left is ranked by f itself.

Pairs of sources are summed in blocks of terms. For terms that neither source holds the difference is one number, so a
block adds only what its terms differ from that number, and V times that number is added once at the end.

Defined cases: null lang, source and text count as ''; a group without terms has pairs and no terms; a language without
kept terms has pairs of value 0; repeated rows count as often as they occur, each as a document; ties go to the item that is
earlier in UTF-8; other columns play no part.

Memory: a task holds HELD counts and one text; a skyband holds BUFFER rows of a group beside what it keeps; a block has
about BLOCK_TERMS terms of two blocks of SOURCE_BLOCK sources. The pairs of sources are the result itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risewatch.llm.shared import SLICE, settle, token_lists

MIN_DOCS, TOP = 10, 10
HELD, BUFFER = 500_000, 100_000
BLOCK_TERMS, SOURCE_BLOCK = 512, 256
UNIT = 1_000_000_000


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n, docs"""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            columns = [
                pa.array([lang] * len(times), pa.string()),
                pa.array([source] * len(times), pa.string()),
                pa.array(times.keys(), pa.binary()).cast(pa.string()),
                pa.array(times.values(), pa.int64()),
                pa.array([docs[t] for t in times], pa.int64()),
            ]
            yield pa.record_batch(columns, names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            langs, sources = part.column(0).to_pylist(), part.column(1).to_pylist()
            for lang, source, data in zip(langs, sources, part.column(2).cast(pa.binary()).to_pylist(), strict=True):
                times, docs = held.setdefault((lang, source), (Counter(), Counter()))
                own: set[bytes] = set()
                for words in token_lists(data):
                    times.update(words)
                    own.update(words)
                docs.update(own)
            if sum(len(times) for times, _ in held.values()) > HELD:
                yield from out()
    yield from out()


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n (occurrences in the group), lang_n (in the language) of terms in min_docs documents (lang, source, text).

    One shuffle, by language and term: the rows that a task has summed meet there, are added up by source and then over the
    sources. A term's rows are at most the groups of each task, however frequent it is.
    """
    found = docs.mapInArrow(_counts, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    sums = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    sums = sums.withColumn("lang_n", F.sum("n").over(whole)).withColumn("lang_docs", F.sum("docs").over(whole))
    return sums.where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(1e9 * (count + 2) / (total + 2 * terms)); null without terms."""
    above = (count + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + 2 * terms).cast("decimal(20,0)")
    return F.when(terms > 0, F.call_function("div", above, below) + 1)


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def skyband(rows: pa.Table, k: int) -> pa.Table:
    """The rows (n, lang_n, term) that fewer than k others dominate: n no lower, lang_n no higher, term earlier."""
    order = pc.sort_indices(rows, sort_keys=[("n", "descending"), ("lang_n", "ascending"), ("term", "ascending")])
    rows = rows.take(order)
    n, lang_n = rows.column("n").to_numpy(), rows.column("lang_n").to_numpy()
    # of equal counts only the first k can stay
    fresh = np.concatenate(([True], (n[1:] != n[:-1]) | (lang_n[1:] != lang_n[:-1])))
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(n)), 0))
    rows = rows.filter(pa.array(np.arange(len(n)) - start < k))
    lang_n = rows.column("lang_n").to_numpy()
    place = np.empty(len(lang_n), np.int64)
    place[pc.sort_indices(rows.column("term")).to_numpy()] = np.arange(len(lang_n))
    kept_n, kept_place, kept = np.empty_like(lang_n), np.empty_like(place), np.empty(len(place), np.int64)
    size = 0
    for i in range(len(place)):  # whatever dominates a row stands before it
        if size < k or np.count_nonzero((kept_n[:size] <= lang_n[i]) & (kept_place[:size] < place[i])) < k:
            kept_n[size], kept_place[size], kept[size] = lang_n[i], place[i], i
            size += 1
    return rows.take(pa.array(kept[:size]))


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """Of each task's rows (lang, source, term, n, lang_n) the skyband of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[pa.Table]] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for lang, source in set(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                parts = held.setdefault((lang, source), [])
                parts.append(table.filter(pc.and_(pc.equal(table["lang"], lang), pc.equal(table["source"], source))))
                if sum(map(len, parts[1:])) > BUFFER:  # parts[0] is the skyband so far
                    parts[:] = [skyband(pa.concat_tables(parts), k)]
        for parts in held.values():
            yield from skyband(pa.concat_tables(parts), k).to_batches(max_chunksize=50_000)

    return rows.select("lang", "source", "term", "n", "lang_n").mapInArrow(run, "lang string, source string, term string, n long, lang_n long")


def block_sums(table: pa.Table) -> pa.Table:
    """lang, one, two, extra: for sources one < two, the sum over this block's terms of f less f of terms they do not hold."""
    term = table.column("term")
    own = table.filter(pc.is_null(term))
    number, base, side = (own.column(c).to_numpy() for c in ("number", "base", "side"))
    order = np.argsort(number, kind="stable")
    number, base, side = number[order], base[order], side[order]
    held = table.filter(pc.is_valid(term))
    codes = held.column("term").combine_chunks().dictionary_encode()
    shares = np.tile(base, (len(codes.dictionary), 1))
    shares[codes.indices.to_numpy(), np.searchsorted(number, held.column("number").to_numpy())] = held.column("p").to_numpy()
    first, last = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    lang = table.column("lang")[0].as_py()
    ones, twos, sums = [], [], []
    for i in np.flatnonzero(side == first):
        at = np.flatnonzero((side == last) & (number > number[i]))
        p, q, p0, q0 = shares[:, [i]], shares[:, at], base[i], base[at]
        extra = ((p - q) ** 2 // (p + q)).sum(axis=0) - len(shares) * ((p0 - q0) ** 2 // (p0 + q0))
        ones.append(np.full(len(at), number[i]))
        twos.append(number[at])
        sums.append(extra)
    ones, twos, sums = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (ones, twos, sums))
    return pa.table({"lang": pa.array([lang] * len(ones), pa.string()), "one": ones, "two": twos, "extra": sums})


def _pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, one, two, extra over all terms; sources in blocks, so that a task has SOURCE_BLOCK sources on either side."""
    described = groups.where("v > 0").withColumn("side", F.floor(F.col("number") / SOURCE_BLOCK)).withColumn("blocks", F.ceil(F.col("v") / BLOCK_TERMS))
    described = described.withColumn("sides", F.floor((F.col("sources") - 1) / SOURCE_BLOCK))
    columns = ["lang", "number", "side", "sides", "base", "block", "term", "p"]
    own = described.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    own = own.select(*columns[:6], F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"))
    held = kept.join(described.select("lang", "source", "number", "side", "sides", "base", "blocks"), ["lang", "source"])
    held = held.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))).select(*columns)
    rows = own.union(held).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides"))))
    rows = rows.withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))
    sums = rows.drop("other", "sides").groupBy("lang", "block", "low", "high").applyInArrow(block_sums, "lang string, one long, two long, extra long")
    return sums.groupBy("lang", "one", "two").agg(F.sum("extra").alias("extra"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, **columns: str) -> DataFrame:
    """lang, source, part, item, value, rank: for each group the distances to the other sources, and its top terms.

    columns: lang_col, source_col, text_col, if they have other names.
    """
    names = [columns.get(f"{c}_col", c) for c in ("lang", "source", "text")]
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in zip(names, ("lang", "source", "text"), strict=True)])
    kept = settle(kept_terms(texts, min_docs))
    langs = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.fillna(0, ["v", "lang_total", "total"])
    places = Window.partitionBy("lang").orderBy("source")
    groups = groups.withColumn("number", F.row_number().over(places).cast("long") - 1).withColumn("sources", F.count("*").over(Window.partitionBy("lang")))
    groups = settle(groups.withColumn("base", share(F.lit(0), F.col("total"), F.col("v"))))

    # a term in one of a group's skybands after the other; the second round meets by hash, so no group is gathered
    near = skybands(kept, top).repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(16)))
    near = skybands(near, top).join(groups, ["lang", "source"])
    near = near.withColumn("p", share(F.col("n"), F.col("total"), F.col("v"))).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v")))
    ranked = near.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    shares = kept.join(groups.select("lang", "source", "total", "v"), ["lang", "source"])
    shares = shares.select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    sums = _pair_sums(shares, groups)
    others = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("other"), F.col("base").alias("other_base"))
    pairs = groups.join(others, "lang").where("number <> other")
    pairs = pairs.withColumn("one", F.least("number", "other")).withColumn("two", F.greatest("number", "other")).join(sums, ["lang", "one", "two"], "left")
    plain = F.col("v") * distance(F.col("base"), F.col("other_base"))
    value = F.when(F.col("v") > 0, F.coalesce("extra", F.lit(0)) + plain).otherwise(F.lit(0)).cast("long")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn("rank", F.row_number().over(best))
    return pairs.union(ranked)
