"""Emerging terms: what a period's titles talk about that no taxonomy names.

Scores follow the usual smoothed TF-IDF: a term's weight in a document is
``tf * (ln((1 + n) / (1 + df)) + 1)``, the weights of a document are scaled to
length one, and a term's score is the sum of its weights over the documents of
its group.  All groups run in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risewatch.functions.text import term_tokens, with_bigrams
from risewatch.operators.rollup import only_weeks, with_week
from risewatch.taxonomy import Taxonomy

# Documents a term must occur in, and terms kept per week.
MIN_DOCS = 5
TOP_TERMS = 20
# Parts that texts and terms are dealt to (a multiple of 64); the part of a document is its slot.
SPREAD = 256
SLOT = "_slot"


def default_stop_words() -> list[str]:
    """Spark's English list (needs a running session)."""
    return StopWordsRemover.loadDefaultStopWords("english")


def _sizes(docs: DataFrame, group: str, text: str) -> DataFrame:
    """(group, n): texts of each group."""
    return docs.filter(F.col(text).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))


def _slot_by_size(docs: DataFrame, group: str, doc: str, text: str) -> Column:
    """A document's part: one for a small group, as many as its share of all texts for a large one.

    A group that has at least one part's share of the texts gets parts of its own, side by
    side, and a hash of the document picks one of them; there are at most SPREAD such groups.
    The fewer parts a group lies in, the fewer copies of its terms leave them.
    """
    sizes = _sizes(docs, group, text)
    all_texts = sizes.agg(F.sum("n")).scalar()
    large = sizes.orderBy(F.desc("n"), group).limit(SPREAD).withColumn("parts", F.floor(F.col("n") * SPREAD / all_texts))
    # a row per large group
    before = Window.orderBy(F.desc("n"), group).rowsBetween(Window.unboundedPreceding, -1)
    places = large.filter(F.col(group).isNotNull() & (F.col("parts") > 0)).select(
        F.struct(group, F.struct("parts", F.coalesce(F.sum("parts").over(before), F.lit(0)).alias("first")).alias("place")).alias("entry")
    )
    place = F.element_at(places.agg(F.map_from_entries(F.collect_list("entry"))).scalar(), F.col(group))
    spread = place["first"] + F.pmod(F.xxhash64(doc), place["parts"])
    return F.coalesce(spread, F.pmod(F.xxhash64(group), F.lit(SPREAD)))


def terms_by_document(
    docs: DataFrame, group: str, doc: str, text: str, stop_words: Sequence[str], slot: Column | None = None
) -> DataFrame:
    """(group, slot, doc, copies, terms): words and pairs of neighbouring words, in order.

    Texts are cut into words where they are read, once; the words are dealt to the
    slots, and pairs are made there, so counting terms needs no shuffle of the much
    larger term rows.  Texts grow manyfold when they are split, so there are SPREAD
    parts, which adaptive execution does not merge.  ``slot`` is a document's part, by
    default a hash of group and document; it must not differ between rows that share
    both.  ``copies`` is the number of those rows.

    Rows lie by group and document.  That makes every reader ask for the document, so
    that all of them share one shuffle, and later sorts by document find their order.
    """
    if slot is None:
        slot = F.pmod(F.xxhash64(group, doc), F.lit(SPREAD))
    tokens = F.split("_tokens", " ")
    return (
        docs.select(group, doc, text)
        .filter(F.col(text).isNotNull())
        .select(
            group,
            doc,
            # never null, so that a join by it adds no filter under one of the shuffles that are to be one
            F.coalesce(slot, F.lit(0)).cast("int").alias(SLOT),
            # no word holds a blank
            F.array_join(term_tokens(text, stop_words), " ").alias("_tokens"),
        )
        .repartitionById(SPREAD, SLOT)
        .sortWithinPartitions(SLOT, group, doc)
        .withColumn("copies", F.count("*").over(Window.partitionBy(SLOT, group, doc)))
        .withColumn("_tokens", F.when(F.col("_tokens") == "", F.array().cast("array<string>")).otherwise(tokens))
        .select(group, SLOT, doc, "copies", with_bigrams(F.col("_tokens")).alias("terms"))
    )


def _exploded(terms: Column, *keys: str, of: DataFrame) -> DataFrame:
    rows = of.select(*keys, F.explode_outer(terms).alias("term"))
    return rows.filter(F.col("term").isNotNull())


def _counted(terms: DataFrame, *keys: str) -> DataFrame:
    """(keys, term, tf) of each row, from the runs of its sorted terms.

    Counting in the row keeps no table of all documents' terms, so nothing is spilled.
    """
    starts = "filter(sequence(0, size(_sorted)), i -> i = 0 OR i = size(_sorted) OR _sorted[i] <> _sorted[i - 1])"
    runs = "transform(slice(_starts, 1, size(_starts) - 1), (at, i) -> struct(_sorted[at] AS term, CAST(_starts[i + 1] - at AS BIGINT) AS tf))"
    rows = (
        terms.select(*keys, F.sort_array("terms").alias("_sorted"))
        .withColumn("_starts", F.expr(starts))
        .select(*keys, F.expr(runs).alias("_runs"))
        .select(*keys, F.inline_outer("_runs"))
    )
    return rows.filter(F.col("term").isNotNull())


def term_counts(
    terms: DataFrame, group: str, doc: str, unique: bool = False, shared: bool = False, slot: bool = False
) -> DataFrame:
    """(group, doc, term, tf), and the slot if asked for.

    Only rows that share their document are added up; ``unique``: there are none,
    ``shared``: there are no others.
    """
    keys = [SLOT, group, doc] if slot else [group, doc]
    if unique:
        return _counted(terms, *keys)
    if shared:
        sums = _counted(terms, SLOT, group, doc).groupBy(SLOT, group, doc, "term").agg(F.sum("tf").alias("tf"))
        return sums.select(*keys, "term", "tf")
    alone = term_counts(terms.filter("copies = 1"), group, doc, unique=True, slot=slot)
    return alone.unionByName(term_counts(terms.filter("copies > 1"), group, doc, shared=True, slot=slot))


def _held_by() -> list[Column]:
    """The slots that hold a term, as bits: 64 in a number, so that they take no room per row of a slot."""
    bit = F.expr(f"shiftleft(1L, {SLOT} % 64)")
    return [
        F.bit_or(F.when(F.floor(F.col(SLOT) / 64) == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"_held{i}")
        for i in range(SPREAD // 64)
    ]


def _by_slot(terms: DataFrame, *keep: str) -> DataFrame:
    """A row for each slot of a term, from the bits."""
    numbers = F.array(*[F.col(f"_held{i}") for i in range(SPREAD // 64)])
    return (
        terms.select(*keep, F.posexplode(numbers).alias("_number", "_held"))
        .filter("_held <> 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_bit"))
        .filter(F.getbit("_held", "_bit") == 1)
        .select((F.col("_number") * 64 + F.col("_bit")).alias(SLOT), *keep)
    )


def inverse_frequency(
    docs: DataFrame, terms: DataFrame, group: str, text: str, min_docs: int, slot: bool = False
) -> DataFrame:
    """(group, term, df, idf) of the terms in at least ``min_docs`` documents; ``slot``: a row for each slot that holds the term.

    Documents are counted by slot, where their texts are, then by term in SPREAD
    parts: no task keeps more than its share of the terms, however few partitions
    a shuffle has by default.
    """
    frequent = (
        _exploded(F.array_distinct("terms"), group, SLOT, of=terms)
        .groupBy(SLOT, group, "term")
        .agg(F.count("*").alias("df"))
        .repartition(SPREAD, group, "term")
        .groupBy(group, "term")
        .agg(F.sum("df").alias("df"), *_held_by())
        .filter(F.col("df") >= min_docs)
    )
    idf = (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")
    known = frequent.join(_sizes(docs, group, text), group).select(
        group, "term", "df", idf, *[c for c in frequent.columns if c.startswith("_held")]
    )
    return _by_slot(known, group, "term", "df", "idf") if slot else known.select(group, "term", "df", "idf")


def tfidf_scores(
    docs: DataFrame,
    group: str = "iso_week",
    doc: str = "story_id",
    text: str = "title",
    min_docs: int = MIN_DOCS,
    stop_words: Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """(group, term, df, tfidf_score).  ``doc`` should be unique within a group; ``unique`` says that it is.

    The counts of documents and terms, by far the most rows, stay in their slot and are
    never shuffled: the frequent terms go to the slots that hold them, where they are
    hashed and the counts stream past them.  Weights are added up by slot, then by term.
    """
    if stop_words is None:
        stop_words = default_stop_words()
    docs = docs.filter(F.col(group).isNotNull())
    terms = terms_by_document(docs, group, doc, text, stop_words, _slot_by_size(docs, group, doc, text))
    idf = inverse_frequency(docs, terms, group, text, min_docs, slot=True).repartitionById(SPREAD, SLOT)
    if unique:
        counts = [term_counts(terms, group, doc, unique=True, slot=True)]
    else:
        # apart, as a union of both would not be known to lie in the slots
        counts = [
            term_counts(terms.filter("copies = 1"), group, doc, unique=True, slot=True),
            term_counts(terms.filter("copies > 1"), group, doc, shared=True, slot=True),
        ]
    return (
        reduce(DataFrame.unionByName, [_slot_scores(part, idf, group, doc) for part in counts])
        .repartition(SPREAD, group, "term")
        .groupBy(group, "term")
        .agg(F.max("df").alias("df"), F.sum("tfidf_score").alias("tfidf_score"))
    )


def _slot_scores(counts: DataFrame, idf: DataFrame, group: str, doc: str) -> DataFrame:
    """(slot, group, term, df, tfidf_score) of the documents of each slot, without a shuffle."""
    of_doc = Window.partitionBy(SLOT, group, doc)
    return (
        counts.join(idf.hint("shuffle_hash"), [SLOT, group, "term"])
        .withColumn("_weight", F.col("tf") * F.col("idf"))
        .withColumn("_length", F.sqrt(F.sum(F.col("_weight") * F.col("_weight")).over(of_doc)))
        .groupBy(SLOT, group, "term")
        .agg(F.max("df").alias("df"), F.sum(F.col("_weight") / F.col("_length")).alias("tfidf_score"))
    )


def top_terms(
    scores: DataFrame, taxonomy: Taxonomy, group: str = "iso_week", top: int = TOP_TERMS
) -> DataFrame:
    """The best terms of each group that are not names of the taxonomy.

    Ties go to the alphabetically first; scores are compared to eight decimals,
    so that the order in which a cluster adds them up decides nothing.  Only a
    task's own best rows are shuffled for the ranking.
    """
    known = sorted({name.lower() for name in taxonomy.category_of()})
    best = Window.partitionBy(group).orderBy(F.desc(F.round("tfidf_score", 8)), "term")
    return (
        scores.filter(~F.lower("term").isin(known))
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= top)
        .select("term", group, "tfidf_score")
    )


def emerging_terms(
    stories: DataFrame,
    taxonomy: Taxonomy,
    weeks: Sequence[str] | None = None,
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """(term, iso_week, tfidf_score): the top terms of every week of stories."""
    dated = only_weeks(with_week(stories), weeks).filter(F.col("iso_week").isNotNull())
    scores = tfidf_scores(dated, min_docs=min_docs, stop_words=stop_words, unique=True)
    return top_terms(scores, taxonomy, top=top)
