"""Keyword detection: from story text to (story, keyword) rows.

Every name is filed under one word that its matches contain.  The words of a text
that some name is filed under are found in a hash set, their names in a table cut
into small buckets by a hash of the word, and names that are more than that word
are verified with their pattern.  Where every name is its word none is looked up.
Time per text follows its own words and matches, not the number of names.
Everything is a projection: no shuffle, no join, no Python.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risewatch.functions.text import match_text, spark_pattern, sql_text, whole_word_pattern, words
from risewatch.functions.time import week_label
from risewatch.taxonomy import Taxonomy

# Prefix of working columns, so that none of a story's own columns is hit.
OWN = "_risewatch_"
# Words in a bucket on average.
BUCKET_WORDS = 4

_NO_NAMES = "array<string>"


def _pattern_of(taxonomy: Taxonomy, name: str) -> str:
    custom = taxonomy.patterns.get(name)
    return whole_word_pattern(name) if custom is None else spark_pattern(custom)


def _filed(taxonomy: Taxonomy) -> tuple[dict[str, list[tuple[str, str | None]]], list[str]]:
    """word -> [(name, pattern or none)], and the names whose matches tell no word.

    Of the words a name requires it is filed under the longest, as the rarest.
    """
    filed, unknown = defaultdict(list), []
    for name in taxonomy.category_of():
        need = taxonomy.required_words(name)
        if not need:
            unknown.append(name)
            continue
        pattern = None if taxonomy.is_single_word(name) else _pattern_of(taxonomy, name)
        filed[max(need, key=len)].append((name, pattern))
    return dict(filed), unknown


def _are_words(filed: dict[str, list[tuple[str, str | None]]]) -> bool:
    """Whether every name is the word it is filed under, so that the words found are the names."""
    return all(found == [(word, None)] for word, found in filed.items())


def _named(name: str, pattern: str) -> str:
    return f"named_struct('name', {sql_text(name)}, 'pattern', {sql_text(pattern)})"


def _table_of(filed: dict[str, list[tuple[str, str | None]]]) -> tuple[str, int]:
    """SQL of an array of maps from word to names, one map for each hash bucket, and the number of buckets.

    Names are structs of name and pattern, which is empty for a name that is its word:
    fields are read in place, where a text of both would be split for every match.  It is
    one text of SQL, which the optimiser folds to a literal, as thousands of column
    objects take longer to make than the detection to run.
    """
    n = max(1, len(filed) // BUCKET_WORDS)
    buckets: list[list[str]] = [[] for _ in range(n)]
    for word in filed:
        buckets[zlib.crc32(word.encode()) % n].append(word)

    def names(word: str) -> str:
        return "array(" + ", ".join(_named(name, pattern or "") for name, pattern in filed[word]) + ")"

    nothing = f"map('', array({_named('', '')}))"
    maps = ["map(" + ", ".join(f"{sql_text(w)}, {names(w)}" for w in words) + ")" if words else nothing for words in buckets]
    return f"array({', '.join(maps)})", n


def detect_keywords(
    stories: DataFrame,
    taxonomy: Taxonomy,
    title: str = "title",
    url: str | None = "url",
    output: str = "keywords",
) -> DataFrame:
    """Add ``output``: the sorted distinct names found in title and link."""
    filed, unknown = _filed(taxonomy)
    seen, text = F.col(f"{OWN}seen"), F.col(f"{OWN}text")
    nothing = F.array().cast(_NO_NAMES)
    known, parts = nothing, []
    if filed:
        known = F.expr(f"array_distinct(filter({OWN}words, w -> w IN ({', '.join(map(sql_text, filed))})))")
    if filed and _are_words(filed):
        parts.append(seen)
    elif filed:
        table, n = _table_of(filed)
        names = F.expr(f"flatten(transform({OWN}seen, w -> element_at(element_at({table}, CAST(crc32(w) % {n} + 1 AS INT)), w)))")

        def right(name: Column) -> Column:
            return (name["pattern"] == "") | F.regexp_like(text, name["pattern"])

        if any(pattern for found in filed.values() for _, pattern in found):
            names = F.filter(names, right)
        parts.append(names["name"])
    if unknown:
        parts.append(F.array_compact(F.array(*[F.when(text.rlike(_pattern_of(taxonomy, n)), F.lit(n)) for n in unknown])))
    found = F.sort_array(F.array_distinct(F.concat(*parts))) if parts else nothing
    if not unknown:
        found = F.when(F.size(seen) > 0, found).otherwise(nothing)
    return (
        stories.withColumn(f"{OWN}text", match_text(title, url))
        .withColumn(f"{OWN}words", words(text))
        .withColumn(f"{OWN}seen", known)
        .withColumn(output, found)
        .drop(f"{OWN}text", f"{OWN}words", f"{OWN}seen")
    )


def matched_stories(stories: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """One row per story and name found, with the story's own columns."""
    # the outer form keeps the optimiser from adding a filter that would run
    # the detection twice
    found = f"{OWN}keywords"
    return (
        detect_keywords(stories, taxonomy, output=found)
        .withColumn("keyword", F.explode_outer(found))
        .filter(F.col("keyword").isNotNull())
        .drop(found)
    )


def matched_by_word_join(stories: DataFrame, names: DataFrame) -> DataFrame:
    """:func:`matched_stories` for names that come as a table (word, keyword, pattern), see :func:`name_table`.

    The words are an index of the distinct texts, by a hash of 128 bits: it is the
    index that meets the names, and only what it finds there returns to the stories,
    where the few names with a pattern are checked.  No text goes through the first join.
    """
    word, pattern, keys = f"{OWN}word", f"{OWN}pattern", [f"{OWN}key1", f"{OWN}key2"]
    table = names.select(F.col("word").alias(word), F.col("keyword"), F.col("pattern").alias(pattern))
    text = match_text("title", "url")
    marked = stories.withColumns({keys[0]: F.xxhash64(text), keys[1]: F.xxhash64(F.lit(1), text)})
    found = (
        marked.select(*keys, F.explode(F.array_distinct(words(text))).alias(word))
        .join(table, word)
        .select(*keys, "keyword", pattern)
        .distinct()
    )
    return (
        marked.join(found, keys)
        .filter(F.col(pattern).isNull() | F.regexp_like(text, F.col(pattern)))
        .select(*[F.col(f"`{c}`") for c in stories.columns], "keyword")
    )


def name_table(stories: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """(word, keyword, pattern) of the names whose matches contain a known word."""
    rows = [(word, name, pattern) for word, names in _filed(taxonomy)[0].items() for name, pattern in names]
    return stories.sparkSession.createDataFrame(rows, "word string, keyword string, pattern string")


def with_category(df: DataFrame, taxonomy: Taxonomy, default: str = "Unknown") -> DataFrame:
    """Add ``category`` by keyword; names outside the taxonomy get ``default``."""
    table = F.broadcast(taxonomy.dataframe(df.sparkSession))
    return df.join(table, "keyword", "left").withColumn(
        "category", F.coalesce("category", F.lit(default))
    )


def _event_columns(matched: DataFrame) -> list[Column | str]:
    week = "iso_week" if "iso_week" in matched.columns else week_label("created_at").alias("iso_week")
    return ["story_id", "keyword", "category", "score", "created_at", week]


def keyword_events(stories: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """(story_id, keyword, category, score, created_at, iso_week) of every match."""
    matched = with_category(matched_stories(stories, taxonomy), taxonomy)
    return matched.select(*_event_columns(matched))


def unprocessed(stories: DataFrame, events: DataFrame) -> DataFrame:
    """Stories without any event."""
    return stories.join(events.select("story_id").distinct(), "story_id", "left_anti")
