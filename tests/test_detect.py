import random
import re

import pytest
from pyspark.sql import functions as F

from risewatch.operators.detect import (
    detect_keywords,
    keyword_events,
    matched_by_word_join,
    matched_stories,
    name_table,
    unprocessed,
    with_category,
)
from risewatch.taxonomy import DEFAULT, Taxonomy

CASES = [
    # title, url, must contain, must not contain
    ("Why our team moved to Rust", None, {"Rust"}, set()),
    ("Trusting old rustic chairs", None, set(), {"Rust"}),
    ("Weekly notes", "https://example.org/rust-notes/7", {"Rust"}, set()),
    ("Weekly notes", "https://code.example.org/Rust_notes", {"Rust"}, set()),
    ("Profiling Go services", None, set(), {"Rust"}),
    ("Profiling  Go 2 drafts", None, {"Go"}, set()),
    ("Cargo ships are ongoing", None, set(), {"Go"}),
    ("Places to go to before winter", None, set(), {"Go"}),
    ("Let it go on", None, set(), {"Go"}),
    ("Go over the numbers, then Go", None, {"Go"}, set()),
    ("Go away", None, set(), {"Go"}),
    ("A look inside Next.js caching", None, {"Next.js"}, set()),
    ("What comes next, js or wasm", None, set(), {"Next.js"}),
    ("Packaging python wheels", None, {"Python"}, set()),
    ("Packaging notes", "https://pkg.example.org/python/wheels", {"Python"}, set()),
    ("Strictness flags in TYPESCRIPT", None, {"TypeScript"}, set()),
    ("Smaller docker images", None, {"Docker"}, set()),
    ("An island of pages", "https://example.org/astro/islands", {"Astro"}, set()),
    ("Redis behind FastAPI", None, {"FastAPI"}, {"Rust"}),
    ("Use C++20 now", None, {"C++"}, set()),
    ("C++ 20 released", None, set(), {"C++", "C#", "F#"}),
    ("Why C++", None, set(), {"C++"}),
    ("C#", None, set(), {"C#"}),
    ("Go tools", None, set(), {"Go"}),
    ("Go  generics", None, {"Go"}, set()),
    ("Written in R", None, {"R"}, set()),
    ("Written in R", "https://example.com", set(), {"R"}),
    ("A forum", "https://example.com/r/programming", {"R"}, set()),
    ("Plots with R 4 at last", None, {"R"}, set()),
    ("LLMs", None, set(), {"LLM"}),
    ("GPT4", None, set(), {"GPT"}),
    ("GPT-4", None, {"GPT"}, set()),
    ("Docs", "https://nextjs.org/next.js", set(), {"Next.js"}),
    ("We express joy in spring and render it", None, {"Express", "Spring", "Render"}, set()),
    ("Stable", "https://diffusion.example.com/", {"Stable Diffusion"}, set()),
    ("caféRust", None, set(), {"Rust"}),
    ("Rust́", None, {"Rust"}, set()),
    ("RUſT and Kafka", None, {"Rust", "Kafka"}, set()),
]


def detected(spark, pairs, taxonomy=DEFAULT):
    rows = [(i, t, u) for i, (t, u) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, title string, url string")
    return [r.keywords for r in detect_keywords(df, taxonomy).orderBy("i").collect()]


def test_cases(spark):
    found = detected(spark, [(t, u) for t, u, _, _ in CASES])
    for (title, url, yes, no), got in zip(CASES, found):
        assert yes <= set(got) and not no & set(got), (title, url, got)
        assert got == sorted(set(got))


def test_nothing_found_is_an_empty_list(spark):
    assert detected(spark, [("", None), (None, None), ("Seven ways to water a fern", "")]) == [[]] * 3


def test_a_name_is_reported_once(spark):
    assert detected(spark, [("Kafka, kafka and KAFKA", "https://example.org/kafka")]) == [["Kafka"]]


def test_taxonomy_facts():
    category = DEFAULT.category_of()
    assert len(DEFAULT) == 134
    assert category["Mistral"] == category["Hugging Face"] == "Companies"
    assert "C" not in category


def model_detect(text, taxonomy):
    found = set()
    for name in taxonomy.category_of():
        pattern = taxonomy.patterns.get(name, rf"\b{re.escape(name)}\b")
        if re.search(pattern, text, re.IGNORECASE):
            found.add(name)
    return sorted(found)


@pytest.fixture(scope="module")
def random_titles():
    rng = random.Random(11)
    pieces = [*DEFAULT.category_of(), "go", "to", "language", "the", "é", "_", "x", "3", ".", "+", "#", "-", " "]
    seams = ["", " ", "  ", "-", ".", "+"]
    return [
        "".join(rng.choice(pieces) + rng.choice(seams) for _ in range(rng.randint(0, 7)))
        for _ in range(1500)
    ]


def test_random_titles_match_plain_patterns(spark, random_titles):
    found = detected(spark, [(t, None) for t in random_titles])
    for title, got in zip(random_titles, found):
        assert got == model_detect(title, DEFAULT), title


UNANCHORED = Taxonomy(
    {"Tools": ["K8s", "Docker", "Grafana Labs", "Go"], "More": ["docker", "C++"]},
    {"K8s": r"\b(?:k8s|kubernetes)\b", "Go": DEFAULT.patterns["Go"]},
)


@pytest.mark.parametrize("taxonomy", [DEFAULT, UNANCHORED], ids=["default", "unanchored"])
def test_word_join_equals_literal_detection(spark, random_titles, taxonomy):
    rows = list(enumerate([*random_titles, "Kubernetes k8s docker C++x", None]))
    df = spark.createDataFrame(rows, "story_id int, title string").withColumn("url", F.lit(None).cast("string"))
    literal = matched_stories(df, taxonomy).select("story_id", "keyword")
    names = name_table(df, taxonomy)
    joined = matched_by_word_join(df, names).select("story_id", "keyword")
    known = {r.keyword for r in names.collect()}
    assert sorted(tuple(r) for r in literal.collect() if r.keyword in known) == sorted(map(tuple, joined.collect()))


def test_own_columns_survive(spark):
    df = spark.createDataFrame([(1, "Docker", None, "w", "p", "k")], "story_id int, title string, url string, word string, pattern string, keywords string")
    for found in (matched_stories(df, DEFAULT), matched_by_word_join(df, name_table(df, DEFAULT))):
        assert found.columns == [*df.columns, "keyword"]
        assert [tuple(r) for r in found.collect()] == [(1, "Docker", None, "w", "p", "k", "Docker")]


def test_many_names_of_several_words(spark):
    names = [f"alpha{i} beta{i % 50}" for i in range(3000)] + [f"gamma{i}" for i in range(3000)]
    taxonomy = Taxonomy({"Many": names})
    text = "x alpha7 beta7 alpha8 beta9 GAMMA12 gamma99999 alpha2999-beta49 alpha2999 beta49"
    assert detected(spark, [(text, None), ("nothing", None)], taxonomy) == [["alpha2999 beta49", "alpha7 beta7", "gamma12"], []]


def test_unanchored_pattern(spark):
    assert detected(spark, [("kubernetes and DOCKER", None)], UNANCHORED) == [["Docker", "K8s", "docker"]]


def test_events_carry_category_and_story_columns(spark, make_stories):
    stories = make_stories([(1, "Docker or Rust", 7, 3, "2024-01-15 10:00:00"), (2, "Ferns", 1, 1, "2024-01-15")])
    events = keyword_events(stories, DEFAULT)
    assert events.columns == ["story_id", "keyword", "category", "score", "created_at", "iso_week"]
    got = {(r.story_id, r.keyword, r.category, r.score, r.iso_week) for r in events.collect()}
    assert got == {(1, "Rust", "Languages", 7, "2024-W03"), (1, "Docker", "Tools", 7, "2024-W03")}


def test_unknown_category(spark):
    df = spark.createDataFrame([("Rust",), ("Cobol",)], "keyword string")
    got = {r.keyword: r.category for r in with_category(df, DEFAULT).collect()}
    assert got == {"Rust": "Languages", "Cobol": "Unknown"}


def test_unprocessed_are_stories_without_event(spark, make_stories):
    stories = make_stories([(i, "Rust" if i % 2 else "x", 1, 1, "2024-01-15") for i in range(6)])
    left = unprocessed(stories, keyword_events(stories, DEFAULT))
    assert sorted(r.story_id for r in left.collect()) == [0, 2, 4]
    assert unprocessed(stories, keyword_events(stories.limit(0), DEFAULT)).count() == 6


def test_detection_has_no_shuffle_and_runs_once(spark, make_stories):
    stories = make_stories([(1, "Rust", 1, 1, "2024-01-15")])
    plan = matched_stories(stories, DEFAULT)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EvalPython" not in plan
    assert plan.count("regexp_extract_all") == 1


def test_the_word_join_moves_no_text(spark):
    """Below the join of words and names a row has the text's hash and a word; copies of a text are looked up once."""
    taxonomy = Taxonomy({"Tools": ["Docker", "Go"]}, {"Go": DEFAULT.patterns["Go"]})
    title = "Docker and golang"
    rows = [(1, title, "a"), (2, title, "b"), (None, title, "c"), (3, None, "d"), (4, "go to docker", "e"), (4, "go to docker", "e")]
    df = spark.createDataFrame(rows, "story_id int, title string, tag string").withColumn("url", F.lit(None).cast("string"))
    names = name_table(df, taxonomy)
    known = [r.keyword for r in names.collect()]
    found = matched_by_word_join(df, names).select("story_id", "tag", "keyword")
    plain = matched_stories(df, taxonomy).where(F.col("keyword").isin(known)).select("story_id", "tag", "keyword")
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and found.count() >= 5
    tree = matched_by_word_join(df, names)._jdf.queryExecution().optimizedPlan()
    index = tree
    while index.nodeName() != "Aggregate":  # the index of distinct texts is the right side of the join back
        index = index.children().apply(index.children().size() - 1)
    join = index.child()
    while join.nodeName() != "Join":
        join = join.children().apply(0)
    assert "title" not in join.left().output().toString() and "tag" not in join.left().output().toString()


def test_categories_do_not_move_the_events(spark, make_stories):
    stories = make_stories([(1, "Rust and Go", 5, 1, "2024-01-02 10:00:00")])
    plan = keyword_events(stories, DEFAULT)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_names_and_categories_hold_any_sign(spark, make_stories):
    odd = Taxonomy({"It's \\ here": ["Rust", "O'Neil", "a\\b"]})
    stories = make_stories([(1, "rust by o'neil in a\\b", 5, 1, "2024-01-02 10:00:00")])
    found = keyword_events(stories, odd).select("keyword", "category").collect()
    assert sorted(map(tuple, found)) == [(n, "It's \\ here") for n in ("O'Neil", "Rust", "a\\b")]
    assert keyword_events(stories, Taxonomy({})).count() == 0


def test_only_texts_beyond_ascii_are_searched_for_folded_letters(spark):
    from risewatch.functions.text import words

    texts = ["Go_2 x", "a-b.C++ 9", "", " ", None, "caf\u00e9 RU\u017fT \u0130x", "x\u0301y", "A\x00b\x7fc", "\u0663 \u00b2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.w for r in df.select("i", words("t").alias("w")).orderBy("i").collect()]
    assert got == [["go_2", "x"], ["a", "b", "c", "9"], [], [], None, ["caf\u00e9", "rust", "ix"], ["x", "y"], ["a", "b", "c"], ["\u0663", "\u00b2"]]
    assert "octet_length(t" in df.select(words("t"))._jdf.queryExecution().optimizedPlan().toString()


def test_names_that_are_their_words_are_not_looked_up(spark):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    rows = [("Red RING, red_ring ring-red", None), ("gear", "http://x.org/old-bolt"), ("none", None), (None, None), ("\u017fmall \u212aey", None)]
    df = spark.createDataFrame(rows, "title string, url string")
    own = detect_keywords(df, Taxonomy({"A": ["red", "old", "small"], "B": ["ring", "bolt", "gear", "key"]}))
    assert [r.keywords for r in own.collect()] == [["red", "ring"], ["bolt", "gear", "old"], [], [], ["key", "small"]]
    assert "crc32" not in plan(own)
    # one name in capitals, of two words, with a pattern or beside another of its word asks for the look-up
    for names, patterns, first in ((["Red", "ring"], {}, ["Red", "ring"]), (["red", "a ring"], {}, ["red"]), (["red", "ring"], {"ring": r"\bring\b(?=-)"}, ["red", "ring"]), (["red", "Red"], {}, ["Red", "red"])):
        looked_up = detect_keywords(df, Taxonomy({"A": names}, patterns))
        assert looked_up.first().keywords == first and "crc32" in plan(looked_up)
