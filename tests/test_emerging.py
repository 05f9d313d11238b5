import math
import random
from collections import Counter, defaultdict

from test_functions import model_terms

from risewatch.operators.emerging import (
    SPREAD,
    _slot_by_size,
    default_stop_words,
    emerging_terms,
    term_counts,
    terms_by_document,
    tfidf_scores,
    top_terms,
)
from risewatch.taxonomy import Taxonomy


def model_tfidf(texts, stop, min_docs):
    docs = [Counter(model_terms(t, stop)) for t in texts]
    df = Counter(term for doc in docs for term in doc)
    n = len(texts)
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items() if d >= min_docs}
    scores = defaultdict(float)
    for doc in docs:
        weights = {t: tf * idf[t] for t, tf in doc.items() if t in idf}
        length = math.sqrt(sum(w * w for w in weights.values()))
        for t, w in weights.items():
            scores[t] += w / length
    return dict(scores)


def test_scores_against_a_model(spark):
    rng = random.Random(3)
    vocabulary = ["rust", "the", "web", "node.js", "c++", "of", "fast", "gpt-4", "x"]
    rows = [
        (g, i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9))))
        for g in ("a", "b") for i in range(60)
    ]
    docs = spark.createDataFrame([*rows, ("a", 999, None)], "g string, d int, t string")
    stop = default_stop_words()
    got = defaultdict(dict)
    for r in tfidf_scores(docs, "g", "d", "t").collect():
        got[r.g][r.term] = r.tfidf_score
    for g in ("a", "b"):
        want = model_tfidf([t for k, _, t in rows if k == g], set(stop), 5)
        assert got[g].keys() == want.keys()
        assert all(abs(got[g][t] - want[t]) < 1e-9 for t in want)


def test_too_few_documents_give_nothing(spark, make_stories):
    stories = make_stories([(i, "rust web", 1, 1, "2024-01-15") for i in range(4)])
    assert emerging_terms(stories, Taxonomy({})).count() == 0


def test_known_names_are_left_out_but_not_their_pairs(spark, make_stories):
    stories = make_stories([(i, "Python tutorial", 1, 1, "2024-01-15") for i in range(5)])
    rows = emerging_terms(stories, Taxonomy({"L": ["Python"]})).collect()
    assert {r.term for r in rows} == {"tutorial", "python tutorial"}
    assert {r.iso_week for r in rows} == {"2024-W03"}


def test_ties_go_to_the_first_in_the_alphabet(spark):
    scores = spark.createDataFrame(
        [("w", t, 1.0 + 1e-12 * i) for i, t in enumerate("dbca")], "iso_week string, term string, tfidf_score double"
    )
    assert sorted(r.term for r in top_terms(scores, Taxonomy({}), top=2).collect()) == ["a", "b"]


def test_terms_are_counted_in_the_row(spark):
    docs = spark.createDataFrame(
        [("a", 1, "web rust web"), ("a", 2, "web"), ("a", 2, "web fast"), ("a", 3, ""), ("a", 4, None), ("b", 1, "web")],
        "g string, d int, t string",
    )
    counts = term_counts(terms_by_document(docs, "g", "d", "t", []), "g", "d")
    assert sorted(map(tuple, counts.collect())) == [
        ("a", 1, "rust", 1), ("a", 1, "rust web", 1), ("a", 1, "web", 2), ("a", 1, "web rust", 1),
        ("a", 2, "fast", 1), ("a", 2, "web", 2), ("a", 2, "web fast", 1), ("b", 1, "web", 1),
    ]
    # no table of a task's documents and terms: only rows that share a document are grouped
    alone = term_counts(terms_by_document(docs, "g", "d", "t", []), "g", "d", unique=True)
    assert "Aggregate" not in alone._jdf.queryExecution().executedPlan().toString()


def test_texts_are_dealt_to_many_parts(spark):
    docs = spark.createDataFrame([("a", 1, "web")], "g string, d int, t string")
    assert terms_by_document(docs, "g", "d", "t", []).rdd.getNumPartitions() == SPREAD


def test_shuffles_of_terms_have_their_own_parts(spark):
    docs = spark.createDataFrame([("a", i, "web rust") for i in range(9)], "g string, d int, t string")
    plan = tfidf_scores(docs, "g", "d", "t", unique=True)._jdf.queryExecution().executedPlan().toString()
    # few default partitions do not make a task keep more terms
    assert plan.count(f", {SPREAD}), REPARTITION_BY_NUM") == 5
    assert "ShuffledHashJoin" in plan


def test_counts_are_not_shuffled(spark):
    docs = spark.createDataFrame([("a", i, f"web rust w{i % 3}") for i in range(40)], "g string, d int, t string")
    # large tables are not broadcast
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = tfidf_scores(docs, "g", "d", "t")
        assert scores.count() > 0
        plan = tfidf_scores(docs, "g", "d", "t", unique=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # no row of document and term, which has its tf, comes out of a shuffle by document or by term
    deals = [line for line in plan.splitlines() if "Exchange " in line]
    assert deals and not [x for x in deals if "hashpartitioning(g" in x and ("d#" in x or "_slot" in x)]
    assert not [x for x in deals if "hashpartitioning(_slot" in x]
    assert sum("shufflepartitionidpassthrough" in x for x in deals) == 3


def test_copies_and_nulls_score_as_their_document(spark):
    """Rows that share a document are one document for its length, each of them one for the frequencies."""
    rows = [("a", i, f"web rust w{i % 4}") for i in range(30)] + [("b", i, "web fast") for i in range(5)]
    rows += [("a", 3, "web web go"), ("a", 3, "go rust"), ("a", None, "web go"), ("a", None, "go fast"), (None, 1, "web")]
    rows += [("a", 50, ""), ("b", 6, None), ("b", 7, "-- 1")]
    docs = spark.createDataFrame(rows, "g string, d int, t string")
    got = {(r.g, r.term): (r.df, r.tfidf_score) for r in tfidf_scores(docs, "g", "d", "t", min_docs=3, stop_words=[]).collect()}
    want = {}
    for g in ("a", "b"):
        texts = [(d, Counter(model_terms(t, set()))) for k, d, t in rows if k == g and t is not None]
        df = Counter(term for _, terms in texts for term in terms)
        idf = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in df.items() if n >= 3}
        merged = defaultdict(Counter)
        for d, terms in texts:
            merged[d].update(terms)
        for terms in merged.values():
            weights = {t: n * idf[t] for t, n in terms.items() if t in idf}
            length = math.sqrt(sum(w * w for w in weights.values()))
            for t, w in weights.items():
                want[g, t] = (df[t], want.get((g, t), (0, 0.0))[1] + w / length)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_large_groups_get_parts_by_their_share(spark):
    docs = spark.createDataFrame(
        [(g, i, "web") for g, n in (("a", 600), ("b", 395), ("c", 5)) for i in range(n)], "g string, d int, t string"
    )
    placed = docs.select("g", _slot_by_size(docs, "g", "d", "t").alias("part")).distinct().collect()
    parts = {g: {r.part for r in placed if r.g == g} for g in "abc"}
    assert parts["a"] <= set(range(153)) and len(parts["a"]) > 130
    assert parts["b"] <= set(range(153, 254)) and len(parts["b"]) > 80
    assert len(parts["c"]) == 1
