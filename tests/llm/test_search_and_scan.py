"""Nearest neighbours, licence scan, and the pipeline."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from risewatch.llm import bpe, exact, hnsw, langid, licences, mixing, queries, simhash

SF = "/root/testdata/sf0.001"


def best(rows, query, k):
    """Exact: (vec_id, score) of the k nearest of every other usable row of the same length."""
    i, v = rows[query]
    out = []
    for n, (j, w) in enumerate(rows):
        if n != query and len(w) == len(v):
            out.append((-float((v * w).sum() / (np.sqrt((w * w).sum()) * np.sqrt((v * v).sum()))), j))
    return sorted(out)[:k]


def usable(rows):
    return [(i, np.array(v, np.float64)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]


@pytest.mark.parametrize("shard_rows", [40, 4096])
def test_recall(spark, shard_rows):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = usable([(r["vec_id"], r["embedding"]) for r in table.collect()])
    got = defaultdict(list)
    for r in hnsw.nearest(table, "id % 10 = 0", shard_rows=shard_rows).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    asked = [n for n, (i, _) in enumerate(rows) if i % 10 == 0]
    assert set(got) == {rows[n][0] for n in asked}
    hits = 0
    for n in asked:
        want = best(rows, n, 5)
        found = got[rows[n][0]]
        assert [r for _, _, r in found] == [1, 2, 3, 4, 5]
        exact_scores = {j: -s for s, j in best(rows, n, len(rows))}
        assert all(abs(exact_scores[j] - s) < 1e-12 for j, s, _ in found)
        hits += len({j for _, j in want} & {j for j, _, _ in found})
    assert hits >= 0.95 * 5 * len(asked)


def test_vectors_that_take_no_part_and_ties(spark):
    one = [1.0, 2.0, 2.0]
    rows = [(i, one) for i in range(0, 300)] + [(300, None), (301, []), (302, [0.0, 0.0, 0.0]), (303, [1.0, None, 2.0]), (304, [float("nan"), 1.0, 1.0]), (305, [float("inf"), 1.0, 1.0])]
    rows += [(400, [1.0, 2.0]), (450, [2.0, 1.0]), (0, one), (500, [-1.0, -2.0, -2.0]), (None, [1.0, 2.0, 3.0]), (550, [x * 2.0**-900 for x in one])]
    frame = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, row int, dim string, shard int").repartition(4)
    got = defaultdict(list)
    for r in hnsw.nearest(frame, "id % 50 = 0", shard_rows=64).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert sorted(got[0]) == sorted([0, 1, 2, 3, 4] * 2)  # two rows with id 0, each other's nearest
    assert got[50] == [0, 0, 1, 2, 3] and got[450] == [400] and got[400] == [450] and 300 not in got
    assert len(got[500]) == 5
    assert hnsw.nearest(frame.where("false"), "id % 50 = 0").count() == 0


def test_graph_is_flat_and_found_again():
    rng = np.random.default_rng(2)
    units = hnsw._units(rng.normal(size=(700, 16)))
    graph = hnsw.Graph(units)
    assert graph.neighbours[0].shape == (700, hnsw.ROOM) and graph.neighbours[0].dtype == np.int32
    again = hnsw.Graph.stored(graph.units, graph.place, graph.neighbours, graph.counts, graph.entry, graph.height)
    hits = 0
    for q in units[:100]:
        assert graph.search(q, 40) == again.search(q, 40)
        hits += len(set(np.argsort(1 - units @ q)[:5].tolist()) & set(graph.search(q, 40)[:5]))
    assert hits >= 0.95 * 500


# --- licences -----------------------------------------------------------------


@pytest.fixture(scope="module")
def licence_model(spark, docs):
    return licences.LicenceModel(spark, docs)


def test_licences_of_given_documents(spark, licence_model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = licence_model.scan(docs).where("confirmed").select("doc_id", "family").distinct().collect()
    marks = {"MIT": "MIT License", "GPL": "GNU General Public License", "Apache-2.0": "Apache License", "CC-BY-NC": "CC BY-NC"}
    want = {(r["doc_id"], f) for r in docs.collect() for f, mark in marks.items() if mark in (r["text"] or "")}
    assert {tuple(r) for r in found} == want and want


def test_licence_accuracy_and_unknown(spark, licence_model):
    # on wordings that the model has not seen
    assert licence_model.accuracy >= 0.95 and 0.3 <= licence_model.threshold <= 0.95
    lines = [
        ("Licensed under the Mozilla Public License, version 2.0.", "MPL"),
        ("This file is released under the MIT License, see below.", "MIT"),
        ("some words before\nLicensed under CC BY-SA 4.0. And more words", "CC-BY-SA"),
        ("His boat license expired in June.", "unknown"),
        ("No words of that kind here.", None),
        ("", None),
        (None, None),
    ]
    frame = spark.createDataFrame([(i, t, "x", 0) for i, (t, _) in enumerate(lines)], "doc_id long, text string, family string, paragraph int")
    got = {r["doc_id"]: r for r in licence_model.scan(frame).collect()}
    assert {i: got[i]["family"] if i in got else None for i in range(len(lines))} == {i: f for i, (_, f) in enumerate(lines)}
    assert all(got[i]["confirmed"] == (lines[i][1] != "unknown") for i in got)
    assert licence_model.scan(frame.where("false")).count() == 0


def test_licence_scan_of_edge_rows(spark, edge, empty):
    assert licences.LicenceModel(spark, edge).scan(edge).count() == 0
    assert licences.LicenceModel(spark, empty).scan(empty).count() == 0


# --- pipeline -----------------------------------------------------------------


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "bpe"]
    steps, frames = [docs], dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(corpus_pipeline.settle(stage(spark, steps[-1], SF)))
        assert steps[-1].columns == docs.columns, name
    ids = [Counter(r["doc_id"] for r in x.select("doc_id").collect()) for x in steps]
    kept = langid.identify_documents(steps[0], langid.train(steps[0])).where("accepted").select("document.doc_id")
    assert ids[1] == Counter(r["doc_id"] for r in kept.collect()) and sum(ids[1].values()) >= 0.98 * sum(ids[0].values())
    assert ids[2] == Counter(r["keep_id"] for r in exact.exact_groups(steps[1]).where("kept").collect())
    assert ids[3] == Counter(r["component_id"] for r in simhash.near_groups(steps[2]).select("component_id").distinct().collect())
    assert ids[4] == Counter({r["doc_id"]: r["copies"] for r in mixing.mix(steps[3]).collect() if r["copies"]})
    want = bpe.token_digests(steps[4], queries.vocabulary())
    got = frames["bpe"](spark, steps[4], SF)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    whole = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, got.collect()))


def test_every_stage_takes_edge_rows_and_empty_tables(spark, edge, empty):
    for frame in (edge, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert name == "bpe" or out.columns == frame.columns
            assert out.count() <= 2 * frame.count()


def test_queries_are_registered_and_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as driver

    names = list(driver.queries())
    assert [n for n in names if n.startswith("op")] == sorted((n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0])) and "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    for name, sql in queries.ORACLE.items():
        got = driver.queries()[name](spark, SF)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        columns = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(*[F.col(c) for c in columns]).collect())
