"""One row of each group stays, repeated rows and missing ids included, without a stored copy of the documents."""

from collections import Counter

from pyspark.sql import functions as F

from risewatch.llm import shared, simhash


def test_one_row_of_each_component(edge):
    groups = simhash.near_groups(edge)
    n = groups.select("component_id", "keep_row").distinct().count()
    kept = simhash.near_deduplicated(edge)
    rows = kept.collect()
    assert kept.columns == edge.columns and len(rows) == n
    assert set(rows) <= set(edge.collect())
    named = Counter(r["component_id"] for r in groups.select("component_id", "keep_row").distinct().collect())
    assert Counter(r["doc_id"] for r in rows) == named


def test_rows_alike_in_all_columns(spark):
    """Forty copies of a row and as many of another text; ids missing and repeated."""
    rows = [(1, "a long enough text of many words here", "x")] * 40 + [(2, "quite another thing is told in this one", "x")] * 40
    rows += [(None, "a third text that has no id and stands alone", None)] * 3 + [(2, "b", "y"), (2, "b", "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(5)
    got = simhash.near_deduplicated(frame).collect()
    assert Counter((r["doc_id"], r["text"][0]) for r in got) == Counter({(1, "a"): 1, (2, "q"): 1, (None, "a"): 1, (2, "b"): 1})
    assert simhash.near_deduplicated(frame.where("false")).count() == 0


def test_texts_are_not_stored(docs, monkeypatch):
    written = []
    old = shared.settle
    for module in (shared, simhash):
        monkeypatch.setattr(module, "settle", lambda df, *a: written.append(df.columns) or old(df, *a))
    simhash.near_deduplicated(docs.withColumn("more", F.lit(1))).count()
    assert written and not any("text" in x for x in written)


def test_components_with_a_hub(spark):
    links = [(i, 10_000) for i in range(500)] + [(i, i + 1) for i in range(20_000, 20_050)]
    got = {r["node"]: r["root"] for r in shared.components(spark.createDataFrame(links, "a long, b long").repartition(9)).collect()}
    assert got == {**{i: 0 for i in [*range(1, 500), 10_000]}, **{i: 20_000 for i in range(20_001, 20_051)}}
