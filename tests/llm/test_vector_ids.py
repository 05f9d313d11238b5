"""Ids of vectors come back as they went in."""

from risewatch.llm import hnsw


def test_large_ids_and_rows_without_id(spark):
    big = [2**60 + 1, 2**60 + 3, 2**53 + 1, -(2**62) + 1, 50]
    rows = [(i, [1.0, float(n)]) for n, i in enumerate(big)] + [(None, [1.0, 0.1]), (None, [1.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = hnsw.nearest(frame, "id % 50 = 0 or id > 1000000").collect()
    assert {r["query_id"] for r in got} == {i for i in big if i > 0}
    for query in {r["query_id"] for r in got}:
        assert sorted(r["vec_id"] for r in got if r["query_id"] == query) == sorted(set(big) - {query})
