"""Row numbers stay the same when a table is split in another way between two reads."""

from collections import Counter

import pytest

from risewatch.llm import exact, hnsw, repeats, simhash

SPLITS = "spark.sql.files.openCostInBytes"


@pytest.fixture
def resplit(spark):
    """Runs a query that is planned with a split per file, and read out with few splits of several files."""
    old = spark.conf.get(SPLITS)

    def run(query, docs):
        try:
            spark.conf.set(SPLITS, str(1 << 30))
            out = query(docs)
            spark.conf.set(SPLITS, "1")
            spark.conf.set("spark.sql.files.minPartitionNum", "1")
            return [tuple(r) for r in out.collect()]
        finally:
            spark.conf.set(SPLITS, old)
            spark.conf.unset("spark.sql.files.minPartitionNum")

    return run


@pytest.fixture
def copies(spark, tmp_path):
    """Each text twice, the files with the later copies among those with the first."""
    texts = [" ".join(f"word{i}x{j}" for j in range(60)) for i in range(20)]
    rows = [(i, texts[i % 20]) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(7, "doc_id").write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


@pytest.mark.parametrize("query", [exact.exact_deduplicated, simhash.near_deduplicated])
def test_the_right_copies_go(resplit, copies, query):
    assert sorted(i for i, _ in resplit(query, copies)) == list(range(20))


def test_passages_are_cut_from_their_own_text(spark, resplit, tmp_path):
    passage = "".join(f"passage {i} " for i in range(40))
    rows = [(i, passage + f"end {i}" if i % 5 == 0 else f"short {i} " * (i + 30)) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(7, "doc_id").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    want = Counter(tuple(r) for r in repeats.without_repeats(docs).collect())
    assert Counter(resplit(repeats.without_repeats, docs)) == want
    assert all(r[2] >= len(passage) for r in want if r[0] % 5 == 0)


def test_no_vector_is_its_own_neighbour(spark, resplit, tmp_path):
    rows = [(i, [float(i % 7 + 1), float(i % 11 + 1), float(i % 13 + 1)]) for i in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7, "vec_id").write.parquet(str(tmp_path / "vectors"))
    vectors = spark.read.parquet(str(tmp_path / "vectors"))
    got = resplit(lambda x: hnsw.nearest(x, "id % 10 = 0"), vectors)
    assert len(got) == 30 and all(q != v for q, _, v, _ in got)
