import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, hash string, slot int, language string, size string, document string"


def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, shared passages."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    passage = "The quick brown fox jumps over the lazy dog while seven wizards brew a potion of uncommon strength. " * 3
    texts = [None, "", " \t\n", "a b c", "a\tb  c", "abc", "A B C", None, "one", long, long + " end", passage + "first", "second " + passage, "x" * 450, "Straße 漢字 😀 naïve", "a b c"]
    rows = [(i, t, "en", ["s1", "s2", None][i % 3]) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id", None, "s1"), (None, "a b c", "en", None), (99, "lonely words here", None, "s3")]
    return [(*r, None, 7, "h", 1, "xx", "big", "d") for r in rows]


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "docs")
    spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
