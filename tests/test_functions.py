import datetime
import random
import re
from urllib.parse import urlparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from risewatch.functions.numbers import round_stable
from risewatch.functions.text import match_text, term_tokens, url_text, with_bigrams, words
from risewatch.functions.time import age_hours, epoch_seconds, from_epoch_seconds, ntz, week_label

BATCH = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_week_label_follows_the_calendar(spark):
    first = datetime.date(1995, 1, 1)
    days = [first + datetime.timedelta(days=i) for i in range(12_000)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select("d", week_label("d").alias("w"))
    assert all(r.w == r.d.strftime("%Y-W%W") for r in df.collect())


def test_week_label_of_edges_and_null(spark):
    rows = ["2024-01-01", "2023-01-01", "2024-12-31 23:59:59", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    labels = df.select(week_label(F.col("t").cast("timestamp_ntz")).alias("w")).collect()
    assert [r.w for r in labels] == ["2024-W01", "2023-W00", "2024-W53", None]


def test_epoch_seconds_both_ways(spark):
    rows = [(0,), (1718877600,), (-86401,), (1710054000 + 1800,)]
    df = spark.createDataFrame(rows, "s long").withColumn("t", from_epoch_seconds("s"))
    for r in df.withColumn("back", epoch_seconds("t")).collect():
        assert r.back == r.s
        assert r.t == datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=r.s)


def test_age_hours(spark):
    df = spark.range(1).select(age_hours(ntz("2024-01-01 00:00:00"), ntz("2024-01-02 02:30:00")))
    assert df.first()[0] == 26.5


def test_round_stable_restores_ties(spark):
    df = spark.createDataFrame([(49.448749999999997,), (0.1 + 0.2,)], "x double")
    got = [r[0] for r in df.select(round_stable("x", 4)).collect()]
    assert got == [49.4488, 0.3]


def model_url_text(url):
    if not url:
        return ""
    try:
        parsed = urlparse(url)
    except ValueError:
        return ""
    return re.sub(r"[-_./]", " ", f"{parsed.netloc} {parsed.path}")


def test_url_text_of_typical_links(spark):
    urls = [
        "https://example.net/some-lang/core_lib", "http://u:p@host.example:8080/a_b.c?q=1#f", "github.com/x-y",
        "https://example.com", "https://example.com/a;p=1/b;q=2", "foo:/a;p=1", "//host/path;x",
        " \t https://e.com/a\nb", "mailto:a@b.c", "https://e.com/a b|c", "https://[::1/x", "https://x]/y",
        "", None, "a;b", "?q", "#f", "https://e.com//x//y", "tel:;x", "1http://e.com/a", "HTTPS://E.com/A;b",
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "i int, u string")
    got = {r.i: r.t for r in df.select("i", url_text("u").alias("t")).collect()}
    assert got == {i: model_url_text(u) for i, u in enumerate(urls)}


@BATCH
@given(st.lists(st.text(alphabet="ab:/?#;.-_% \t", max_size=14), min_size=50, max_size=50))
def test_url_text_like_a_url_parser(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "i int, u string")
    got = {r.i: r.t for r in df.select("i", url_text("u").alias("t")).collect()}
    for i, url in enumerate(urls):
        assert got[i] == model_url_text(url), url


def test_match_text(spark):
    rows = [("T", "https://a.b/c"), ("T", ""), ("T", None), (None, "a"), (None, None)]
    df = spark.createDataFrame(rows, "t string, u string").select(match_text("t", "u"))
    assert [r[0] for r in df.collect()] == ["T a b  c", "T", "T", "  a", ""]


ALPHABET = "aGo Rs.+#-_é9ßʼ́ İıſK"


@BATCH
@given(st.lists(st.text(alphabet=ALPHABET, max_size=20), min_size=50, max_size=50))
def test_words_like_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    fold = str.maketrans("İıſK", "iisk")
    for r in df.select("i", words("t").alias("w")).collect():
        assert r.w == re.findall(r"\w+", texts[r.i].translate(fold).lower()), texts[r.i]


def model_terms(text, stop=()):
    tokens = re.findall(r"(?u)\b[A-Za-z][A-Za-z0-9.+#\-]{1,}\b", text.lower())
    tokens = [t for t in tokens if t not in stop]
    return tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


@BATCH
@given(st.lists(st.text(alphabet="ab .+#-_é9́ ", max_size=24), min_size=50, max_size=50))
def test_terms_like_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    terms = df.withColumn("k", term_tokens("t", ["ab"])).select("i", with_bigrams(F.col("k")).alias("w"))
    for r in terms.collect():
        assert r.w == model_terms(texts[r.i], {"ab"}), texts[r.i]


def test_bigrams_bridge_stop_words(spark):
    df = spark.createDataFrame([("node.js of the c++ world",), ("a",), ("",)], "t string")
    got = [r[0] for r in df.select(with_bigrams(term_tokens("t", ["of", "the"]))).collect()]
    assert got == [["node.js", "world", "node.js world"], [], []]


def test_random_long_texts_are_split_whole(spark):
    rng = random.Random(7)
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "éa", "x_y"]) for _ in range(30_000))
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(F.size(with_bigrams(term_tokens("t")))).first()[0]
    assert got == len(model_terms(text))
