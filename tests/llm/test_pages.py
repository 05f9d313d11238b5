"""Main text and language of pages."""

import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from risewatch.llm import langid, pages

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, row long, host string, packed string"


def blocks(page):
    found = pages.Page(page)
    return [x for x in pages.left(found.blocks, found.elements, set()).split("\n\n") if x]


def test_given_pages_against_a_split_of_their_article(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in pages.main_text(table).collect()}
    rows = table.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|div)\b[^>]*>", article)]
        want = "\n\n".join(x for x in parts if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]


def test_markup():
    assert blocks("<p>a &amp; b&nbsp;&lt;c&gt; &#233;<br>d\n\t e</p>") == ["a & b <c> é d e"]
    assert blocks("<ul><li>one<li>two <b>bold</ul>tail") == ["one", "two bold", "tail"]
    assert blocks("<p>x<p>y<div>z</div>w") == ["x", "y", "z", "w"]
    assert blocks("<script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>") == ["yes"]
    assert blocks("<nav>menu</nav><header>h</header><p>t</p><aside>s</aside><form>f<input></form><footer>c</footer>") == ["t"]
    assert blocks('<div class="cookie-notice">n</div><div id="comments"><p>c</p></div><div class="adventure">kept</div><p hidden>h</p>') == ["kept"]
    assert blocks("<article><header><h1>Title</h1></header><p>a</p><div class=comments>c</div></article>") == ["Title", "a"]
    assert blocks("1 < 2 and <b>3</b>") == ["1 < 2 and 3"]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert blocks("<p title='a>b' class=\"x\">t</p>") == ["t"]
    for text in (None, "", "   ", "<", "<p", "</p>", "<!--", "<script>"):
        assert isinstance(blocks(text), list)


def test_site_template_goes_and_repeated_articles_stay(spark):
    box = "<div><p>Read our other site today.</p></div>"
    rows = [(i, f"http://a.example/{i}", f"<html><body>{box}<p>Own text {i}.</p></body></html>", 1, "x", "y") for i in range(8)]
    rows += [(20 + i, f"http://b.example/{i}", f"<html><body>{box}<p>Other text {i}.</p></body></html>", 1, "x", "y") for i in range(2)]
    rows += [(40 + i, f"http://c.example/{i}", "<article><p>The same article.</p></article>", 1, "x", "y") for i in range(9)]
    rows += [(60, None, None, 1, "x", "y"), (60, None, None, 1, "x", "y"), (None, "nonsense", "", 1, "x", "y"), (61, "http://a.example/z", "<p>" + "long words " * 40_000 + "</p>", 1, "x", "y")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in pages.main_text(frame).collect()]
    texts = dict((i, t) for i, t, _ in got)
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    assert [texts[i] for i in range(8)] == [f"Own text {i}." for i in range(8)]
    assert texts[20] == "Read our other site today.\n\nOther text 0."
    assert texts[45] == "The same article." and texts[60] == texts[None] == "" and len(texts[61]) == 440_000 - 1
    assert pages.main_text(frame.where("false")).count() == 0


# --- language -----------------------------------------------------------------


def test_held_out_accuracy(docs):
    """Trained on half of the documents, right on the other half."""
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    model = langid.train(docs.where(half == 0))
    assert model.languages == ["de", "en", "es", "fr"]
    got = langid.identify_documents(docs.where((half == 1) & (F.length("text") > 20)), model).select("document.lang", "language", "accepted").collect()
    right = np.mean([r["lang"] == r["language"] for r in got])
    assert right >= 0.97 and np.mean([r["accepted"] for r in got]) >= 0.97


def test_evidence_is_fused(spark, docs):
    """Without text, the declaration and the host decide; a text that is clear stands against both."""
    model = langid.train(docs)
    german = docs.where("lang = 'de'").limit(60).select(F.concat(F.lit("<html lang='de'><p>"), "text").alias("html"))
    french = docs.where("lang = 'fr'").limit(60).select(F.concat(F.lit("<html lang=fr-FR><p>"), "text").alias("html"))
    rows = german.withColumn("url", F.lit("http://x.example.de/a")).union(french.withColumn("url", F.lit("http://user@y.example.fr:80/b"))).withColumn("page_id", F.monotonically_increasing_id())
    extra = spark.createDataFrame([("<html lang=de></html>", "http://x.example.de/z", -1), (None, "http://y.example.fr", -2), ("<html lang='de'>", "http://y.example.fr", -4)], "html string, url string, page_id long")
    clear = french.limit(1).withColumn("url", F.lit("http://x.example.de/")).withColumn("page_id", F.lit(-3).cast("long"))
    got = {r["page_id"]: r for r in langid.identify_pages(rows.union(extra).union(clear).withColumn("language", F.lit("clash")), model).collect()}
    assert got[-1]["language"] == "de" and got[-1]["accepted"] and got[-2]["language"] == "fr" and got[-3]["language"] == "fr"
    assert got[-3]["declared"] == "fr" and got[-2]["host"] == "y.example.fr"


def test_fusion_against_plain_arithmetic(spark, docs):
    model = langid.train(docs)
    rows = [("a", "de", "x.one.de"), ("b", "", "x.one.de"), ("c", "fr", "y.one.de"), ("d", "fr", ""), ("a", "de", "x.one.de")]
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(5).collect()]
    data = [(t[:9], d, h) for t, (_, d, h) in zip(texts, rows, strict=True)]
    frame = spark.createDataFrame(data, "text string, declared string, host string")
    got = {(r["text"], r["declared"], r["host"]): r for r in langid._identify(frame, model, 0.5, "text").collect()}
    e = np.array([model.evidence(t) for t, _, _ in data])
    p = np.exp(e) / np.exp(e).sum(1, keepdims=True)
    whole = p.sum(0)
    share = (whole + 1) / (len(data) + 4)

    def likelihood(values, i):
        sums = p[[v == values[i] for v in values]].sum(0)
        return (sums + langid.EVIDENCE_WEIGHT * sums.sum() / len(data)) / (whole + langid.EVIDENCE_WEIGHT)

    domains = [".".join(h.split(".")[-2:]) for _, _, h in data]
    for i, (_, d, h) in enumerate(data):
        domain, host = (p[[x == y for x in v]].sum(0) for v, y in ((domains, domains[i]), ([x[2] for x in data], h)))
        by_domain = (domain - p[i] + langid.DOMAIN_WEIGHT * share) / (domain.sum() - 1 + langid.DOMAIN_WEIGHT)
        prior = (host - p[i] + langid.HOST_WEIGHT * by_domain) / (host.sum() - 1 + langid.HOST_WEIGHT)
        logs = e[i] + np.log(likelihood([x[1] for x in data], i)) + np.log(likelihood([x[2].split(".")[-1] for x in data], i)) + np.log(prior)
        r = got[data[i]]
        assert r["language"] == model.languages[int(np.argmax(logs))]
        assert abs(r["probability"] - 1 / np.exp(logs - logs.max()).sum()) < 1e-9


@pytest.mark.parametrize("foreign", ["fr", "es"])
def test_foreign_texts_and_noise_are_rejected(spark, docs, foreign):
    """A language that the model has not seen, and letters at random; digits and short texts are no reason."""
    model = langid.train(docs.where(F.col("lang") != foreign))
    got = langid.identify_documents(docs.where(F.length("text") > 60), model).select("document.lang", "accepted").collect()
    known = [r["accepted"] for r in got if r["lang"] != foreign]
    other = [r["accepted"] for r in got if r["lang"] == foreign]
    assert np.mean(known) >= 0.97 and other and np.mean(other) <= 0.05
    rng = np.random.default_rng(5)
    noise = "".join(chr(c) for c in rng.integers(97, 123, 300))
    english = docs.where("lang = 'en' and length(text) > 300").first()["text"]
    rows = [(1, noise), (2, "Привет, мир: это русский текст о погоде в городе."), (3, english), (4, english[:12]), (5, english + " 4407620926593142" * 40)]
    frame = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    found = {r["doc_id"]: r["accepted"] for r in langid.identify_documents(frame, langid.train(docs)).select("document.doc_id", "accepted").collect()}
    assert not found[1] and not found[2] and found[3] and found[5]


def test_language_edge_cases(edge, empty):
    model = langid.train(edge)
    out = langid.identify_documents(edge, model)
    assert out.count() == edge.count() and out.select("document.*").columns == edge.columns
    assert langid.identify_documents(empty, model).count() == 0
    none = langid.train(empty)
    assert none.languages == ["und"] and langid.identify_documents(edge, none).where("accepted").count() == 0
