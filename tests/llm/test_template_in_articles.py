"""Template inside articles, copied articles, and text beside a teaser."""

from risewatch.llm import pages

SCHEMA = "page_id long, url string, html string"


def test_boxes_in_articles_go_and_bodies_beside_teasers_stay(spark):
    box = "<section><p>About the author.</p></section>"
    teaser = "<article><h2>Read this next</h2></article>"
    copied = "<article><p>Copied article, first part.</p><p>Second part.</p></article>"
    rows = [(i, f"http://a.example/{i}", f"<main><h1>Title {i}</h1><p>Own text {i}.</p>{box}</main>") for i in range(8)]
    rows += [(20 + i, f"http://b.example/{i}", f"<div><p>The body of page {i} stands in a div.</p></div>{teaser}") for i in range(8)]
    rows += [(40 + i, f"http://c.example/{i}", f"<div>{copied}</div><p>Shown {i} times.</p>") for i in range(8)]
    got = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(8)] == [f"Title {i}\n\nOwn text {i}." for i in range(8)]
    assert [got[20 + i] for i in range(8)] == [f"The body of page {i} stands in a div." for i in range(8)]
    assert [got[40 + i] for i in range(8)] == [f"Copied article, first part.\n\nSecond part.\n\nShown {i} times." for i in range(8)]
