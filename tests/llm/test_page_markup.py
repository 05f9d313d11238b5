"""Markup that once lost text, pages in linear time, and recurrence against brute force."""

import time
from collections import defaultdict

import pytest
from test_pages import blocks

from risewatch.llm import pages

SF = "/root/testdata/sf0.1"


def test_names_that_say_nothing():
    assert blocks("<div class='content no-sidebar'><p>The body.</p></div>") == ["The body."]
    assert blocks("<div id='page-header-wrap'><p>The body.</p></div>") == ["The body."]
    assert blocks("<p class='lead-share'>Lead.</p><div id='social-policy'>Policy.</div>") == ["Lead.", "Policy."]
    assert blocks("<article><div class='article-header'><h1>Title</h1></div><p>t</p></article>") == ["Title", "t"]
    assert blocks("<div class='site-header'>x</div><div class='reader-comments'>y</div><div class='related posts'>z</div><p>t</p>") == ["t"]


def test_names_never_empty_a_page():
    assert blocks("<div class='menu'><p>All there is.</p></div>") == ["All there is."]
    assert blocks("<nav>menu</nav>") == []


def test_quotes_count_after_an_equals_sign_only():
    assert blocks("<p title=it's>Hello, don't go.</p><p>Next.</p>") == ["Hello, don't go.", "Next."]
    assert blocks("<p data-class=menu title = 'a>b'>t</p><p a=\"x>y\" 'b'>u</p>") == ["t", "u"]
    assert blocks('<p a="never closed>t</p><p>u</p>') == ["t", "u"]


@pytest.mark.parametrize("part", ["<a ", "<div>t", "<p>t<b>", "</x><div>", "<a b=\"", "<!--", "<li>t<ul>", "<table><tr>", "< <", "<p title='"])
def test_long_and_open_markup_takes_linear_time(part):
    took = []
    for n in (5_000, 40_000):
        start = time.process_time()
        page = pages.Page(part * n)
        pages.left(page.blocks, page.elements, set())
        took.append(time.process_time() - start)
        assert len(page.elements) <= 2 * n
    assert took[1] < 30 * took[0] + 0.5  # 8 times the length; a square would take 64 times


def test_given_pages_recur_as_counted_by_hand(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    parsed = pages.parsed_pages(table)
    got = {(r["row"], r["hash"]) for r in pages.recurring(parsed).collect()}
    rows = parsed.collect()
    of_host, rests, inside, size = defaultdict(set), defaultdict(set), defaultdict(bool), defaultdict(int)
    for r in rows:
        size[r["host"]] += 1
        for x in r["subtrees"]:
            key = r["host"], x["hash"]
            of_host[key].add(r["row"])
            rests[key].add(x["rest"])
            inside[key] |= x["inside"]
    want = set()
    for (host, h), found in of_host.items():
        if len(found) >= 5 and len(rests[host, h]) >= 5 and (not inside[host, h] or len(found) >= 0.5 * size[host]):
            want |= {(row, h) for row in found}
    assert got == want and want


def test_a_box_on_few_pages_of_a_large_host_goes(spark):
    rows = [(i, f"http://a.example/{i}", f"<div>Own text {i}.</div>" + "<section>Buy now!</section>" * (i < 9)) for i in range(100)]
    got = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Own text {i}." for i in range(100)}


def test_the_article_is_the_text_of_many_given_pages(spark):
    """2,500 pages, some hosts with hundreds: nothing of an article goes, nothing else stays."""
    import html
    import re

    table = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in pages.main_text(table).collect()}
    for r in table.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|div)\b[^>]*>", article)]
        assert got[r["page_id"]] == "\n\n".join(x for x in parts if x)


def test_blocks_are_not_shuffled_to_what_goes(spark):
    rows = [(i, f"https://a.example/{i}", f"<p>Same foot of the site</p><article><p>Story {i} of its own</p></article>") for i in range(40)]
    found = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many pages
        found = found.select("*")
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r["page_id"]: r["text"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "Sort " not in plan
    assert got == {i: f"Story {i} of its own" for i in range(40)}
