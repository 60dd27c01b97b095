"""Operator 3: markup that must not cost main text, and template counts against an independent count."""

import random
from collections import defaultdict
from html.parser import HTMLParser

import pytest
from llm_fixtures import SF, none, odd  # noqa: F401

from matchlake.llm import html_extract as hx


@pytest.mark.parametrize("html, text", [
    ("<div class='content with-sidebar'><p>Main text here.</p></div>", "Main text here."),
    ("<div id='page' class='has-sidebar'><p>Main text here.</p></div>", "Main text here."),
    ("<article><p>One.</p><section id='social-history'><p>Two.</p></section></article>", "One. Two."),
    ("<article><h2 id='market-share'>Shares</h2><p>One.</p></article>", "Shares One."),
    ("<article><h3 class='search'>Search</h3><p>One.</p></article>", "Search One."),
    ("<article><p>It was a <span class='notice'>marked</span> word.</p></article>", "It was a marked word."),
    ("<p>A</p><svg/><p>B</p>", "A B"), ("<p>A</p><svg viewBox='0 0 1 1' /><p>B</p>", "A B"), ("<p>A</p><math/>B", "A B"),
    ("<p>A</p><svg><text>x</text><title>y</title></svg><p>B</p>", "A B"),
    ("<div><p>A</p><video src=v></div><p>B</p>", "A B"), ("<p>A</p><video><p>B</p>", "A B"), ("<p>A</p><object><canvas><p>B</p>", "A B"),
    ("<p>A</p><video><p>no video</p></video><p>B</p>", "A B"), ("<p>A</p><noscript>no</noscript>B", "A B"),
    ("<p>A<select><option>x<option>y</select> b</p>", "A b"), ("<p>A</p><iframe>no</iframe>B", "A B"),
    ("<div class='ad'>x</div><p>The text that is meant.</p>", "The text that is meant."),
    ("<div class='sidebar'><p>The whole text of a page that is badly marked.</p></div><p>end</p>", "The whole text of a page that is badly marked. end"),
    ("<article><div class='comments'><p>rubbish</p></div><p>Some longer text stays here.</p></article>", "Some longer text stays here."),
    ("<article><div id=comments>rubbish</div><p>Some longer text stays here.</p></article>", "Some longer text stays here."),
    ("<table>" + "<tr><td><b><i>" * 100 + "x<tr><td>y</table>", "x y"),
])
def test_markup_that_must_not_cost_text(html, text):
    assert hx.Page(html).text == text


def test_end_tags_left_out_deep_inside():
    """An li that is 100 elements up is closed like one that is near."""
    spans = "<span>" * 100
    page = hx.Page(f"<ul><li>a{spans}b<li>c</ul>")
    assert page.text == "ab c" and not page.where["li"]


def page(body):
    return f"<html><body>{body}</body></html>"


def texts(spark, rows, **how):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in hx.extract(df, **how).collect()}


def test_three_pages_of_thirty_are_no_template(spark):
    rows = [(k, "http://a.example/", page(f"<div>Story {k}</div>" + ("<div>The same teaser</div>" if k < 3 else ""))) for k in range(30)]
    assert texts(spark, rows)[1] == "Story 1 The same teaser"


def test_a_menu_on_a_part_of_a_large_host(spark):
    """9 of 100 pages are no template by share; on 25 of 400 it is one by count."""
    rows = [(k, "http://a.example/", page(f"<div>Story {k} is told</div>" + ("<div>Menu</div>" if k < 25 else ""))) for k in range(400)]
    rows += [(1000 + k, "http://b.example/", page(f"<div>Story {k} is told</div>" + ("<div>Menu</div>" if k < 9 else ""))) for k in range(100)]
    out = texts(spark, rows)
    assert out[3] == "Story 3 is told" and out[1003] == "Story 3 is told Menu"


def test_near_copies_of_an_article_stay(spark):
    body = "<div><p>The first long paragraph of the story.</p><p>And the second one.</p></div>"
    rows = [(k, "http://a.example/", page(f"<div>Site name</div><article><h1>Title {k}</h1>{body}</article>")) for k in range(40)]
    rows += [(100 + k, "http://b.example/", page(f"<div>Site name</div><div><b>T {k}</b>{body}</div>")) for k in range(40)]
    out = texts(spark, rows)
    assert out[7] == "Title 7 The first long paragraph of the story. And the second one."
    assert out[107] == "T 7 The first long paragraph of the story. And the second one."


class Tree(HTMLParser):
    """Subtrees of well-formed pages as nested tuples."""

    def __init__(self):
        super().__init__()
        self.stack, self.found = [["", []]], []

    def handle_starttag(self, tag, attrs):
        self.stack.append([tag, []])

    def handle_endtag(self, tag):
        tag, parts = self.stack.pop()
        whole = (tag, *parts)
        self.stack[-1][1].append(whole)
        self.found.append(whole)

    def handle_data(self, data):
        if data.split():
            self.stack[-1][1].append(" ".join(data.split()))


def test_counts_of_subtrees_per_host(spark):
    rng = random.Random(3)
    blocks = [f"<div><p>block {k}</p><ul><li>x{k}</li></ul></div>" for k in range(6)]
    rows = []
    for k in range(120):
        host = "abc"[k % 3]
        rows.append((k, f"http://{host}.example/", page(f"<div><p>own {k} {host}</p></div>" + "".join(b for i, b in enumerate(blocks) if rng.random() < (i + 1) / 7))))
    pages_with, pages = defaultdict(set), defaultdict(set)
    for k, url, html in rows:
        tree = Tree()
        tree.feed(html)
        pages[url].add(k)
        for sub in tree.found:
            pages_with[url, sub].add(k)
    want = defaultdict(int)
    for (url, sub), on in pages_with.items():
        if sub[0] not in ("html", "body") and (len(on) >= 20 or len(on) >= 5 and 2 * len(on) >= len(pages[url])):
            want[url.split("/")[2]] += 1
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = defaultdict(int)
    for r in hx.templates(hx.parsed_pages(df)).collect():
        got[r["host"]] += 1
    assert got == want and sum(want.values()) > 20
