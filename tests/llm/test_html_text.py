"""Main text of pages: hand-made layouts, and every page against the marked article."""

from __future__ import annotations

import html
import re

import pytest

from millrace.llm import html_text
from millrace.llm.queries import QUERIES

PRIOR = html_text.Weights()


@pytest.mark.parametrize("source,text", [
    (None, ""),
    ("", ""),
    ("just words", "just words"),
    ("<p>a<b>b</b>c</p>d", "abc\n\nd"),
    ("<article><p>one &amp; two&nbsp;\n three</p></article>", "one & two three"),
    ("<div class=sidebar>x y</div><div>main <a href=x>link</a> more words</div><div id='comments'>bad</div>",
     "main link more words"),
    ("<nav><a>home</a></nav><p>open <p>two<script>if(a<b){'</p>'}</script><style>p{}</style> three <!-- x --> four",
     "open\n\ntwo three four"),
    ("<article><h1>Head line</h1><p>one has four words</p><div class='ad'>buy</div><p>two has four words</p><form><label>mail</label></form>"
     "<section class='comments'><article class=comment>hi</article></section></article><footer>f</footer>",
     "Head line\n\none has four words\n\ntwo has four words"),
    ("<div class='cookie-notice'>we use</div><main><p>text here</p><aside>more</aside></main>", "text here"),
    ("<ul><li>one item<li>two items</ul>", "one item\n\ntwo items"),
    ("<p>&lt;b&gt; stays &#233; &copy</p><p hidden>no</p>", "<b> stays é ©"),
    ("<p>x <b>y<br>z</p>", "x y z"),
    ("</p></div>x<p", "x"),
    ("<article><p>one two three</p><p><a>fully linked paragraph of six words</a></p><p>four five</p></article>",
     "one two three\n\nfully linked paragraph of six words\n\nfour five"),
    ("<div><p>one two three four</p><p><a>linked line</a></p><p>five six seven</p></div>",
     "one two three four\n\nlinked line\n\nfive six seven"),
    ("<div><p>one two three four</p><ul><li><a>home</a><li><a>news</a></ul><p>five six seven</p></div>",
     "one two three four\n\nfive six seven"),
])
def test_layouts(source, text):
    assert html_text.main_text(source, PRIOR) == text


def test_best_region_by_brute_force():
    for scores in ([], [-1.0], [1, -2, 3, -1, 2, -5, 4], [0, 0], [2, -1, -1, 2], [5, -9, 5]):
        first, last = html_text.best_region(scores)
        best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1)), default=0)
        assert sum(scores[first:last]) == max(best, 0)


def test_long_and_broken_pages_end():
    assert html_text.main_text("<p>a b c</p>" * 20_000, PRIOR).count("\n\n") == 19_999
    assert html_text.main_text('<a "' * 2_000 + "x", PRIOR) is not None
    assert html_text.main_text("<p>" * 3_000 + "<div>" * 3_000 + "deep words", PRIOR) == "deep words"


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>Hi there</p>"), (3, "u", "<p>Hi there</p>"), (None, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as zone")
    weights = html_text.fit(pages)
    got = sorted((tuple(r) for r in html_text.extract(pages, weights).collect()), key=repr)
    want = [(1, "u", ""), (2, None, ""), (3, "u", "Hi there"), (3, "u", "Hi there"), (None, "u", "x")]
    assert got == sorted(want, key=repr)
    assert html_text.extract(pages.limit(0), html_text.fit(pages.limit(0))).count() == 0


def test_query_finds_the_marked_article_of_every_page(spark, small):
    sources = {r["page_id"]: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = QUERIES["op1_html"](spark, small).collect()
    assert len(rows) == len(sources)
    for row in rows:
        inner = re.search(r"<article>(.*)</article>", sources[row["page_id"]]["html"], re.DOTALL)[1]
        blocks = (html.unescape(re.sub("<[^>]+>", "", b)) for b in re.split(r"</?(?:p|h1|br)>", inner))
        assert row["text"] == "\n\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)
        assert row["n_chars"] == len(row["text"]) and row["url"] == sources[row["page_id"]]["url"]


@pytest.mark.parametrize("insert", ["<form>{}</form>", "<div class=ad><p>{}</p></div>", "<aside><ul><li>{}</ul></aside>"])
def test_inserts_longer_than_the_parts_around_them(insert):
    intro, body, end = ("in " * 20).strip(), ("body " * 200).strip(), ("end " * 5).strip()
    short, long = insert.format("sign up " * 15), insert.format("buy now " * 400)
    page = f"<nav>home</nav><article><p>{intro}</p>{short}<p>{body}</p>{long}<p>{end}</p></article><footer>f</footer>"
    assert html_text.main_text(page, PRIOR).split() == f"{intro} {body} {end}".split()


def test_inserts_on_pages_without_a_marked_article():
    intro, body = ("in " * 20).strip(), ("body " * 100).strip()
    box = "<div class=newsletter>{}</div>".format("sign up now " * 150)
    page = f"<div class=nav>home news</div><div id=x><p>{intro}</p>{box}<p>{body}</p></div>"
    assert html_text.main_text(page, PRIOR) == f"{intro}\n\n{body}"
    named = f"<body><p>Site name</p><nav>{'menu item ' * 40}</nav><p>{body}</p></body>"
    assert html_text.main_text(named, PRIOR) == body
