"""Main text: template subtrees against a plain count, the article against written-down texts."""

import re

import pytest
from pyspark.sql import functions as F

from airsight.llm import main_text as m

SCHEMA = "page_id long, url string, html string, host string, key string, templates string"


def page(body):
    return f"<!DOCTYPE html><html><head><title>no &amp; no</title><style>p{{}}</style><script>var t='</p>';</script></head><body class='has-sidebar'>{body}</body></html>"


CASES = [
    (page("<nav><ul><li>menu</ul></nav><article><h1>A &amp; B</h1><p><b>One\n two.<br>three<p>Four</article><footer>&copy; x</footer>"), "A & B One two. three Four"),
    (page("<header><h1>Site</h1></header><main><header><h2>T</h2></header>x<b>y</b> z<div class='ad-box'>buy</div><aside>s</aside></main>"), "T xy z"),
    (page("<div id='cookieNotice'>eat</div><div class='entry-content'><p>body</p><form>q<input></form></div><section id=comments><article>c</article></section>"), "body"),
    (page("<article>a<article class='comment'>c</article></article><div role=navigation>n</div>"), "a"),
    (page("<article><p>in</p><div hidden>no</div><p style='display: none'>no</p><noscript>no</noscript><textarea>no</p></textarea></article>out"), "in"),
    (page("<div>plain</div><p>text &#8364; &notanentity; &am"), "plain text € \xacanentity; &am"),
    (page("<article><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl><ul><li>f<li>g</ul></article>"), "a b c d e f g"),
    ("<article><p>cut off <a href='x", "cut off"), ("<article><p>one</p><!-- open <p>two</p>", "one"), ("no tags  at\tall", "no tags at all"),
    ('<article><p title="odd>1</p><p>2 < 3 <4', "1 2 < 3 <4"), ("<article></p></div></b>x</article>", "x"), ("", ""), (None, ""), ("<article></article>rest", ""),
    (page("<article class='post with-sidebar'><div class='article-header'><h1>T</h1></div><p>x\xa0 y</p></article>"), "T x y"),
]


def test_article(spark):
    rows = [(i, f"http://h{i}.example/", source, "x", "y", "z") for i, (source, _) in enumerate(CASES)]
    found = m.main_text(spark.createDataFrame(rows, SCHEMA)).orderBy("page_id").collect()
    assert [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in found] == [(i, f"http://h{i}.example/", t, len(t)) for i, (_, t) in enumerate(CASES)]


def test_templates_go_without_any_name(spark):
    """A site of nameless elements: only the counts tell the menu and the notice from the texts."""
    site = [(i, "http://big.example/a", f"<div>home news</div><div><p>text {i}</p><p>Er.</p><p>the notice</p></div><div>imprint {i % 2}</div>", *"xyz") for i in range(60)]
    site = [(i, u, s if i % 4 else s.replace("<p>Er.</p>", ""), *r) for i, u, s, *r in site]
    again = [(1000 + i, "https://BIG.example:80/b", "<div>copied</div><p>all of it</p>", *"xyz") for i in range(80)]  # copies count once
    few = [(2000 + i, "http://small.example/a", f"<div>home news</div><p>text {i}</p>", *"xyz") for i in range(19)]
    odd = [(None, None, "<div>home news</div><p>n</p>", *"xyz")] * 2
    found = {(r["page_id"], r["text"]) for r in m.main_text(spark.createDataFrame(site + again + few + odd, SCHEMA)).collect()}
    kept = {(i, " ".join(x for x in (f"text {i}", f"imprint {i % 2}") if x)) for i in range(60)}  # "Er." is on three pages of four
    kept |= {(1000 + i, "copied all of it") for i in range(80)} | {(2000 + i, f"home news text {i}") for i in range(19)} | {(None, "home news n")}
    assert found == kept


def test_repeating_passages_of_articles_stay(spark):
    rows = [(i, "http://s.example/", page(f"<div>bar</div><article><h1>{'Hot' if i % 3 == 0 else i}</h1><p>own {i}</p></article>"), *"xyz") for i in range(90)]
    found = {r["page_id"]: r["text"] for r in m.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i: f"{'Hot' if i % 3 == 0 else i} own {i}" for i in range(90)}


def test_counts_against_plain(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    seen, rows = {}, []
    for r in pages.collect():
        host = re.match(r"https?://([^/:?#]*)", r["url"])[1]
        article, within, outside = m.Page(r["html"]).subtrees()
        for d in within | outside:
            seen.setdefault((host, d), set()).add(article)
            rows.append((host, bytes(d), int.from_bytes(article, "big", signed=True), d in within))
    table = spark.createDataFrame(rows, "host string, subtree binary, article long, inside boolean")
    expected = {k for k, v in seen.items() if len(v) >= 2}
    assert expected
    assert {(r["host"], bytes(r["subtree"])) for r in m.site_templates(table, (2, 0.0), (2, 0.0)).collect()} == expected


def test_given_pages(spark):
    """The pages of the given tables have one article each, without nested elements: a pattern finds it too."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        blocks = [html.unescape(re.sub(r"<(?!/?p>|/?h1>)[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        expected[r["page_id"]] = " ".join(" ".join(blocks).split())
    found = {r["page_id"]: r["text"] for r in m.main_text(pages).collect()}
    assert found == expected


@pytest.mark.parametrize("source", ["<b>" * 50_000 + "x", "<div>" * 20_000 + "x", "<p>x" * 30_000, "<" * 50_000, '<a b="' * 3_000, "&amp;" * 50_000, "x " * 300_000])
def test_odd_pages_are_read_in_time(source):
    page = m.Page(source)
    page.subtrees()
    assert len(page.text()) <= len(source)


def test_hosts_and_empty_table(spark):
    urls = [("http://a.b/c", "a.b"), ("HTTPS://u:p@A.B.:8080?x", "a.b"), ("nothing", ""), (None, ""), ("ftp://x", "x")]
    found = spark.createDataFrame([(u,) for u, _ in urls], "u string").select(m.host_of(F.col("u"))).collect()
    assert [r[0] for r in found] == [h for _, h in urls]
    assert m.main_text(spark.createDataFrame([], SCHEMA)).collect() == []
