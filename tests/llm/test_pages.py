"""Operators over pages."""

import duckdb
import pytest

from quayside.llm import html_extract, langid, urls
from quayside.llm.oracles import OP10

PAGES = "page_id long, url string, html string, text string, host string, verdict string"
PAGE = """<!DOCTYPE html><html lang="en-GB"><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1><p>Welcome to all of our many readers wherever they may be today</p></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies to make this site better for you and everybody</div>
<main><article><div class="article-header"><h1>Real &amp; title</h1></div><p>First   para with <a href="x>y">a link</a> and
more&#8212;words.<br>After the break.<p>Ok.<div class="ad">Buy this thing today and save a lot of money on it</div>
<ul><li>One point</li><li><a href=z>Two</a></li></ul><aside>Related reading for those who want to know more</aside>
<form><label>Mail</label><input><button>Go</button></form><blockquote>Quoted</blockquote></article>
<section id="comments"><p>Great article, I liked every single bit of it and so did my friends</p></section></main>
<footer>&copy; 2020</footer></body></html>"""
WANT = ["Real & title", "First para with a link and more\u2014words. After the break.", "Ok.", "One point", "Two", "Quoted"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)


def test_article_without_the_rest(spark):
    cut = PAGE[:PAGE.index("Ok.") + 3]
    rows = [(1, "u", PAGE), (2, "u", cut + "<di"), (3, None, None), (None, "u", ""), (4, "u", "just text & more"), (1, "u", PAGE),
            (5, "u", "<p>" + "long " * 50_000 + "</p>")]
    got = html_extract.extract(frame(spark, rows)).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 7 and sum(r.page_id == 1 for r in got) == 2
    assert by[1].text == "\n\n".join(WANT) and by[1].n_chars == len(by[1].text) and by[1].lang == "en"
    assert by[2].text == "\n\n".join(WANT[:3]) and by[3].text == "" and by[None].text == ""
    assert len(by[5].text) == 50_000 * 5 - 1
    assert html_extract.extract(frame(spark, [])).count() == 0


def test_tree_fits_its_table():
    import numpy as np

    data = np.array([line.split() for line in html_extract.LABELLED.strip().splitlines()], float)
    tree = html_extract.trained()
    assert all(html_extract.keeps(tree, row[:-1]) == bool(row[-1]) for row in data)


def test_pages_without_an_article_element():
    body = "<div><a href=1>A</a> <a href=2>B</a></div><div><h2>Head</h2><p>{}</p><p>Short one here for you to read.</p><p>{}</p></div><p>c</p>"
    text = html_extract.main_text(body.format("word " * 60, "more " * 40), html_extract.trained())
    assert text.split("\n\n") == ["Head", ("word " * 60).strip(), "Short one here for you to read.", ("more " * 40).strip()]


URLS = [
    (1, "http://a.com/en/1"), (2, "https://example.com/en/x?q=/fr/"), (3, "https://WWW.Example.com/en/5#a"), (4, "ftp://x.net/es/1"),
    (5, "http://x.net/frx"), (6, "http://net/fr/"), (7, None), (8, ""), (9, "no scheme/en/"), (10, "http://b.com"), (11, "http://com/"),
    (12, "x://m.example.com/en/7"), (13, "http://notexample.com/en/7"), (14, "http://a.net?x=/es/"), (None, "http://o.org/a/b/c/d/e"),
    (1, "http://a.com/en/1"), (15, "a://b://c.net/es/"), (16, "http://x.net/en/" + "y" * 5000),
]


def test_urls_equal_the_sql(spark):
    rows = URLS + [(100 + i, f"http://h{i % 4}.net/{'es' if i % 3 else 'en'}/{i}.html") for i in range(120)]
    rows += [(300 + i, f"http://big.org/user{chr(97 + i % 26)}x{'q' * (i % 5)}/p") for i in range(90)]
    rows += [(400 + i, "http://trap.org" + "/a" * (i % 9) + f"/b{'cd'[i % 2]}" + "/z" * 30) for i in range(40)]
    rows += [(500 + i, f"http://mix.net/{w}/x/{'pqr'[i % 3]}/{i}") for i, w in enumerate(["es", "fr", "en"] * 20)]
    got = urls.judge(frame(spark, [(i, u, None) for i, u in rows])).collect()
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", rows)
    cols = ["page_id", "host", "path", "rule", "verdict", "template", "purity", "own_labels"]
    other = con.sql(OP10)
    want = sorted((tuple(r[other.columns.index(c)] for c in cols) for r in other.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == want
    by = {r.page_id: r for r in got}
    assert [by[i].rule for i in (1, 2, 3, 4, 5, 6, 7, 10, 11, 12, 13, 14)] == [
        "com/", "example.com/en/", "www.example.com/en/", "net/es/", None, "net/fr/", None, None, "com/", "example.com/en/", "com/", None]
    assert (by[3].host, by[3].path, by[14].path, by[9].host) == ("www.example.com", "/en/5", "", "")
    assert urls.judge(frame(spark, [])).count() == 0
    assert by[404].template == "/a/a/a/a/bc" + "/z" * 30


def test_templates_need_labels_of_their_own(spark):
    rows = [(i, f"http://h.net/{('es', 'fr', 'en', 'de')[i % 4]}/{i}") for i in range(400)]
    # below one wildcard most urls of x.net are blocked by a rule; those that are not follow them
    rows += [(1000 + i, f"http://x.net/{'es/' if i % 40 else ''}{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{chr(97 + i // 26)}") for i in range(400)]
    got = {r.page_id: r for r in urls.judge(frame(spark, [(*r, None) for r in rows])).collect()}
    assert all((r.verdict == "block") == (r.rule is not None) for r in got.values() if r.host == "h.net")
    assert all(r.own_labels == 0 for r in got.values() if r.host == "h.net" and r.rule is None)
    assert all(r.own_labels >= urls.OWN_LABELS and r.purity >= urls.REJECT for r in got.values() if r.rule is None and r.verdict == "block")


def test_a_merged_branch_is_rejected_by_its_labels(spark):
    # of the many branches of m.net only one has no rule of its own
    rules = [("block", "m.net", f"/{a}{b}") for a in "abcdefgh" for b in "abcdefgh"]
    rows = [(i, f"http://m.net/{a}{b}/x{i % 3}") for i, (a, b) in enumerate((a, b) for a in "abcdefgh" for b in "abcdefgh")]
    rows += [(900, "http://m.net/zz/x1"), (901, "http://m.net/zz"), (902, "http://n.net/zz/x1")]
    got = {r.page_id: r for r in urls.judge(frame(spark, [(*r, None) for r in rows]), rules).collect()}
    assert got[900].verdict == "block" and got[900].rule is None and got[900].template == "/*/+"
    assert got[902].verdict == "allow" and got[902].own_labels == 0


def test_evidence_on_pages(spark):
    from tests.llm.data import SCHEMA, documents, prose
    import random

    page = '<html lang="{}"><body><article><p>{}</p></article></body></html>'
    rows = [(i, f"http://{h}.example.{s}/x", page.format(lang, prose(random.Random(i), lang, 40)))
            for i, (lang, h, s) in enumerate([("de", "a", "de"), ("fr", "b", "fr"), ("en", "c", "com")] * 10)]
    rows += [(90, "http://a.example.de/y", None), (91, None, page.format("fr", "")), (92, "http://new.example.fr/z", "")]
    pages = html_extract.extract(frame(spark, rows))
    got = {r.page_id: r for r in langid.of_pages(pages, spark.createDataFrame(documents(150), SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang == ("de", "fr", "en")[i % 3] for i in range(30))
    assert (got[90].lang, got[91].lang, got[92].lang) == ("de", "fr", "fr")


def test_broken_markup_is_read_in_linear_time():
    import time

    for page in ('<a x="1" ' * 100_000, "<a " * 100_000 + '"', "<div>" * 50_000 + "</p>" * 50_000, '<a"' * 100_000, "<a \"<b ' " * 50_000,
                 '<a"' * 50_000 + " '>", "<" * 300_000, "<!--" * 100_000):
        start = time.monotonic()
        html_extract.blocks("<p>before the rest</p>" + page)
        assert time.monotonic() - start < 10, page[:12]


@pytest.mark.parametrize(("page", "want"), [
    ('<p class="a>b">one</p>', ["one"]), ("<p>one<b 'x>two</p>three", ["one<b 'x>two", "three"]), ("<p>a < b<c", ["a < b"]),
    ("<p>x<!-- y --> z</p>", ["x z"]), ("<p>x</p ", ["x"]), ('<p>1<a"b c">2</p>', ["12"]), ("<p>1</'>2</p>", ["12"]),
])
def test_odd_tags_are_told_from_text(page, want):
    assert [b.text for b in html_extract.blocks(page)] == want
