import html
import re
import time

import pandas as pd

from propensity.llm import html_extract as he

TREE = he.fitted()
BODY = "The river was low that summer and the boats lay on the sand for weeks. "


def text(page):
    return he.main_text(page, TREE)


def test_the_tree_learned_its_table():
    x, y = he._labelled_blocks()
    right = [he.kept(TREE, row) == bool(label) for row, label in zip(x.tolist(), y)]
    assert sum(right) >= 0.995 * len(right)

    def used(tree):
        return set() if len(tree) == 1 else {he.FEATURES[tree[0]]} | used(tree[2]) | used(tree[3])
    assert "links" in used(TREE) and {"words_before", "links_before", "words_after", "links_after"} & used(TREE)


def test_whole_table():
    """Against a plain reading of the one layout of the given pages."""
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    for page in pages.html:
        body = page.split("<article>")[1].split("</article>")[0]
        parts = (" ".join(html.unescape(re.sub(r"</?b>|<br>", "", p)).split()) for p in re.split(r"</?(?:h1|p)>", body))
        assert text(page) == "\n".join(p for p in parts if p)


def test_other_layouts():
    want = f"Title\n{BODY.strip()}\nShort."
    inner = f"<h1>Title</h1><p>{BODY}</p><p>Short.</p>"
    beside = ("<nav><a href=/>Home</a></nav>", f"<div class='cookie-notice'>{BODY}</div>", f"<aside>{BODY}</aside>",
              f"<section id=comments><article><p>{BODY}</p></article></section>", f"<form><p>{BODY}<input></form>",
              f"<div class='siteFooter'>{BODY}</div>", f"<div hidden>{BODY}</div>", f"<script>var a='<p>{BODY}</p>'</script>",
              f"<style>{BODY}</style>", f"<!-- <p>{BODY}</p> -->", f"<header><p>{BODY}</p></header>")
    for start, end in (("<article>", "</article>"), ("<main>", "</main>"), ("<div class='post-content'>", "</div>"),
                       ("<div id=story>", "</div>")):
        for b in beside:
            assert text(f"<html><body>{b}{start}{inner}{end}{b}</body></html>") == want
            if "<header>" not in b:  # within an article it holds the headline
                assert text(f"<html><body>{start}{inner}{b}{end}") == want
    for b in beside[:2]:
        assert text(f"<body>{b}<p>{BODY * 4}</p><p>{BODY * 4}</p>") == f"{(BODY * 4).strip()}\n{(BODY * 4).strip()}"


def test_wrappers_and_open_elements():
    """Names of layout parts on wrappers, elements without an end tag, layout tables."""
    body = BODY.strip() * 11
    bare, want = f"<h1>Title</h1><p>{body}</p><p>{body}</p>", f"Title\n{body}\n{body}"
    article = f"<article>{bare}</article>"
    for page in (f"<div class='layout has-sidebar'><div class=sidebar><p>x y</div>{article}</div>", f"<div id='page-with-header'>{article}</div>",
                 f"<div id=page-header>{article}</div>", f"<form id='aspnetForm'>{article}</form>", f"<form id='aspnetForm'>{bare}</form>",
                 f"<div><svg><path d=1></div>{article}", f"<svg><path d=1>{article}", f"<select><option>a{article}", f"<title>a<p>{article}",
                 f"<head><meta charset=utf-8>{article}", f"<div><template><div>x</div></div>{article}",
                 f"<table><tr><td class=menu><a href=/>a</a><td>{bare}</table>", f"<table><tr><td class=menu>a</td><td></div>{article}</table>",
                 f"<!-->{article}", f"<nav><ul><li>a<li>b</ul></nav>{article}<svg><text>drawn</text></svg>",
                 f"<p class=ad>{body}{article}", f"<ul><li class=ad>{body}<li>{article}</ul>"):
        assert text(page) == want, page[:80]


def test_layouts_left_out_of_the_table():
    """Trees learned without one layout judge its blocks."""
    right = total = 0
    for k in range(len(he._MARKED)):
        rest = he._MARKED[:k] + he._MARKED[k + 1:]
        tree = he.grow(*he._labelled_blocks(rest, he._BARE))
        x, y = he._labelled_blocks((he._MARKED[k],), ())
        right += sum(he.kept(tree, row) == bool(label) for row, label in zip(x.tolist(), y))
        total += len(y)
    assert right >= 0.9 * total


def test_quotes_in_tags():
    for page in (f"<p class=x\">{BODY}", f"<p title=it's>{BODY}", f"<p title=\"a>b\" class='c>d'>{BODY}", f"<p =\">{BODY}", f"<p a='b\"c'>{BODY}",
                 f"</ x>{BODY}", f"<p title='x>{BODY}"):
        assert text(f"<article>{page}</article>") == BODY.strip(), page[:40]


def test_cost_in_proportion():
    n = 30_000
    start = time.time()
    for page in ("<div>" * n + "x" + "</p></section>" * n, "<table>" + "<div>" * n + "<td></td>" * n, "<title>" * n, "<a b='" * n, "<!--" * n,
                 "<a =" * n, "<svg>" * n, "</" * n, "<script>" * n, "<li>" * n + "</ul>" * n):
        text(page)
    assert text("<article><p>" + BODY * 100_000) == (BODY * 100_000).strip()
    assert time.time() - start < 60  # in the square of the length it takes many minutes


def test_references_and_white_space():
    assert text("<article><p>a &amp;&lt;b&gt;  c\n\td &eacute;&#233;&#xe9; &nope; &amp</article>") == "a &<b> c d ééé &nope; &"
    assert text("<article><p>x<br>y <b>z</b><i>w</i></p></article>") == "x y zw"


def test_broken_markup():
    for page in ("", "<", "<p", "</", "<article><p>a", "<article><p title='x>a</article>", "<!-- a", "<script>a", "a <b", "<>"):
        text(page)
    assert text("<article><p>One two</div></section><p>three") == "One two\nthree"
    assert text("<article>" + "<div>" * 5000 + "deep words here") == "deep words here"


def test_rows(spark):
    rows = [(1, "u", "<article><p>é x</article>", "t"), (1, "u", "<article><p>é x</article>", "t"), (2, None, None, "t"), (None, "u", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, he.extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "é x", 3), (1, "u", "é x", 3), (2, None, "", 0), (None, "u", "", 0)], key=repr)
    assert he.extract(pages.limit(0)).count() == 0
