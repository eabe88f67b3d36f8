import time

import numpy as np

from tidemark.llm.html_text import LABELLED, blocks, extract_text, judge, main_text, trained

LONG = "words of a paragraph that is long enough to be taken for the text of a page by anyone"
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1><nav><a href="/">Home</a> <a href='/n'>News</a></nav></header>
<div class="cookie-notice">{LONG}</div><article><h1>The &amp; title</h1>
<p>First {LONG} with&nbsp;<a href="x>y">one
 link</a>.</p><!-- <p>hidden</p> --><div class="ad">{LONG}</div><p>Short.<ul><li>one<li>two</ul><p><b>Unclosed &lt;bold&gt; é&#233;</p>
<p>Last paragraph of the page.</p></article><aside><p>{LONG}</p></aside><form><p>{LONG}</p></form>
<section id="comments"><h2>Comments</h2><p>{LONG}</p></section><footer>&copy; {LONG}</footer></body></html>"""


def test_article_is_kept_and_the_rest_dropped():
    got = main_text(PAGE, trained()).split("\n\n")
    assert got == [
        "The & title", f"First {LONG} with one link.", "Short.", "one", "two", "Unclosed <bold> éé", "Last paragraph of the page.",
    ]


def test_page_without_regions():
    page = f"<body><div><a href=/a>A</a><a href=/b>B</a></div><div>{LONG} one</div><div>{LONG} two</div><div>{LONG} three</div><div><a href=/c>C c</a></div></body>"
    assert main_text(page, trained()) == "\n\n".join(f"{LONG} {k}" for k in ("one", "two", "three"))


def test_tree_fits_its_table():
    tree = trained()
    rows = np.array(LABELLED)
    right = sum(judge(tree, tuple(r[:-1])) == bool(r[-1]) for r in rows)
    assert right >= 0.95 * len(rows)


def test_odd_pages(spark):
    pages = [None, "", "no tags at all", "<", "<p", "<!-- open", "<script>never ends", "<p>a" * 3000, "</p></div>", "<a href='", "&#0;&#xD800;&bogus;", "< p > x"]
    df = spark.createDataFrame([(i, None, p, "x") for i, p in enumerate([*pages, PAGE, PAGE])], "page_id long, url string, html string, text string")
    got = extract_text(df).collect()
    assert len(got) == len(pages) + 2
    assert all(r.n_chars == len(r.text) for r in got)
    assert got[0].text == got[1].text == "" and all(len(blocks(p or "")) >= 0 for p in pages)
    assert extract_text(df.limit(0)).count() == 0


def test_nothing_of_an_article_is_lost():
    page = f"""<article><header><h1>Title</h1><p>By A Writer</p></header><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p>
<noscript><p>{LONG} plain</p></noscript><p>{LONG} <object>in words</object><audio>a sound</audio></p></article><header>Site</header>"""
    got = main_text(page, trained()).split("\n\n")
    assert got == ["Title", "By A Writer", f"{LONG} x=2", f"{LONG} plain", f"{LONG} in wordsa sound"]


def test_words_and_links_decide_without_classes():
    text = [f"{LONG} {k}" for k in range(4)] + ["A short one in between.", f"{LONG} end {LONG}"]
    page = (
        '<body><div><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></div><div>Buy this now, it is cheap.</div>'
        f"<div><h1>A title of the page</h1>{''.join(f'<p>{t}</p>' for t in text)}</div>"
        f"<div><h2>Comments</h2><p>{LONG}</p><p>{LONG}</p></div><div>&copy; 2024 by someone</div></body>"
    )
    assert main_text(page, trained()).split("\n\n") == ["A title of the page", *text]


def test_a_heading_ends_only_the_box_it_opens():
    page = f"<div><p>{LONG} one</p><h2>Related</h2><p>{LONG} two</p></div>"
    assert main_text(page, trained()) == f"{LONG} one\n\n{LONG} two"


def test_time_grows_with_the_page_alone():
    tree = trained()
    pages = ["".join(f"<div>w{k}" for k in range(40_000)), "<textarea>a" * 40_000, "<p>a</div>" * 40_000, "<div><p>a</b>" * 40_000]
    for page in pages:
        start = time.monotonic()
        main_text(page, tree)
        assert time.monotonic() - start < 10
