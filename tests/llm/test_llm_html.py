"""Main text of pages."""

import html
import math
import random
import re
import time

import numpy as np
import pytest

from subtide.llm import html_text
from subtide.llm.html_text import content_blocks, extract_main_text, main_text
from subtide.llm.queries import QUERIES

PAGES = [
    ("", ""),
    ("just text, no tags at all.", "just text, no tags at all."),
    ("<p>one, two.<p>three &amp; four&nbsp;five<br>six.", "one, two.\n\nthree & four five six."),
    (
        '<html><body><div class=header>Site name here.</div><div id=menu><a href=x>a</a> <a>b</a></div><div class=content><h2>Title</h2><p>First long paragraph, with text, and commas. It goes on.'
        "<p>Second one, which is long as well, I would say so.</p><pre>code  x</pre><ul><li>one item<li>two items</ul></div><div class=sidebar><p>Other stories, not this one, really, no.</p></div>"
        '<div class="comments"><p>I like it, very much, thanks.</p></div><script>if(a<b){"</p>"}</script></body>',
        "Title\n\nFirst long paragraph, with text, and commas. It goes on.\n\nSecond one, which is long as well, I would say so.\n\ncode x\n\none item\n\ntwo items",
    ),
    (
        "<body><article><header><h1>T</h1></header><p>Long text, with commas, in here. And more.</p><div class='share'>Share it</div><aside>See, also, this.</aside>"
        "<article class='comment'><p>nice one, really good one.</p></article><footer>By me, today.</footer></article><article class=teaser><p>x</p></article></body>",
        "T\n\nLong text, with commas, in here. And more.",
    ),
    ("<main><p>Main text, which is good.</p><section id=comments><p>bad, bad comment.</p></section></main>", "Main text, which is good."),
    ("<div class=content><p>Lone paragraph, but with a lot of text, here.</p></div><div class=footer>(c) me, 2020.</div>", "Lone paragraph, but with a lot of text, here."),
    ("<table><tr><td>cell, one is a long cell.<td>cell two, as well.</table>", "cell, one is a long cell.\n\ncell two, as well."),
    ("<body><div class='cookie-notice'>We use cookies, yes.</div><form><p>Your name, please.</p></form><article><p>Text &lt;b&gt; here, it is.</p>", "Text <b> here, it is."),
    ("<body class='with-sidebar'><div class='content has-sidebar'><h1>T</h1><p>Some text, which is long, and goes on.</p></div><div class='sidebar'><p>Side, text.</p></div>", "T\n\nSome text, which is long, and goes on."),
    ("<div class='page-menu-wrapper'><article><h1>T</h1><p>Some text, here it is.</p></article></div>", "T\n\nSome text, here it is."),
    ("<div class='comments-layout'><p>All the text, of the page, is in here. It really is all of it, yes.</p></div>", "All the text, of the page, is in here. It really is all of it, yes."),
    ("<article><h1>T</h1><p>Short, text.</p></article><section class='comments'><p>" + "A long, long, comment. " * 30 + "</p></section>", "T\n\nShort, text."),
    ("<div><h1>T</h1><p>Short text, but the article.</p><p>Second, part of it.</p></div><section aria-label='Comments'><p>A comment, of a reader. It goes on.</p></section>", "T\n\nShort text, but the article.\n\nSecond, part of it."),
    ("<body><p>First, paragraph.</p><div class='ad-slot'>Buy now, cheap.</div><p>Second, paragraph.</p><ul class='related'><li><a href=x>Other, story</a></li></ul></body>", "First, paragraph.\n\nSecond, paragraph."),
    ("<style>p{}</style><title>No</title><noscript>no, no.</noscript><!-- no, no --><p>Yes, it is.</p>", "Yes, it is."),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_pages(page, text):
    assert main_text(page) == text


ARTICLE = "<article><h1>T</h1><p>Some text, which is long, and goes on.</p></article>"
HEADS = [
    "<html><head><title>x</title><body>" + ARTICLE,
    "<html><head><meta charset=utf-8><title>x</title><link rel=x><style>p{}</style><script>if(a<b){}</script>" + ARTICLE,
    "<head><noscript><img src=x><p>no, no</p></noscript><template><p>no, no</p></template><title>x</title><body>" + ARTICLE + "</body>",
    "<head><title>x</title><noscript><p>no, no<body>" + ARTICLE,
    "<html><head><title>x</title></head><body>" + ARTICLE + "</body></html>",
    "<html><head><title>x</title><body></head>" + ARTICLE,
    "<head><title>x</title><img src=x>" + ARTICLE,
]


@pytest.mark.parametrize("page", HEADS)
def test_heads_end_without_their_end_tag(page):
    assert main_text(page) == "T\n\nSome text, which is long, and goes on."


def test_text_ends_a_head():
    assert main_text("<head><title>x</title>\n Some text, without a tag.") == "Some text, without a tag."


def test_rows(spark):
    rows = [(k, f"u{k}", p) for k, (p, _) in enumerate(PAGES)] + [(99, None, None), (99, None, None), (None, "u", "<p>" + "word, " * 200_000), (7, "u", "<" * 2000 + "&#0;&bogus;<p <p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS text", "1 AS n_chars")
    got = extract_main_text(frame).collect()
    assert len(got) == len(rows)
    by_id = {(r["page_id"], r["url"]): r for r in got}
    for k, (_, text) in enumerate(PAGES):
        assert by_id[k, f"u{k}"]["text"] == text
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert by_id[99, None]["text"] == ""
    assert by_id[None, "u"]["n_chars"] == 6 * 200_000 - 1
    assert extract_main_text(frame.limit(0)).count() == 0


def test_articles_of_the_test_pages(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op7_html_extraction"](spark, sf_dir).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.DOTALL).group(1)
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(filter(None, blocks))


def _parsed(page):
    parser = html_text._Pages()
    parser.feed(page)
    parser.close()
    return parser.elements, parser.blocks


def _bare(page):
    """The page without tags or names that say what its parts are."""
    return re.sub(r"<(/?)(?:nav|footer|article|main|header|aside)\b", r"<\1div", page).replace('class="ad"', 'class="x"')


def _article(page):
    article = re.search(r"<article>(.*?)(</article>|$)", page, re.DOTALL).group(1)
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(filter(None, blocks))


def test_ratios_find_articles_without_marks(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").limit(600).collect()]
    right = {threshold: sum("\n\n".join(content_blocks(*_parsed(_bare(p)), threshold)) == _article(p) for p in pages) for threshold in (-1.0, 1.0)}
    assert right[1.0] > 0.92 * len(pages)
    # Without the threshold every path would do, and small articles would take their surroundings with them.
    assert right[-1.0] < right[1.0] - 0.05 * len(pages)


def test_weights_are_the_path_ratios():
    """The same sums in plain Python, path by path and neighbour by neighbour."""
    rng = random.Random(5)
    paths = [rng.randrange(6) for _ in range(60)]
    lengths, marks, prior = ([rng.choice([0, 3, 40, 300]) for _ in paths], [rng.random() * 4 for _ in paths], [rng.choice([0, 1, 1]) for _ in paths])
    wanted = [1.0] * len(paths)
    for feature in (lengths, marks):
        ratio = [sum(f for f, q in zip(feature, paths, strict=True) if q == p) / paths.count(p) * own for p, own in zip(paths, prior, strict=True)]
        for k in range(len(paths)):
            near = [(math.exp(-((j - k) ** 2) / 2), ratio[j]) for j in range(max(0, k - 2), min(len(paths), k + 3))]
            wanted[k] *= ratio[k] * sum(w * r for w, r in near) / sum(w for w, _ in near) + 1e-9
    got = html_text.path_weights(paths, np.array(lengths), np.array(marks), np.array(prior))
    assert np.allclose(got, [w**0.25 for w in wanted])
    means = [sum(w for w, q in zip(got, paths, strict=True) if q == p) / paths.count(p) for p in paths]
    assert np.allclose(html_text.mean_by_path(paths, got), means)


@pytest.mark.parametrize("name", ["related", "share", "notice", "alert", "widget", "search", "form", "legal", "banner"])
def test_names_cost_no_paragraph_of_the_article(name):
    usual = "A paragraph of the article, with some text, and a few commas. It goes on."
    own = "A paragraph that is called so, but is of the article, as its text, and its commas, show."
    for tag in ("article", "div"):
        page = f"<body><{tag}><h1>T</h1><p>{usual}</p><p class='{name}'>{own}</p><p>{usual}</p></{tag}><footer>By me.</footer></body>"
        assert main_text(page) == f"T\n\n{usual}\n\n{own}\n\n{usual}"
    # The name of a part of the page still counts, and so does that of a paragraph without much text.
    assert main_text(f"<article><p>{usual}</p><div class='{'ad ' + name}'><p>Buy, now.</p></div><p class='{name}'>Go</p><p>{usual}</p></article>") == f"{usual}\n\n{usual}"


@pytest.mark.parametrize("piece", ["<div>a b c d.", "<div class=x><p>a, b c", "<b>a ", "<article>a b. ", "<b>a b<hr>", "<li><ul>a b", "</x></p>a b<span>"])
def test_deep_pages_take_time_in_proportion(piece):
    started = time.perf_counter()
    short = main_text(piece * 4_000)
    middle = time.perf_counter()
    long = main_text(piece * 32_000)
    ended = time.perf_counter()
    assert len(long) > 7 * len(short) - 100
    assert ended - middle < 4 * 8 * (middle - started) + 1
