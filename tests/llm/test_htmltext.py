import html
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from monthmill.llm import htmltext as H
from monthmill.llm.queries import op1_main_text

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head><body class="ad-free">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home, sweet home.</a></li></ul></nav><div class="cookie-notice">We use cookies, you know.</div>
{main}<aside>Side, side.</aside><form><label>Mail, please.</label><textarea>x</textarea></form><div id="comments"><p>A long reader comment, with many words, and signs!</p></div>
<div class="ads top">Buy now, cheap!</div><footer>&copy; 2026, me.</footer></body></html>"""

CASES = {
    "<article><h1>Head</h1><p>First, <b>bold</b>&nbsp;text\n  here.<br>Next.<p>Second &lt;p&gt; &#233; &eacute &am<ul><li>one<li>two</ul></article>": "Head\n\nFirst, bold text here. Next.\n\nSecond <p> é é &am\n\none\n\ntwo",
    "<main><section><h2>A</h2><p>Short.</p></section><section><p>Long text, that goes on, and on.</p></section></main>": "A\n\nShort.\n\nLong text, that goes on, and on.",
    "<article><p>Only one.</p><!-- <p>hidden</p> --><div class='share'>Share, share.</div></article>": "Only one.",
    "<div id=content><div class=post><p>Text of a page, without an article, in plain boxes.</p><p>And more of it, here.</p></div></div>": "Text of a page, without an article, in plain boxes.\n\nAnd more of it, here.",
    "": "",
    "<article></article>": "",
}


@pytest.mark.parametrize("main", CASES)
def test_pages(main):
    assert H.main_text(PAGE.format(main=main)) == CASES[main]


@pytest.mark.parametrize("page", ["", "plain text, no tags", "<", "<p", "<p>a<b>c", "</div></p>x", "<a href='>'>q</a>", "<script>never closed", "<!-- never closed", "&#xD800; &#0; x"])
def test_broken_pages(page):
    assert isinstance(H.main_text(page), str)


def test_deep_nesting():
    assert H.main_text("<article>" + "<div>" * 3000 + "Deep, text." + "</div>" * 3000 + "</article>") == "Deep, text."


def article_of(page):
    """What the given pages' generator put into the article: its blocks, cut out directly."""
    blocks = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", page, re.S)[1])
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", "\n"))).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def test_query(spark, sf):
    got = {r.page_id: r for r in op1_main_text(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == article_of(p.html) and got[p.page_id].n_chars == len(got[p.page_id].text)


def test_edges(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"), (None, "u", "<p>a, b.</p>", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, path string")
    assert sorted(r.text for r in H.extract_main_text(df).collect()) == ["", "", "", "a, b."]
    assert H.extract_main_text(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        H.extract_main_text(df, keep=["url"], output="URL")


STORY = "<p>A story, told in full, with words.</p><p>And the end of it, at last.</p>"
TOLD = "A story, told in full, with words.\n\nAnd the end of it, at last."


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>T</title><meta charset=utf-8><body>" + STORY,
        "<html><head><title>T</title><link rel=x><body><article>" + STORY + "</article></body></html>",
        "<head><title>T</title><style>p{}</style><div>" + STORY + "</div>",
        "<head><title>T</title>\n<p>A story, told in full, with words.</p><p>And the end of it, at last.</p>",
        "<head><title>T</title>A story, told in full, with words.<p>And the end of it, at last.</p>",
        "<head><template><div>No, no, no.</div></template><body>" + STORY,
        "<body><nav><ul><li><a href=/>Home.</a></ul><article>" + STORY + "</article></body>",
        "<body><div><aside>Side, side.<main>" + STORY + "</main></div></body>",
        "<body><form><input name=q><menu><li>No, no.<article>" + STORY + "</article><nav>No, no.</nav></body>",
    ],
)
def test_end_tags_left_out(page):
    assert H.main_text(page) == TOLD


def test_articles_in_closed_boilerplate_stay_out():
    assert H.main_text("<body><article>" + STORY + "</article><aside><article><p>Read on, here, and there.</p></article></aside></body>") == TOLD


LONG = " ".join(["A long text, told in many words, again and again."] * 12)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class=post><h1>Title</h1><p>A lead, in short.</p><div class=body><p>{LONG}</p><p>{LONG}</p></div></div>", f"Title\n\nA lead, in short.\n\n{LONG}\n\n{LONG}"),
        ("<div class=post><h1>Title</h1><div class=body>" + f"<p>{LONG}</p>" * 9 + "</div></div>", "\n\n".join(["Title", *[LONG] * 9])),
        (f"<div><article><h2>One</h2><p>{LONG}</p></article><article><h2>Two</h2><p>{LONG}</p><p>{LONG}</p></article></div>", f"One\n\n{LONG}\n\nTwo\n\n{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</p><p>{LONG}</p></article><article><p>{LONG}</p></article><article><p>The end, at last.</p></article>", f"{LONG}\n\n{LONG}\n\n{LONG}\n\nThe end, at last."),
        (f"<div><div class=story><p>{LONG}</p><p>{LONG}</p></div><article><p>{LONG}</p></article></div>", f"{LONG}\n\n{LONG}\n\n{LONG}"),
    ],
)
def test_all_selected_content_is_kept(page, text):
    assert H.main_text("<html><body>" + page + "<footer>Foot, foot.</footer></body></html>") == text


PLAIN = "<html><body><div>" + "".join(f"<p><a href=/{i}>Go to place {i}, now.</a></p>" for i in range(8)) + f"</div><div><h2>Title of it</h2><p>{LONG}</p><p>Short.</p><blockquote>{LONG}</blockquote></div><div>" + "".join(f"<div>Item {i}</div>" for i in range(8)) + "</div></body></html>"


def test_ratios_decide_where_no_tag_or_class_tells(monkeypatch):
    text = f"Title of it\n\n{LONG}\n\nShort.\n\n{LONG}"
    assert H.main_text(PLAIN) == text
    rng = np.random.default_rng(0)
    for spoilt in (lambda p, *_: np.ones(len(p)), lambda p, *_: rng.random(len(p)), lambda p, length, signs: -length):
        monkeypatch.setattr(H, "fused_ratios", spoilt)
        assert H.main_text(PLAIN) != text


def test_ratios_decide_on_the_given_pages(monkeypatch):
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist()
    assert all(H.main_text(p) == article_of(p) for p in pages)
    true, rng = H.fused_ratios, np.random.default_rng(0)
    for spoilt in (lambda p, *_: np.ones(len(p)), lambda p, *_: rng.random(len(p)), lambda *a: -true(*a), lambda *a: rng.permutation(true(*a))):
        monkeypatch.setattr(H, "fused_ratios", spoilt)
        assert sum(H.main_text(p) != article_of(p) for p in pages) > len(pages) / 2


@pytest.mark.parametrize(
    "page",
    [
        "<article>" + "<div>x, y." * 100_000,
        '<a href="y> ' * 83_333,
        "<a href='y> <b c=\"z> " * 45_000,
        "<a b=" * 200_000,
        "<b>" * 200_000 + "<hr>" * 100_000 + "text, at last.",
        "<div>" * 100_000 + "</span>" * 100_000 + "x, y.",
        "<aside>" * 60_000 + "<article>" * 60_000 + "x, y.",
        "<!-- " * 200_000,
        "<p>a, b.</p><br>" * 65_000,
        "<" * 1_000_000,
        "&" * 1_000_000,
    ],
)
def test_a_megabyte_of_broken_markup_takes_seconds(page):
    import time

    began = time.process_time()
    assert isinstance(H.main_text(page), str)
    assert time.process_time() - began < 10


def test_quotes():
    assert H.main_text("<p class=it's>One, two.</p><p title='a > b'>Three, four.</p><p title=\"never ends>Five, six.</p>") == "One, two.\n\nThree, four.\n\nFive, six."


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>a, b.</p>", "text", 5)], "page_id bigint, url string, html string, text string, n_chars int")
    assert [tuple(r) for r in H.extract_main_text(df).collect()] == [(1, "u", "a, b.")]
