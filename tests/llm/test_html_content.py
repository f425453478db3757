from __future__ import annotations

import itertools
import math
import time

import pytest

from spineloom.llm import html_content as H
from spineloom.llm.dom import parse

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href='x>y'>More</a></ul></nav><!-- a > b --><div class="ad">Buy this, now.</div>
<article><h1>A title of the page</h1><p><b>First paragraph, with a &amp; b &lt;c&gt;.<br>Same   block
still.<p>Second one, quite long enough to read, says more.<ul><li>Point one here<li>Point two here</ul></article>
<footer>&copy; host &middot; Words at the end.</footer></body></html>"""


def model():
    return H.Model.from_counts(H.layout_counts())


def test_text_of_blocks():
    assert H.main_text(PAGE, model()).split("\n") == [
        "A title of the page",
        "First paragraph, with a & b <c>. Same block still.",
        "Second one, quite long enough to read, says more.",
        "Point one here",
        "Point two here",
    ]


TEXT = "It was late in the year, and the road was wet. Nobody came. "


def body(inside):
    nav = '<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>'
    return f"<html><head><title>x</title></head><body>{nav}{inside}<footer>&copy; host, 2024.</footer></body></html>"


def test_parts_of_many_layouts():
    """Every other part of these pages goes, every block that says "keep" stays."""
    keep, other = f"<p>keep {TEXT}</p>", f"<p>{TEXT}</p>"
    lists = "<ul><li>keep one point here</li><li>keep two</li></ul><table><tr><td>keep a</td><td>keep b</td></tr></table>"
    pages = [
        f"<article><h1>keep head</h1>{keep}{lists}<blockquote>keep {TEXT}</blockquote></article>",
        f'<article>{keep}<section class="comments">{other}</section></article>',
        f'<article>{keep}</article><section class="comments"><h2>Comments</h2><div class="comment">{other}</div></section>',
        f'<article>{keep}</article><div id="comments">{other}{other}</div>',
        f'<aside class="sidebar">{other}</aside><article>{keep}<aside>{other}</aside>{keep}</article>',
        f'<div class="cookie-notice">{TEXT}</div><article>{keep}<div class="ad">{TEXT}</div>{keep}</article>',
        f"<article>{keep}<form><p>Sign up now</p></form></article><form><label>Mail</label><input></form>",
        f'<header><h1>Site</h1></header><main><h1>keep head</h1>{keep}</main>',
        f'<div class="sidebar"><ul><li><a href="x">l</a></li></ul></div><div id="main-content"><h2>keep head</h2>{keep}</div>',
        f"<h1>keep head</h1>{keep}{keep}",
        f"<article><section><h2>keep part</h2>{keep}</section><div>{keep}</div></article>",
    ]
    for page in pages:
        found = H.main_text(body(page), model()).split("\n")
        assert len(found) == page.count("keep") and all(block.startswith("keep") for block in found), page


def test_broken_and_empty_pages():
    for html in (None, "", "<", "<p", "<p a='", "</div></p>", "<script>never closed", "<!-- open", "a<b>c</i>", "<>&#0;&bogus;"):
        assert isinstance(H.main_text(html, model()), str)
    deep = "<div>" * 5000 + "text" + "</div>" * 10
    assert parse(deep).blocks == [(5000, "text")]
    assert [t for _, t in parse("<table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl>").blocks] == ["a", "b", "c", "d", "e"]


HARD = {
    "quotes that never close": '<p "',
    "attributes that never end": '<b a="',
    "ends in quotes only": '<a ">"',
    "both quotes": "<p '\"",
    "declarations without end": "<!",
    "instructions without end": "<?x",
    "deep nests": "<div>",
    "elements that could end a paragraph": "<li><center>",
    "paragraphs": "<p>",
    "closing tags of nothing": "</x>",
}


@pytest.mark.parametrize("name", HARD)
def test_time_follows_the_size_of_the_page(name):
    """Two megabytes of what is hard to read; reading them anew for each tag would take hours."""
    unit = HARD[name]
    started = time.perf_counter()
    parse(unit * (2_000_000 // len(unit)))
    assert time.perf_counter() - started < 60


def test_deep_nests_and_closing_tags_of_others():
    started = time.perf_counter()
    parse("<div>" * 100_000 + "</x>" * 100_000)
    page = parse("<p><button><li>" + "<center>" * 100_000 + "text")
    assert time.perf_counter() - started < 60
    assert page.blocks == [(100_003, "text")]


def test_drawings_formulas_and_fallbacks_swallow_nothing():
    for tag in ("svg", "math", "object", "noscript"):
        page = parse(f"<article><p>before</p><{tag}><text>x</text><p>after</p><div>end</div></article>")
        assert [t for _, t in page.blocks] == ["before", "x", "after", "end"]
    assert [t for _, t in parse("<p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds").blocks] == ["where x=2 holds"]
    assert parse("<p>kept</p><script>if (a < b) { '<p>' }<p>lost</p>").blocks == [(1, "kept")]


def test_tags_end_outside_quotes_where_they_can():
    assert [t for _, t in parse("<p title='a > b'>one</p><p title='a > b>two</p>").blocks] == ["one", "b>two"]
    assert [t for _, t in parse('<p "x>y').blocks] == ["y"]


def test_marginals_are_those_of_all_assignments():
    page = parse("<div class=post><p>Some words, here.</p><ul class=menu><li>x<li>y</ul></div><p>tail</p>")
    own, m = model(), H.marginals(parse("<div class=post><p>Some words, here.</p><ul class=menu><li>x<li>y</ul></div><p>tail</p>"), model())
    odds = [sum(own.odds.get(f, 0.0) for f in H._features(n)) for n in page.nodes]
    odds[0] -= 20.0
    total, each = 0.0, [0.0] * len(odds)
    for states in itertools.product((0, 1), repeat=len(odds)):
        weight = sum(o for o, s in zip(odds, states, strict=True) if s)
        weight += sum(own.edges[H._edge(page, k)][states[n.parent]][states[k]] for k, n in enumerate(page.nodes) if k)
        total += math.exp(weight)
        for k, s in enumerate(states):
            each[k] += s * math.exp(weight)
    assert all(abs(a / total - b) < 1e-9 for a, b in zip(each, m, strict=True))


def test_labelled_layouts_are_learned():
    right = wrong = 0
    own = model()
    for html in H.layouts():
        page = parse(html)
        for node, p in zip(page.nodes[1:], H.marginals(page, own)[1:], strict=True):
            right, wrong = right + ((p >= 0.5) == (node.marked == "1")), wrong + ((p >= 0.5) != (node.marked == "1"))
    assert right / (right + wrong) > 0.9


def test_frames(spark):
    rows = [(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (2, "v", None, "old"), (3, None, "", "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = H.extract(pages).orderBy("page_id").collect()
    assert [(r.page_id, r.n_chars > 0, len(r.text) == r.n_chars) for r in found] == [(1, True, True)] * 2 + [(2, False, True), (3, False, True)]
    assert H.extract(pages.limit(0)).collect() == []
