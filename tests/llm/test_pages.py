from __future__ import annotations

import html
import re
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltgate.llm import wrappers as w
from siltgate.llm.common import table
from siltgate.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var t="</p>";x({i})</script></head>
<body><header><h2>Site</h2></header><nav><ul>{menu}</ul></nav><div class="ad">Buy {i}</div>{notice}
<article><h1>Title&nbsp;{i}</h1>{blocks}<aside>See also</aside><div class="comments"><p>Comment {i}</p></div></article>
<form><input name="q"><button>Go</button></form><footer>&copy; {i}</footer></body></html>"""


def page(i, blocks=("One &amp; two", "Three\n  four"), notice=False, menu=3):
    return PAGE.format(
        i=i,
        menu="".join(f'<li><a href="/{k}">m{k}</a></li>' for k in range(menu)),
        notice='<div id="cookie-notice"><p>We use cookies</p></div>' if notice else "",
        blocks="".join(f"<p>{b}</p>" for b in blocks),
    )


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS host", "2 AS wrapper", "3 AS text", "4 AS k", "5 AS h"
    )


def test_article_blocks_of_a_host(spark):
    rows = [(i, f"https://h.example/{i}", page(i, [f"Block {i} {k}" for k in range(i % 4)], i % 2, 2 + i % 3)) for i in range(12)]
    got = {r.page_id: (r.text, r.n_chars) for r in w.main_text(pages(spark, rows)).collect()}
    for i, _, _ in rows:
        text = "\n".join([f"Title {i}", *[f"Block {i} {k}" for k in range(i % 4)]])
        assert got[i] == (text, len(text))


def test_odd_rows(spark):
    rows = [
        (1, None, None), (2, "http://a.example/x", ""), (3, "http://a.example/y", "no tags &lt;at&gt; all"),
        (4, "HTTP://A.example:80/z", "<article><p>a<p>b<b>c</article>"), (5, "not a url", "<p>x</p><nav>y</nav>"),
        (None, None, "<main>" + "<p>long text here</p>" * 20_000 + "</main>"), (4, "HTTP://A.example:80/z", "<article><p>a<p>b<b>c</article>"),
    ]
    got = sorted(((r.page_id, r.text) for r in w.main_text(pages(spark, rows)).collect()), key=repr)
    assert got == sorted(
        [(1, ""), (2, ""), (3, "no tags <at> all"), (4, "a\nbc"), (4, "a\nbc"), (5, "x"), (None, "\n".join(["long text here"] * 20_000))],
        key=repr,
    )
    assert w.main_text(pages(spark, [])).collect() == []


def below(items, key):
    return next(i for i in items if i[w.KEY] == key)[w.BELOW]


def test_wrappers_are_union_free_expressions():
    wrapper = w.infer([page(i, [f"p{i}{k}" for k in range(2 + i)], i % 2, 3) for i in range(4)])
    body = below(below(wrapper, "html"), "body")
    kinds = {c[w.KEY]: c[w.TIMES] for c in body if c[w.KIND] == "e"}
    assert kinds["article"] == "1" and kinds["nav"] == "1" and kinds["div.cookie-notice"] == "?"
    article = below(body, "article")
    assert [(c[w.KEY], c[w.TIMES]) for c in article][:2] == [("h1", "1"), ("p", "+")]
    assert article[1][w.BELOW] == [["t", "#text", "1", None, None, []]]  # a slot
    assert w.main_path(wrapper) == ["html", "body", "article"]
    assert w.from_text(w.to_text(wrapper)) == wrapper
    # The menu is a run of different texts that is the same on all pages.
    menu = below(below(body, "nav"), "ul")[0]
    assert menu[w.TIMES] == "+" and menu[w.BELOW][0][w.SEEN] is None and w.is_template(menu)


def test_groups_of_neighbours_repeat():
    items = w.infer(["<div><h2>a</h2><p>b</p><h2>c</h2><p>d</p><h2>e</h2><p>f</p></div>"])
    group = items[0][w.BELOW][0]
    assert len(items[0][w.BELOW]) == 1 and group[:3] == ["g", "h2+p", "+"]
    assert [(i[w.KEY], i[w.TIMES], i[w.BELOW]) for i in group[w.BELOW]] == [
        (key, "1", [["t", "#text", "1", None, None, []]]) for key in ("h2", "p")
    ]


LAYOUTS = {
    "menu and letter": "<div><a href=/>Home</a> | <a href=/a>About</a> | <a href=/c>Contact</a></div>{story}<div>Subscribe to our letter today</div>",
    "box in the article": "<article>{story}<div class=x1><p>Follow our channel, it is free and comes every week to your door.</p></div></article>",
    "table of links": "<table><tr><td>One</td><td>Two</td></tr><tr><td>Three</td><td>Four</td></tr></table><div>{story}</div>",
    "long notice": "<section><p>{notice}</p></section><section>{story}</section><p>All rights reserved</p>",
    "on some pages only": "{some}<div>{story}</div>",
    "all paragraphs": "<p>Home, about, contact</p>{story}<p>Read more of us</p><p>Legal matters</p>",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_what_pages_share_goes_without_telling_names(layout):
    notice = "We keep small files on your device so that the next visit is quicker. " * 9

    def story(i):
        return [f"Story {i} begins here", *[f"Part {k} of story {i}" for k in range(1 + i % 4)]]

    texts = [
        "<html><body>"
        + LAYOUTS[layout].format(
            story="".join(f"<p>{s}</p>" for s in story(i)), notice=notice,
            some="<div><p>A word from us</p><p>Join now</p></div>" * (i % 3 == 0),
        )
        + "</body></html>"
        for i in range(20)
    ]
    wrapper = w.infer(texts)
    for i in (0, 3, 7, 19):
        assert w.extract(texts[i], wrapper) == "\n".join(story(i))
    shared = [0] if layout == "on some pages only" else range(20)
    assert all(w.extract(texts[i], []) != "\n".join(story(i)) for i in shared)


def test_words_in_class_names_drop_nothing_inside_an_article():
    names = ["legal-history", "share-prices", "side-effects", "related-work", "form-factor", "alert"]
    texts = [
        "<body><article>" + "".join(f"<div class='{n}'><p>{n} of {i}</p></div>" for n in names)
        + f"<p><math><mi>x{i}</mi></math></p><noscript><p>still {i}</p></noscript></article></body>"
        for i in range(5)
    ]
    got = w.extract(texts[2], w.infer(texts))
    assert got == "\n".join([*(f"{n} of 2" for n in names), "x2", "still 2"])


# --- brute force ------------------------------------------------------------------

KEYS = st.sampled_from("abcd")
TREES = st.recursive(
    st.tuples(KEYS, st.just(())), lambda inner: st.tuples(KEYS, st.lists(inner, max_size=4).map(tuple)), max_leaves=10
)
PAGES = st.lists(TREES, max_size=5).map(tuple)


def as_items(trees):
    return [["e", k, "1", [0, [0]], None, as_items(below)] for k, below in trees]


def words(trees):
    return "".join(f"<{k}{words(below)}>" for k, below in trees)


def pattern(items):
    """The wrapper as a regular expression over the words of a page."""
    out = []
    for kind, key, times, _, _, below in items:
        inner = pattern(below) if kind == "g" else f"<{key}{pattern(below)}>"
        out.append(f"(?:{inner})" + times.replace("1", ""))
    return "".join(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(PAGES, min_size=1, max_size=4))
def test_merged_wrappers_match_every_page(pages_):
    whole = w.align([w.fold(as_items(p)) for p in pages_])
    for p in pages_:
        assert re.fullmatch(pattern(whole), words(p))
    again = w.merge(whole, w.align([w.fold(as_items(p)) for p in pages_]))
    assert pattern(again) == pattern(whole)


@settings(max_examples=200, deadline=None)
@given(st.lists(KEYS, max_size=12), st.lists(KEYS, max_size=12))
def test_matches_are_a_longest_common_subsequence(a, b):
    pairs = w._matches(a, b)
    assert pairs == sorted(pairs) and all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    best = max(n for n in range(len(a) + 1) for c in combinations(a, n) if is_inside(c, b))
    assert len(pairs) == best


def is_inside(part, whole):
    rest = iter(whole)
    return all(x in rest for x in part)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30).map(str), max_size=60), st.lists(st.integers(0, 30).map(str), max_size=60))
def test_anchored_matches_are_common_subsequences(a, b):
    table, w._TABLE = w._TABLE, 16
    try:
        pairs = w._matches(a, b)
    finally:
        w._TABLE = table
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))


def test_pages_nested_deeply_and_with_many_different_children(spark):
    deep = "<div>" * 10_000 + "<p>down {0}</p>" + "</div>" * 10_000
    wide = "".join(f"<x{k}>t{k}</x{k}>" for k in range(20_000)) + "<p>end {0}</p>"
    rows = [(i, "http://d.example/", deep.format(i)) for i in range(2)]
    rows += [(9 + i, "http://w.example/", wide.format(i).replace(f"<x{7 + i}>", "<y>")) for i in range(2)]
    got = {r.page_id: r.text for r in w.main_text(pages(spark, rows)).collect()}
    assert got[0] == "down 0" and got[1] == "down 1"
    assert got[9].endswith("end 0") and got[9].count("\n") == 20_000
    wrapper = w.infer([deep.format(i) for i in range(4)])
    assert w.from_text(w.to_text(wrapper))[0][w.KEY] == "div" and w.main_path(wrapper) == []


LEAD = '<body><article><div class="lead">Short intro</div><p>{}</p></article><footer>{}</footer></body>'


@pytest.mark.parametrize("others", [[], [f"<body><article><p>other {i}</p></article></body>" for i in range(9)]])
def test_a_text_of_one_page_is_no_template(spark, others):
    """On a host with one page, in a page that alone has it, and in every copy of that page."""
    for copies in (1, 6):
        texts = [LEAD.format("Body", f"copy {i}") for i in range(copies)] + others
        rows = [(i, f"http://a.example/{i}", t) for i, t in enumerate(texts)]
        got = {r.page_id: r.text for r in w.main_text(pages(spark, rows)).collect()}
        assert {got[i] for i in range(copies)} == {"Short intro\nBody"}
    single = '<body><article><div class="text">All there is</div></article></body>'
    assert w.extract(single, w.infer([single] * 4)) == "All there is"


def test_a_text_that_pages_of_different_content_share_is_template():
    texts = [LEAD.format(f"Body {i}", "") for i in range(w.TEMPLATE_PAGES)]
    assert w.extract(texts[0], w.infer(texts)) == "Body 0"
    assert w.extract(texts[0], w.infer(texts[1:] * 2)) == "Short intro\nBody 0"


def test_every_page_of_a_host_takes_part(spark, monkeypatch):
    """A box of four pages among many others and copies, whatever tasks and rounds get."""
    tag = "<div class=tag>Read on</div>"
    texts = [f"<body><i{i % 60}></i{i % 60}><article>{tag * (i % 30 == 0)}<p>Body {i}</p></article></body>" for i in range(120)]
    rows = [(i, f"http://a.example/{i}", t) for i, t in enumerate(texts + [texts[1]] * 80)]
    found = []
    for parts, fan, held in ((1, 64, 10**6), (7, 4, 300)):
        monkeypatch.setattr(w, "FAN", fan, raising=False)
        monkeypatch.setattr(w, "HELD_CHARS", held, raising=False)
        docs = pages(spark, rows).repartition(parts)
        got = {r.page_id: r.text for r in w.main_text(docs).collect()}
        assert [got[i] for i in range(200)] == [f"Body {i if i < 120 else 1}" for i in range(200)]
        found.append([r.wrapper for r in w.learn_wrappers(docs.repartition(parts + 2), 64).collect()])
    assert found[0] == found[1] and len(found[0]) == 1


def test_pages_without_an_article_element():
    text = '<body><div class="menu">m</div><div class="post-content"><p>x &eacute;</p><p>y</p></div><div class="sidebar">s</div></body>'
    assert w.extract(text, w.infer([text])) == "x é\ny"
    assert w.extract(text, []) == "x é\ny"


def test_the_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in QUERIES["op9_main_text"](spark, sf).collect()}
    for r in table(spark, sf, "pages").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("broken", ["<", "<a", "<!--", "</p>", "<p", "<script>x", "&#xffffffff;", "<p class='ad", "<![CDATA[x"])
def test_broken_markup_does_not_stop_it(broken):
    assert isinstance(w.extract(broken, w.infer([broken, page(1)])), str)


def test_wrappers_too_large_to_broadcast(spark, monkeypatch, plan):
    rows = [(i, f"https://h{i % 3}.example/{i}", page(i)) for i in range(9)]
    small = w.main_text(pages(spark, rows))
    monkeypatch.setattr(w, "BROADCAST_BYTES", 0)
    large = w.main_text(pages(spark, rows))
    assert sorted(small.collect()) == sorted(large.collect())
    assert "Join" not in plan(small) and "Join" in plan(large)


@pytest.mark.parametrize(
    ("hint", "says"),
    [
        ("content with-sidebar", "main"), ("entry-header", None), ("site-header", "skip"), ("post-comments", "skip"),
        ("adverb", None), ("shadow", None), ("ad", "skip"), ("ad-slot", "skip"), ("header_top", "skip"), ("entry-content", "main"),
    ],
)
def test_what_class_names_say(hint, says):
    assert w._says(f"div.{hint}") == says
