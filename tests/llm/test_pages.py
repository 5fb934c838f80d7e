import html
import random
import re

import numpy as np
import pytest

from headway.llm import pages as P


@pytest.fixture(scope="module")
def model(spark, sf):
    return P.learn(spark.read.parquet(f"{sf}/pages.parquet"), made=250, rounds=8)


def article(page):
    """The article of a page of the test data, told by its tags alone."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1].replace("<br>", " ")
    parts = re.split(r"</?(?:p|h1)>", inside)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in parts]
    return " ".join(t for t in texts if t)


def test_query(spark, sf):
    rows = {r["page_id"]: r for r in P.op8_crf_pages(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        r = rows[p["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (p["url"], article(p["html"]), len(article(p["html"])))


def test_layouts_it_has_not_seen(spark, sf, model):
    chance = random.Random(99)
    texts = [b.text for r in spark.read.parquet(f"{sf}/pages.parquet").collect() for b in P.leaf_blocks(r["html"]) if "article" in b.tags]
    right = 0
    for _ in range(150):
        page, want = P.written_page(texts, chance)
        right += P.main_text(page, model) == " ".join(want)
    assert right >= 130


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies.</div>
<main><article><h1>A &amp; B</h1><p>First   <b>bold</b>text with some words,\n and more of them.</p>
<div class="ad">Buy now</div><p>Second one&nbsp;here, which is a little longer than the first was.</p>
<script>var x = "<p>no</p>";</script><form><label>Mail</label><input></form></article>
<section class="comments"><h3>2 comments</h3><p>I do not agree with this at all, said one reader of the page.</p></section></main>
<aside class="sidebar"><p>Read this as well</p></aside><footer>&copy; Site</footer></body></html>"""


def test_a_page_with_everything(model):
    assert P.main_text(PAGE, model) == (
        "A & B First boldtext with some words, and more of them. Second one here, which is a little longer than the first was."
    )


@pytest.mark.parametrize("page,texts", [
    ("", []), ("<", ["<"]), ("<p", []), ("a<br>b", ["a b"]), ("<p>a<p>b", ["a", "b"]), ("<div>x<div>y</div>z</div>", ["x", "y", "z"]),
    ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("<!-- <p>a --><p>b", ["b"]), ("<!-- open <p>a", []), ("a &lt;b&gt; &#x41;", ["a <b> A"]),
    ("<script>if(a<b){}</script>c", ["c"]), ("</p></div>a", ["a"]), ("<a title='a>b'>t</a>", ["t"]), ("1 < 2 and 3", ["1 < 2 and 3"]),
    ("<p>a<span> b</span>\t\nc</p>", ["a b c"]), ("<STYLE>x</STYLE><P>A</P>", ["A"]),
])
def test_reading(page, texts):
    assert [b.text for b in P.leaf_blocks(page)] == texts


def test_ancestors_and_links():
    a, b = P.leaf_blocks('<div id="sideBar" class="w1 wide"><p>ab<a href="#">cd</a></div><p>x')
    assert (a.tag, a.tags, a.words, a.linked) == ("p", {"div", "p"}, {"side", "bar", "w", "wide"}, 2)
    assert (b.tag, b.tags, b.words) == ("p", {"p"}, frozenset())


@pytest.mark.parametrize("page", ["<div>" * 60000 + "x", "<div>a" * 20000, "<a " * 30000, "<" * 100000, "<!--" * 30000, "<p " + '"' * 60001])
def test_odd_pages_take_no_long_time(page, model):
    P.main_text(page, model)


def test_decoding_against_all_paths():
    from itertools import product

    chance = np.random.default_rng(1)
    m = P.Model(chance.normal(size=P.WIDTH), chance.normal(size=(2, 2)))
    found = [chance.integers(0, P.WIDTH, 4) for _ in range(7)]

    def score(path):
        return sum(m.weight[f].sum() * y for f, y in zip(found, path)) + sum(m.step[a, b] for a, b in zip(path, path[1:]))

    assert tuple(P.decode(found, m)) == max(product((0, 1), repeat=7), key=score)
    assert P.decode([], m) == []


def test_the_gradient_is_right():
    chance = np.random.default_rng(2)
    m = P.Model(chance.normal(size=P.WIDTH) * 0.5, chance.normal(size=(2, 2)))
    found, y = [chance.integers(0, 50, 3) for _ in range(5)], np.array([0, 1, 1, 0, 1])

    def likelihood(step):
        from itertools import product

        def score(path):
            return sum(m.weight[f].sum() * k for f, k in zip(found, path)) + sum(step[a, b] for a, b in zip(path, path[1:]))

        return score(y) - np.logaddexp.reduce([score(p) for p in product((0, 1), repeat=5)])

    _, d = P._gradient(found, y, m)
    for i in range(2):
        for j in range(2):
            moved = m.step.copy()
            moved[i, j] += 1e-5
            assert abs((likelihood(moved) - likelihood(m.step)) / 1e-5 - d[i, j]) < 1e-3


def test_edges(spark, model):
    rows = [(1, "u", None), (2, None, ""), (None, "v", PAGE), (3, "w", PAGE), (3, "w", PAGE), (4, "x", PAGE[:700])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS text", "1 AS score")
    got = sorted(map(tuple, P.extract(df, model).collect()), key=str)
    assert len(got) == 6 and (1, "u", "") in got and (2, None, "") in got
    assert {t for i, _, t in got if i in (3, None)} == {P.main_text(PAGE, model)}
    assert P.extract(df.limit(0), model).count() == 0
    assert P.learn(df.limit(0), made=5, rounds=1) is not None


@pytest.mark.parametrize("page,texts", [
    ('<article><p>one<svg class="i"/></p><p>two</p></article>', ["one", "two"]), ("<p>a<svg-icon>b</svg-icon></p><p>c", ["ab", "c"]),
    ("<button-group><p>a</p></button-group><select-box>b", ["a", "b"]), ("<div><button>a</div><p>b", ["a", "b"]), ("<select><option>a<p>b", ["a", "b"]),
    ("x<button><div>a</div></button>y<p>b", ["xy", "b"]), ("x<svg><svg><title>t</title></svg>u</svg><p>b", ["x", "b"]), ("<noscript><p>a</noscript>b", ["b"]),
    ("x<svg viewBox='0 0' /><svg><g/></svg><p>b", ["x", "b"]), ("<TEMPLATE><p>a</TEMPLATE >b<iframe src=x>c</iframe>", ["b"]), ("a<script-x>b</script-x>c", ["abc"]),
    ("<button>a<button>b</button><p>c", ["a", "c"]), ("<script src=x>a", []), ("a<textarea><p>b", ["a"]),
])
def test_only_hidden_content_is_left_out(page, texts):
    assert [b.text for b in P.leaf_blocks(page)] == texts


@pytest.mark.parametrize("page", ["<svg>" * 60000 + "x", "<button>a</div>" * 30000, "<select><p></select>" * 20000, "<svg><div></svg>" * 20000])
def test_many_hidden_tags_take_no_long_time(page):
    P.leaf_blocks(page)
