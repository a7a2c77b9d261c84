from __future__ import annotations

import html
import itertools
import re

import numpy as np
import pytest

from meterline.llm import dom, html_extract, layouts
from tests.llm.conftest import rows_of


@pytest.fixture(scope="module")
def pages():
    return rows_of("pages")


@pytest.fixture(scope="module")
def model(pages):
    words = [w for p in pages[:100] for v in dom.read(p[2]) if v.text for w in v.words]
    return html_extract.fit(layouts.labelled_pages(words, html_extract.LABELLED))


def article(page: str) -> str:
    """Blocks of the article of a page of the table, by cutting at its few block tags."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_table(spark, pages):
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    rows = {r.page_id: r for r in html_extract.main_text(frame).collect()}
    assert np.mean([rows[i].text == article(h) for i, _, h in pages]) > 0.99
    assert all(rows[i].url == u and rows[i].n_chars == len(rows[i].text) for i, u, _ in pages)


TEXT = "The council met on Tuesday evening to discuss the new bridge, and residents filled the hall."
SOFT = [
    (f"<div id='cookie-banner'>We use cookies. <button>OK</button></div><header><nav><a href=1>Home</a></nav></header><main><article><h1>Vote</h1><p>{TEXT}</p><p>Short.</p>"
     f"<aside class='related'><h3>Related</h3><ul><li><a href=1>Other story</a></ul></aside><p>{TEXT}</p><form class='newsletter'><p>Sign up for our newsletter</p><input></form></article>"
     "<section id='comments'><h2>Comments</h2><div class='comment'><p>I think that this is a great idea, and I hope they build it.</p></div></section></main><footer>&copy; 2020 All rights reserved.</footer>",
     f"Vote\n{TEXT}\nShort.\n{TEXT}"),
    (f"<div class='menu'><a href=1>a</a> <a href=2>b</a></div><div class='content'><h1>Title here</h1><p>{TEXT}<br>second\n line</p><div class='ad'>Buy now!</div><p>a &amp; b&nbsp;c &lt;tag&gt; &eacute;</p></div><div class='footer'>Contact us</div>",
     f"Title here\n{TEXT} second line\na & b c <tag> é"),
    (f"<article><h1>T</h1><p>{TEXT}<script>var x='<p>no</p>'</script><style>p{{}}</style><!-- <p>c</p> --><div class='comments'><p>reader says: well done!</p></div></article>", f"T\n{TEXT}"),
]


def test_other_layouts(model):
    for page, want in SOFT:
        assert html_extract.extract([page], *model) == [want]


def test_labelled_pages_that_were_not_learned(model):
    pages = layouts.labelled_pages(TEXT.split(), 150, seed=77)
    trees = [dom.read(p) for p in pages]
    p, _ = html_extract.Forest.of(trees).marginals(*model)
    y = np.concatenate([html_extract.labels_of(t) for t in trees])
    chars = np.array([v.chars for t in trees for v in t])
    assert ((p >= 0.5) == y)[chars > 0] @ chars[chars > 0] / chars.sum() > 0.95


def test_messages_equal_enumeration():
    rng = np.random.default_rng(0)
    nodes = dom.read("<div><p>a b</p><div>c<p>d</p></div></div><p>e")
    forest = html_extract.Forest.of([nodes])
    theta, edges = rng.normal(size=html_extract.WIDTH), rng.normal(size=(html_extract.EDGES, 2, 2))
    p, joint = forest.marginals(theta, edges)
    unary = np.bincount(forest.node, theta[forest.feature], len(nodes))
    total, want = 0.0, np.zeros(len(nodes))
    for y in itertools.product((0, 1), repeat=len(nodes)):
        w = np.exp(sum(unary[i] for i in range(len(y)) if y[i]) + sum(edges[forest.kind[i], y[forest.up[i]], y[i]] for i in range(1, len(y))))
        total += w
        want += w * np.array(y)
    assert np.allclose(p, want / total) and np.allclose(joint[1:, :, 1].sum(1), p[1:])


def test_odd_pages(spark):
    odd = [
        (1, "u", None), (2, None, ""), (3, "u", "no tags at all"), (4, "u", "<" * 50_000), (5, "u", "<a \"" * 5000), (None, "u", "<p>x"), (7, "u", "<div>" * 3000 + "deep"),
        (8, "u", f"<article><p>{TEXT}</article>"), (8, "u", f"<article><p>{TEXT}</article>"), (9, "u", "<p>" + "word " * 200_000), (10, "u", "</p></div><td><li>x</table>"),
    ]
    frame = spark.createDataFrame([(*r, "t", 5) for r in odd], "page_id bigint, url string, html string, text string, n_chars int")
    rows = html_extract.main_text(frame).collect()
    assert len(rows) == len(odd)
    assert [r.text for r in rows if r.page_id == 8] == [TEXT, TEXT]
    assert all(r.n_chars == len(r.text) for r in rows) and all(r.text == "" for r in rows if r.page_id in (1, 2))
    assert html_extract.main_text(frame.limit(0)).count() == 0
