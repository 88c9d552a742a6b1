"""Main text: the tree, the messages against brute force, pages of several kinds."""

import itertools
import re
import time
from collections import Counter
from html import unescape

import duckdb
import pytest

from veilframe.llm import html_text as H
from veilframe.llm.queries import QUERIES

from .conftest import FOLDER


@pytest.fixture(scope="module")
def model(spark):
    return H.train(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def test_pages_labelled_by_hand(model):
    for html in H.LABELLED:
        page, labels = H.labels_by_hand(html)
        for text, label, chance in zip(page.text, labels, H.marginals(page, model)):
            assert text is None or (chance[H.CONTENT] > 0.5) == (label == H.CONTENT), text


SMALL = (
    "<div><p>One sentence that is long enough.</p></div>",
    "<div><p>Short.<p>Another one.<p>All rights reserved, and a longer sentence follows here.</div>",
    "<ul><li><a href=/>Home</a><li>x</ul><p>A sentence that is a bit longer than the others.",
    "<div class=post><h1>Title</h1><p>Text is here, with a full stop at its end.</div><footer>f</footer>",
)


@pytest.mark.parametrize("html", SMALL)
def test_messages_give_the_marginals(model, html):
    """Against all labellings of trees with and without siblings."""
    page = H.Page(html)
    n, power = len(page.parent), H.tempers(page)
    children = Counter(page.parent)
    for i in range(1, n):
        assert power[i] == pytest.approx(power[page.parent[i]] / children[page.parent[i]] ** 0.5)
    total, sums = 0.0, [[0.0] * 3 for _ in page.parent]
    for labels in itertools.product(range(3), repeat=n - 1):
        labels = (H.WRAPPER, *labels)
        weight = 1.0
        for i in range(1, n):
            row = model.edge[page.kind[i]][labels[page.parent[i]]]
            # The class's share to the power, and the chance of the label as it is.
            weight *= sum(row) ** power[i] * row[labels[i]] / sum(row)
            if labels[i] == H.CONTENT:
                weight *= H.math.exp(power[i] * H.evidence(page, model, i))
        total += weight
        for i in range(1, n):
            sums[i][labels[i]] += weight
    for i in range(1, n):
        assert H.marginals(page, model)[i] == pytest.approx([s / total for s in sums[i]])


def test_the_whole_table(spark):
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{FOLDER}/pages.parquet'").fetchall())
    for r in QUERIES["op1_html_tree_model"](spark, FOLDER).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S).group(1).replace("<br>", " ")
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?p>|</?h1>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


PROSE = "<p>" + "The council has voted to keep the old bridge open, and repairs are due to begin soon. " * 3 + "</p>"
TALK = "<div class=reply>" + PROSE + "</div>"


@pytest.mark.parametrize("open_, close", [
    ("<article>", "</article>"), ("<main>", "</main>"), ("<div id='content'>", "</div>"), ("<div class=post>", "</div>"),
    ("<section role=main>", "</section>"),
])
def test_other_layouts(model, open_, close):
    html = f"""<!doctype html><html><head><title>No</title><script>if (a < b) "<p>no</p>"</script></head><body>
    <div class="top-bar"><a href=/>Home no</a> | <a href=/x>About no</a></div><nav><ul><li><a>no</a></ul></nav>
    <div class=layout><div class="left-sidebar"><p>Follow us no.</p>{PROSE.replace('council', 'no')}</div>
    {open_}<h1>Bridge &amp; stays</h1>{PROSE}<p>Two <b>bold</b><br>lines<ul><li>Steel<li>Stone</ul>
    <div class="comments">{TALK.replace('council', 'no')}{TALK.replace('council', 'no')}</div>
    <form><label>no</label><input name=q></form>{close}</div>
    <div id="cookie-banner">{PROSE.replace('council', 'no')}</div><footer>{PROSE.replace('council', 'no')}</footer></body></html>"""
    blocks = H.main_text(html, model).split("\n\n")
    assert blocks[0] == "Bridge & stays" and blocks[2:] == ["Two bold lines", "Steel", "Stone"]
    assert not any(re.search(r"\bno\b", b) for b in blocks)


def test_broken_and_long_pages(model, stored_docs):
    for html in ("", "<", "<p", "</p></div>", "<div>" * 3000 + "x", "<p><b>" * 20_000, '<a "' * 20_000, "<!--", "<script>",
                 "a<b", "<article>" + PROSE * 3000 + "</article>"):
        H.main_text(html, model)
    assert H.main_text("<article><p>x &amp y &lt;b&gt;&nbsp;z &eacute;</article>", model) == "x & y <b> z é"
    rows = [(1, "<article><p>A sentence that is here.</article>"), (1, "<article><p>A sentence that is here.</article>"), (None, None), (2, "")]
    pages = stored_docs(rows, "page_id long, html string")
    got = H.extract_text(pages, model).collect()
    assert sorted(r.text for r in got) == ["", "", "A sentence that is here.", "A sentence that is here."]
    assert H.extract_text(stored_docs([], "page_id long, html string"), model).count() == 0
    assert H.main_text(H.LABELLED[0], H.train(stored_docs([], "page_id long, html string"))).startswith("Plan agreed")


def test_labels_by_markup():
    assert H.labels_by_markup(H.Page("<div><p>x</div>")) is None
    page = H.Page("<body><article><p>x</p><nav><p>y</nav></article></body>")
    labels = dict(zip(page.text, H.labels_by_markup(page)))
    assert labels["x"] == H.CONTENT and labels["y"] == H.NOT
    assert isinstance(H.count_labels(page, H.labels_by_markup(page)), Counter)


WORDS = "The council has voted to keep the old bridge open, and repairs are due to begin soon."


@pytest.mark.parametrize("html", [
    "<html><head><title>no</title><meta charset=utf-8><article><h1>Bridge stays</h1>{p}</article>",
    "<html><head><title>no</title><link rel=x><script>no</script><div class=post><h1>Bridge stays</h1>{p}</div>",
    "<html><head><title>no<body><article><h1>Bridge stays</h1>{p}</article>",
    "<head><noscript>no</noscript><style>no</style></head><body><article><h1>Bridge stays</h1>{p}</article>",
    "<article><h1>Bridge stays</h1><div class='story related-work'>{p}</div></article>",
    "<article><h1>Bridge stays</h1><div class='body text comments-off'>{p}</div></article>",
    "<article><h1>Bridge stays</h1><noscript>{p}</noscript></article>",
    "<article><h1>Bridge stays</h1><object data=x>{p}</object></article>",
    "<article><h1>Bridge stays</h1>{p}<form><select><option>no</option></select></form></article>",
    "<body><article><h1>Bridge stays</h1>{p}<script>if (x) no()</article><footer>no</footer></body>",
    "<body><article><h1>Bridge stays</h1><div><style>no</div>{p}</article></body>",
])
def test_nothing_of_an_article_is_lost(model, html):
    got = H.main_text(html.format(p=f"<p>{WORDS}</p>"), model)
    assert got == f"Bridge stays\n\n{WORDS}"


def test_formulas_and_drawings_keep_their_text(model):
    html = f"<article><p>{WORDS}</p><p>So <math><mi>x</mi> <mo>=</mo> <mn>2</mn></math> holds in all of the cases above.</p></article>"
    assert H.main_text(html, model) == f"{WORDS}\n\nSo x = 2 holds in all of the cases above."


def test_time_is_linear_in_links_and_unclosed_tags(model):
    for piece in ("<a href=x>word</a> ", "<script>", "<title>", "<p>x<style>", "<noscript>x", "<head><p>", "<select><option>x"):
        began = time.monotonic()
        H.main_text("<article><p>" + piece * 40_000, model)
        assert time.monotonic() - began < 15, piece


def test_names_that_the_operator_might_use(model, stored_docs):
    pages = stored_docs([(1, f"<article><p>{WORDS}</article>")], "page_id long, html string")
    for name in ("text_", "text__of", "html_"):
        pages = pages.selectExpr("*", f"'mine' AS `{name}`")
    row = H.extract_text(pages, model).head()
    assert row.text == WORDS and row["text__of"] == row.text_ == row.html_ == "mine"
