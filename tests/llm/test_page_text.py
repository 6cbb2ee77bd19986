"""The model on unseen layouts, the parser on broken markup, marginals against all labellings."""

import itertools
import time

import numpy as np
import pytest

from tastewell.llm import page_text
from tastewell.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def model():
    return page_text.train(labelled_pages())


def _marked(page):
    nodes = page_text.parse(page)
    page_text._describe(nodes)
    return " ".join(" ".join("".join(n.pieces).replace("&copy;", "©").replace("&middot;", "·").split()) for n in nodes if n.tag == "#text" and n.kept)


def test_unseen_layouts(model):
    pages = labelled_pages(200, seed=99)
    plain = [p.replace(" data-main", "").replace(" data-not", "") for p in pages]
    exact = sum(a == _marked(p) for a, p in zip(page_text.main_texts(plain, *model), pages, strict=True))
    assert exact >= 190


def test_markup(model):
    body = "A first sentence that is long enough to be read as prose, &amp; more of it. And then one more sentence of it."
    page = f"""<!DOCTYPE html><html><head><title>Title</title><style>p{{x:"</p>"}}</style></head><body><nav><ul><li><a href=/a>One</a><li><a>Two</a></ul></nav>
    <script>var t = "<p>no</p>";</script><!-- <p>no</p> --><div class="cookie-banner"><p>We use cookies on this page for many reasons.</p></div>
    <article><h1>Head&nbsp;line</h1><p>{body}<p>caf&eacute; <b>bo</b>ld &#8212; {body}<br>{body}</b></article>
    <section class="comments"><p>{body}</p></section><footer>&copy; someone, some year</footer></body></html>"""
    import html

    plain = html.unescape(body)
    assert page_text.main_texts([page], *model) == [f"Head line {plain} café bold — {plain} {plain}"]


def test_odd_pages(model):
    pages = ["", "   ", "<html></html>", "<", "<p", "</div></div>", "<article>", "<!--", "<script>x", "<a><b></a></b>", "<p>" * 3000]
    assert page_text.main_texts(pages, *model)[:3] == ["", "", ""]
    assert len(page_text.main_texts(pages, *model)) == len(pages)


def test_marginals_equal_the_sum_over_all_labels():
    rng = np.random.default_rng(2)
    forest = page_text.Forest(["<div><p>one</p><ul><li>two</li></ul></div><nav>x</nav>", "<p>alone</p>"])
    weights, pair = rng.normal(size=len(page_text.FEATURES)), rng.normal(size=(len(page_text.EDGES), 2, 2))
    own, n = forest.own(weights), len(forest.nodes)
    total, ones = 0.0, np.zeros(n)
    for labels in itertools.product((0, 1), repeat=n):
        log = sum(own[i] for i in range(n) if labels[i])
        log += sum(pair[forest.edges[i], labels[p], labels[i]] for i, p in enumerate(forest.parents) if p >= 0)
        total += np.exp(log)
        ones += np.exp(log) * np.array(labels)
    belief, joint = forest.marginals(weights, pair)
    assert belief == pytest.approx(ones / total)
    assert joint[1].sum() == pytest.approx(1)


def test_rows(spark, model):
    page = "<article><p>" + "Words of a plain sentence that goes on for a while. " * 5 + "</p></article>"
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (None, None, None, None), (2, "v", "", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = page_text.extract_text(df, *model).collect()
    assert sorted((str(r["page_id"]), len(r["text"])) for r in got) == [("1", 259), ("1", 259), ("2", 0), ("None", 0)]
    assert page_text.extract_text(df.limit(0), *model).collect() == []


@pytest.mark.parametrize("unit", ["<a ", "<a<a ", "<a \"x>", "<div></x>", "<div>", "<thead>", "<b><p>", "<b><div></b>", "<svg><g><foreignObject><p>", "</b "])
def test_time_grows_with_the_page(unit):
    def seconds(size):
        page = unit * (size // len(unit))
        start = time.process_time()
        page_text.parse(page)
        return time.process_time() - start

    seconds(10_000)
    assert seconds(1_000_000) < 5
    assert page_text.parse(unit * 2000 + "<p>the end</p>")


def test_tags_end_outside_of_quotes():
    page = """<p title="a > b" class='x'>One <a href='<">'>two</a> < three <b title="never closed>four"""
    assert ["".join(n.pieces) for n in page_text.parse(page) if n.tag == "#text"] == ["One two < three <b title=\"never closed>four"]


@pytest.mark.parametrize(
    ("page", "runs"),
    [
        ('<p>One <svg class="i"/>two</p><p>three</p>', ["One two", "three"]),
        ("<p>One</p><select-box><p>two</p></select-box><title-bar>three</title-bar><p>four</p>", ["One", "two", "three", "four"]),
        ("<div><p>One <svg><path d='M0'>no</p><p>two</p></div>", ["One ", "two"]),
        ("<ul><li>One <svg><g>no<li>two</ul>", ["One ", "two"]),
        ("<p><a href=x>One <svg><path></a> two</p>", ["One  two"]),
        ("<div>One<select><option>no</div><p>two</p>", ["One", "two"]),
        ("<div>One<template><p>no</p><div>no</div></div><p>two</p>", ["One", "two"]),
        ("<p>One <svg><title/><foreignObject><p>no</p></foreignObject><style/></svg>two</p>", ["One two"]),
        ("<p>One <SVG><title>no</title></SVG>two</p><p>a<select><option>no</select>b</p>", ["One two", "a", "b"]),
        ("<p>One</p><script>no <p>no", ["One"]),
        ("<p>One <svg></svg><template><svg/></template>two <svg><a>no</svg>three</p>", ["One two three"]),
    ],
)
def test_skipped_elements(page, runs):
    assert ["".join(n.pieces) for n in page_text.parse(page) if n.tag == "#text"] == runs
