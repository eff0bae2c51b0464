"""Markup that is broken, hostile or seldom, and pages of other layouts."""

import random
import re
import time

import pytest

from tallyspark.llm import html, html_labels


@pytest.fixture(scope="module")
def model():
    return html.train(html_labels.labelled_pages())


HEAD = "<body><nav><a href=/>Home</a> <a href=/b>Menu</a></nav><article><h1>A title here</h1>"


def test_nothing_of_the_article_is_dropped(model):
    page = HEAD + (
        "<p title=don't>It's a text of some words, that's it.</p><p>Formula <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and <svg><text>label</text></svg> inside.</p>"
        "<p>Also <noscript>this fallback</noscript>, <object>that one</object> and <canvas>a third</canvas> here.</p></article></body>"
    )
    assert html.main_text(page, model).split("\n") == ["A title here", "It's a text of some words, that's it.", "Formula x=2 and label inside.", "Also this fallback, that one and a third here."]
    # a drawing that is never closed ends with the next block
    page = HEAD + "<p>Some words of a paragraph that go on <svg><path d='M0'><p>and END of the article, with some words.</article>"
    assert html.main_text(page, model).split("\n")[1:] == ["Some words of a paragraph that go on", "and END of the article, with some words."]


def test_tags_end_where_browsers_end_them(model):
    for page, text in (
        ('<p a="x>y">inside of it</p>', "inside of it"),
        ("<p a='x>y' b = \"<p>\">inside of it</p>", "inside of it"),
        ("<p>a < b and x <3 y</p>", "a < b and x <3 y"),
        ("<p>one</p><!-- <p>no</p> --><p>two</p><!--", "one\ntwo"),
        ("<p>one</p><script>if (a<b) '</p>'</script><?x?><!DOCTYPE y><p>two</p>", "one\ntwo"),
        ('<p>one</p><a b="never closed>two</a>', "one\ntwo"),
        ("", ""),
    ):
        assert html.main_text(page, model) == text


def test_hostile_pages_take_time_in_proportion(model):
    n = 30_000
    for part, tail in (("<a 'x ", ""), ("<a b='x ", ""), ("<a ", 'b=">"'), ("<div>", "</x>" * n), ("<p><section><h1>", ""), ("<!", ""), ('<a b="x> ', ""), ("<b>", "</a>" * n), ("<!--", ""), ("&amp", ""), ("<svg>", "</p>" * n)):
        began = time.process_time()
        html.main_text(part * n + tail, model)
        assert time.process_time() - began < 10, part


def _renamed(page: str, how: str, rng: random.Random) -> str:
    """A page with opaque class names and ids, or with none."""
    known = {}

    def name(m):
        if how == "none":
            return ""
        return f'{m[1]}="{known.setdefault(m[2], f"x{rng.randrange(10**6)}")}"'

    return re.sub(r"(class|id|role)=\"([^\"]*)\"", name, page)


@pytest.mark.parametrize("how", ["opaque", "none"])
def test_error_on_pages_without_telling_names(model, how):
    """Where names say nothing, tags, links and neighbours are left.  The
    share of wrong blocks is reported in the README."""
    rng = random.Random(3)
    pages = [html_labels.labelled_page(_renamed(html_labels._Writer(10**6 + k).page(), how, rng)) for k in range(150)]
    wrong = total = 0
    for p in pages:
        html._features(p)
        for n, b in zip(p.nodes, model.beliefs(p.nodes), strict=True):
            total += n.chars > 0
            wrong += n.chars > 0 and (b >= 0.5) != n.gold
    print(how, wrong / total)
    assert wrong < 0.25 * total
