"""Heads without an end tag, and text of formulas."""

import pytest

from demandgrid.llm.htmltree import parse


def shown(html):
    return " ".join(n.text for n in parse(html) if n.tag == "#text")


@pytest.mark.parametrize(
    "html",
    [
        "<html><head><title>t</title><body><article><p>One two</p></article>",
        "<head><meta charset=utf-8><title>t</title><style>p{}</style><article><p>One two</p></article>",
        "<head><title>t</title><noscript>no<body><p>One two",
        "<head><noscript><img src=x>no</noscript><script>a</script></head><body><p>One two</p>",
        "<head><template><p>no</p></template><link href=x><p>One two",
        "<head><title>t</title>One <b>two</b>",
        "<html><head><title>t</title></head><body><p>One two</p></body></html>",
    ],
)
def test_open_heads_end_where_the_body_begins(html):
    assert shown(html) == "One two"


def test_text_of_formulas_stays():
    assert shown("<p>area <math><mi>r</mi><mo>=</mo><mn>2</mn></math> here</p>") == "area r=2 here"
