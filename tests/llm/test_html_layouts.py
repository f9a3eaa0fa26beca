"""Main text by layout, on pages that the fit has not seen."""

import pytest

from demandgrid.llm import htmlmodel, queries
from demandgrid.llm.htmltree import parse

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return htmlmodel.fit(htmlmodel.labelled_pages())


def share(model, pages):
    """Pages whose main text is found to the letter, without the labels."""
    right = 0
    for page in pages:
        nodes = parse(page)
        want = " ".join(n.text for n, y in zip(nodes, htmlmodel.labels_of(nodes), strict=True) if n.tag == "#text" and y)
        right += htmlmodel.main_text(page.replace(' data-main="1"', "").replace(' data-main="0"', ""), model) == want
    return right / len(pages)


def test_held_out_pages_by_layout(model):
    named, plain = htmlmodel._Writer(501), htmlmodel._Writer(502)
    named.plain = named.page  # the layouts with names only
    assert share(model, [named.page() for _ in range(300)]) > 0.88
    assert share(model, [plain.plain() for _ in range(300)]) > 0.7


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (
            "<body><div><div><a>A</a> <a>B</a></div><div>Long article text without classes. It has more than "
            "one sentence. It goes on.</div><div>Copyright 2020 somebody</div></div>",
            "Long article text without classes. It has more than one sentence. It goes on.",
        ),
        ("<article><div>Deep text.</div></article>", "Deep text."),
        (
            '<article><div class="content-header"><h1>Title</h1></div><p>Some text here. More of it.</p></article>',
            "Title Some text here. More of it.",
        ),
        (
            '<article><p>Some text here. More of it.</p></article><div id="related-posts"><p>Read this too. It is good.</p></div>',
            "Some text here. More of it.",
        ),
    ],
)
def test_layouts_without_or_with_mixed_names(model, html, text):
    assert htmlmodel.main_text(html, model) == text


def test_query_gives_the_text_of_every_page(spark, model):
    rows = {r.page_id: r for r in queries.op5_tree_model(spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        text = htmlmodel.main_text(p.html, model)
        assert (rows[p.page_id].text, rows[p.page_id].n_chars, rows[p.page_id].url) == (text, len(text), p.url)


def test_columns_that_clash_and_long_pages(spark, model):
    long = "<article>" + "<p>One sentence here. Another one.</p>" * 4000 + "</article>"
    pages = spark.createDataFrame([(1, None, "mine", 5), (2, long, "mine", 5)], "page_id int, html string, text string, n_chars int")
    rows = {r.page_id: r for r in htmlmodel.extracted(pages, model).collect()}
    assert (rows[1].text, rows[1].n_chars) == ("", 0) and rows[2].n_chars > 100_000
