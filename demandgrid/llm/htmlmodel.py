"""Main text of web pages by a tree-structured graphical model.

Every element and text block of a page is a variable: content or not. Each has evidence of
its own (tag, the parts of its class names, links, length, punctuation) and is tied to its
parent by a potential. What each part of a name speaks for is learned. Sum-product messages go from the leaves to the root and back, which gives each
node's exact marginal. Text blocks whose marginal is over one half make up the main text.

The potentials are relative frequencies, smoothed, in labelled pages, where elements say
``data-main="1"`` or ``"0"`` for all below them. ``labelled_pages`` makes them, a bounded
number from a fixed seed, in layouts that sites use.

A null html is an empty page; pages without main text have an empty text. Urls and ids are
passed on, nulls and repeats too. Very long pages are read whole. An empty table gives no
rows. Further columns pass through ``extracted``; those named text or n_chars are replaced.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from demandgrid.llm.htmltree import Node, parse

#: Labelled pages that the model is fitted to.
PAGES = 900
SMOOTHING = 0.1
#: Weight of a feature; features of a node depend on each other and on those below.
EVIDENCE = 0.5
GROUPS = {
    **dict.fromkeys(["article", "main"], "article"),
    **dict.fromkeys(["nav", "menu"], "nav"),
    **dict.fromkeys(["p", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6"], "prose"),
    **dict.fromkeys(["figcaption", "dd", "dt", "td", "th", "caption"], "cell"),
    **dict.fromkeys(["div", "section", "center", "details"], "box"),
    **dict.fromkeys(["ul", "ol", "dl"], "list"),
    **dict.fromkeys(["form", "button", "select", "option", "label", "fieldset", "legend"], "form"),
    **dict.fromkeys(["html", "body", "#page"], "root"),
}
#: Parts of class names that tell what a box is for.
AGAINST = re.compile(
    r"(?:^|[\s_-])(?:nav|menu|side|footer|header|masthead|ads?|adv|advert|banner|sponsor|promo|"
    r"cookie|consent|notice|alert|popup|modal|comment|reply|disqus|share|social|related|"
    r"recommend|form|subscri|newsletter|login|search|breadcrumb|pagin|tags?|widget|copyright|"
    r"legal|toolbar|skip)",
    re.I,
)
FOR = re.compile(
    r"(?:^|[\s_-])(?:article|content|post|entry|story|main|body|text|prose|copy)", re.I
)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MOST_PARTS = 6
SENTENCE = re.compile(r"[.!?…。][\"'”’)]*(?:\s|$)")


@dataclass(frozen=True)
class TreeModel:
    """Log potentials: of evidence given a label, of a child's label given its parent's."""

    evidence: dict[tuple[str, str, str], tuple[float, float]]
    unseen: dict[tuple[str, str], tuple[float, float]]
    pair: dict[tuple[str, str, int], tuple[float, float]]

    def tie(self, parent: str, child: str, up: int) -> tuple[float, float]:
        """For a pair of kinds that the labelled pages lack, that of the child with any parent."""
        return (
            self.pair.get((parent, child, up))
            or self.pair.get(("", child, up))
            or self.pair["", "", up]
        )


def _names(node: Node) -> str:
    if not node.names:
        return "none"
    against, own = AGAINST.search(node.names), FOR.search(node.names)
    if against and own:
        return "against, for" if against.start() < own.start() else "for, against"
    return "against" if against else "for" if own else "other"


def _parts(node: Node) -> list[str]:
    """The first few distinct parts of an element's names, a plural as its singular."""
    parts = (p.lower().removesuffix("s") for p in PART.findall(node.names or ""))
    return list(dict.fromkeys(parts))[:MOST_PARTS]


def _place(node: Node) -> str:
    """What a node is to its children."""
    return f"{_kind(node)} {_names(node)}"


def _kind(node: Node) -> str:
    return "text" if node.tag == "#text" else GROUPS.get(node.tag, node.tag)


def features(nodes: list[Node]) -> list[tuple[tuple[str, str], ...]]:
    """The evidence of every node; sizes include all that is below it."""
    size = [len(n.text) for n in nodes]
    linked = [n.linked for n in nodes]
    stops = [len(SENTENCE.findall(n.text)) for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        size[up] += size[i]
        linked[up] += linked[i]
        stops[up] += stops[i]
    out = []
    for i, n in enumerate(nodes):
        share = linked[i] / size[i] if size[i] else 0.0
        out.append(
            (
                ("tag", _kind(n)),
                ("names", _names(n)),
                ("links", "none" if not share else "few" if share < 0.4 else "many"),
                ("size", "0" if not size[i] else str(min(3, int(math.log10(size[i]))))),
                ("stops", str(min(2, stops[i]))),
                *(("part", part) for part in _parts(n)),
            )
        )
    return out


def labels_of(nodes: list[Node]) -> list[int]:
    out: list[int] = []
    for n in nodes:
        out.append(n.label if n.label is not None else out[n.parent] if n.parent >= 0 else 0)
    return out


def fit(pages: list[str]) -> TreeModel:
    """Smoothed relative frequencies over the nodes of labelled pages."""
    seen: Counter = Counter()
    kinds: Counter = Counter()
    pairs: Counter = Counter()
    values: dict[str, set[str]] = {}
    for page in pages:
        nodes = parse(page)
        labels = labels_of(nodes)
        for i, (node, found) in enumerate(zip(nodes, features(nodes), strict=True)):
            kind = "text" if node.tag == "#text" else "element"
            kinds[kind, labels[i]] += 1
            for name, value in found:
                seen[kind, name, value, labels[i]] += 1
                values.setdefault(name, set()).add(value)
            if node.parent >= 0:
                up, own = _place(nodes[node.parent]), _kind(node)
                for key in ((up, own), ("", own), ("", "")):
                    pairs[(*key, labels[node.parent], labels[i])] += 1

    def of(kind: str, name: str, value: str) -> tuple[float, float]:
        wide = SMOOTHING * (len(values[name]) + 1)
        return tuple(
            math.log((seen[kind, name, value, y] + SMOOTHING) / (kinds[kind, y] + wide))
            for y in (0, 1)
        )

    table = {(k, n, v): of(k, n, v) for k in ("text", "element") for n in values for v in values[n]}
    none = {(k, n): of(k, n, "") for k in ("text", "element") for n in values}
    pair = {}
    for parent, child, up, _ in pairs:
        n = [pairs[parent, child, up, own] + SMOOTHING for own in (0, 1)]
        pair[parent, child, up] = tuple(math.log(x / sum(n)) for x in n)
    return TreeModel(table, none, pair)


def _log_sum(a: float, b: float) -> float:
    high = a if a > b else b
    return high + math.log(math.exp(a - high) + math.exp(b - high))


def marginals(nodes: list[Node], model: TreeModel) -> list[float]:
    """The probability that each node is content, by two passes of messages over the tree."""
    belief = []
    for node, found in zip(nodes, features(nodes), strict=True):
        kind = "text" if node.tag == "#text" else "element"
        a = b = 0.0
        for name, value in found:
            x = model.evidence.get((kind, name, value)) or model.unseen[kind, name]
            a, b = a + EVIDENCE * x[0], b + EVIDENCE * x[1]
        belief.append([a, b])
    tie = [((0.0, 0.0), (0.0, 0.0))] + [
        tuple(model.tie(_place(nodes[n.parent]), _kind(n), up) for up in (0, 1)) for n in nodes[1:]
    ]
    upward: list[tuple[float, float]] = [(0.0, 0.0)] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):  # children stand after their parents
        (a, b), (off, on) = belief[i], tie[i]
        upward[i] = (_log_sum(off[0] + a, off[1] + b), _log_sum(on[0] + a, on[1] + b))
        up = belief[nodes[i].parent]
        up[0] += upward[i][0]
        up[1] += upward[i][1]
    for i in range(1, len(nodes)):
        up, (off, on), own = belief[nodes[i].parent], tie[i], belief[i]
        # What the parent believes without this child.
        a, b = up[0] - upward[i][0], up[1] - upward[i][1]
        down = (_log_sum(off[0] + a, on[0] + b), _log_sum(off[1] + a, on[1] + b))
        own[0] += down[0]
        own[1] += down[1]
    return [1 / (1 + math.exp(min(700.0, max(-700.0, a - b)))) for a, b in belief]


def main_text(html: str | None, model: TreeModel) -> str:
    nodes = parse(html or "")
    sure = marginals(nodes, model)
    return " ".join(
        n.text for n, p in zip(nodes, sure, strict=True) if n.tag == "#text" and p > 0.5
    )


def extracted(pages: DataFrame, model: TreeModel, html_col: str = "html") -> DataFrame:
    """The pages with text and n_chars in place of the html."""
    pages = pages.drop(*(c for c in ("text", "n_chars") if c != html_col))
    place = pages.columns.index(html_col)
    fields = [f for f in pages.schema.fields if f.name != html_col]
    schema = T.StructType([*fields]).add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, model) for h in batch.column(place).to_pylist()]
            kept = [c for k, c in enumerate(batch.columns) if k != place]
            found = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(kept + found, names=schema.names)

    return pages.mapInArrow(run, schema)


class _Writer:
    """Random pages in the layouts of common sites, with labels."""

    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        pick = self.rng.choice
        parts = ["ba", "de", "ki", "lo", "mu", "na", "re", "si", "to", "vu", "é", "ß", "ñ"]
        n = self.rng.randint(low, high)
        return " ".join("".join(pick(parts) for _ in range(self.rng.randint(1, 4))) for _ in range(n))

    def sentences(self, low: int, high: int) -> str:
        n = self.rng.randint(low, high)
        return " ".join(self.words(1, 18).capitalize() + self.rng.choice("...!?") for _ in range(n))

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.words(1, 1)}">{self.words(1, 3)}</a>' for _ in range(self.rng.randint(low, high))]
        if self.rng.random() < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items)

    def named(self, *names: str) -> str:
        return f'{self.rng.choice(["class", "id"])}="{self.rng.choice(names)}"'

    def paragraph(self) -> str:
        r = self.rng.random()
        text = self.sentences(1, 9)
        if r < 0.12:
            text = self.words(1, 8)
        elif r < 0.2:
            text = f'{text} <a href="/x">{self.words(1, 4)}</a> {self.words(2, 9)}.'
        elif r < 0.28:
            text = f"<b>{self.words(2, 7)}.<br>"
        elif r < 0.34:
            return f"<ul>{''.join(f'<li>{self.sentences(1, 2)}</li>' for _ in range(3))}</ul>"
        elif r < 0.38:
            return f"<blockquote><p>{text}</p></blockquote>"
        elif r < 0.42:
            return f"<table><tr><td>{self.words(1, 5)}</td><td>{self.words(1, 5)}</td></tr></table>"
        elif r < 0.46:
            return f"<pre>{text}</pre>"
        return f"<p>{text}</p>" if self.rng.random() < 0.8 else f"<p>{text}"

    def inner(self) -> str:
        """What stands inside an article without being part of it."""
        r = self.rng.random()
        if r < 0.25:
            return f'<div data-main="0" {self.named("share", "social-bar", "tags")}>{self.links(2, 5)}</div>'
        if r < 0.5:
            box = self.named("ad", "advert", "ad-slot", "sponsored", "promo-box")
            return f'<div data-main="0" {box}><p>{self.sentences(1, 2)}</p></div>'
        if r < 0.75:
            return f'<form data-main="0"><label>{self.words(1, 6)}</label><input><button>{self.words(1, 2)}</button></form>'
        return f'<aside data-main="0"><h4>{self.words(1, 4)}</h4>{self.links(2, 4)}</aside>'

    def article(self) -> str:
        title = f"<h1>{self.words(2, 9).capitalize()}{self.rng.choice(['', '.'])}</h1>"
        parts = [self.paragraph() for _ in range(self.rng.randint(1, 9))]
        if self.rng.random() < 0.3:
            parts.insert(len(parts) // 2, self.inner())
        if self.rng.random() < 0.3:
            parts.insert(len(parts) // 2, f"<h2>{self.words(1, 6)}</h2>")
        body = title * (self.rng.random() < 0.8) + "".join(parts)
        r = self.rng.random()
        if r < 0.6:
            return f'<article data-main="1">{body}</article>'
        if r < 0.75:
            return f'<main data-main="1">{body}</main>'
        names = ("content", "post", "entry-content", "article-body", "story", "main-text")
        return f'<div data-main="1" {self.named(*names)}>{body}</div>'

    def edge(self, top: bool) -> str:
        r, pick = self.rng.random(), self.rng.choice
        line = pick([self.sentences(1, 2), "&copy; " + self.words(1, 4), self.links(2, 7)])
        if top:
            if r < 0.35:
                return f"<nav>{self.links(3, 9)}</nav>"
            if r < 0.5:
                return f"<header><h2>{self.words(1, 4)}</h2>{self.links(2, 6)}</header>"
            if r < 0.6:
                return f'<div {self.named("menu", "navbar", "top-nav", "header")}>{self.links(3, 8)}</div>'
            if r < 0.8:
                return f'<div {self.named("ad", "advert", "banner", "ads", "sponsor")}>{self.sentences(1, 3)}</div>'
            if r < 0.92:
                names = ("cookie-notice", "notice", "alert", "consent-popup")
                return f"<div {self.named(*names)}><p>{self.sentences(1, 3)}</p><button>OK</button></div>"
            return f'<div {self.named("breadcrumb", "search-form")}>{self.links(1, 4)}</div>'
        if r < 0.45:
            return f"<footer>{line}</footer>"
        if r < 0.55:
            return f'<div {self.named("footer", "site-footer", "copyright", "legal")}>{line}</div>'
        if r < 0.7:
            return f'<aside {self.named("sidebar", "widget", "related")}><h3>{self.words(1, 3)}</h3>{line}</aside>'
        if r < 0.9:
            comments = "".join(
                f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.sentences(1, 4)}</p></div>'
                for _ in range(self.rng.randint(1, 4))
            )
            return pick(["<section", "<div"]) + f' {self.named("comments", "comment-list", "disqus")}>{comments}</section>'
        return f"<form><label>{self.words(1, 5)}</label><input><button>{self.words(1, 2)}</button></form>"

    def plain(self) -> str:
        """Pages that name nothing, or whose names point both ways."""
        r, pick = self.rng.random(), self.rng.choice
        head = f"<head><title>{self.words(1, 6)}</title></head>"
        menu = " ".join(f'<a href="/{k}">{self.words(1, 2)}</a>' for k in range(self.rng.randint(2, 6)))
        end = pick(["Copyright ", "&copy; ", "All rights reserved "]) + self.words(1, 4)
        text = self.sentences(2, 8)
        if r < 0.3:  # boxes in boxes, told apart by links and sentences alone
            body = f"<div>{text}</div>" if self.rng.random() < 0.6 else f"<div><div>{text}</div><div>{self.sentences(1, 5)}</div></div>"
            inside = f'<div data-main="0">{menu}</div><div data-main="1">{body}</div><div data-main="0">{end}</div>'
            return f'<html data-main="0">{head}<body><div>{inside}</div></body></html>'
        if r < 0.45:  # text without paragraphs, deep in an article
            depth = self.rng.randint(1, 4)
            body = "<div>" * depth + self.sentences(1, 4) + "</div>" * depth
            return f'<html data-main="0">{head}<body><nav>{menu}</nav><article data-main="1">{body}</article><footer>{end}</footer></body></html>'
        if r < 0.75:  # a head of the article, and boxes that list other articles
            top = self.named("content-header", "article-header", "entry-header", "post-header", "postTitle", "article-meta")
            other = self.named("related-posts", "related-articles", "more-stories", "recommended-content", "popular-posts", "post-comments", "comment-content", "share-post", "articleNav")
            box = pick([f"<p>{self.sentences(1, 2)}</p>", self.links(2, 5), f"<h3>{self.words(1, 3)}</h3><p>{self.sentences(1, 3)}</p>"])
            main = f'<div {top}><h1>{self.words(2, 8)}</h1></div>' + "".join(self.paragraph() for _ in range(self.rng.randint(1, 6)))
            shell = pick(["<article{}>{}</article>", "<main{}>{}</main>", "<section{}>{}</section>", "<div{}>{}</div>"])
            after = f'<div data-main="0" {other}>{box}</div>'
            body = shell.format(' data-main="1"', main)
            return f'<html data-main="0">{head}<body><header>{menu}</header>{body}{after}<footer>{end}</footer></body></html>'
        if r < 0.9:  # paragraphs in a nameless box
            body = "".join(f"<p>{self.sentences(1, 5)}</p>" for _ in range(self.rng.randint(1, 5)))
            return f'<html data-main="0">{head}<body><div>{menu}</div><div data-main="1">{body}</div><div>{end}</div></body></html>'
        rows = f'<tr><td data-main="0">{menu}</td><td data-main="1">{text}</td></tr>'
        return f'<html data-main="0">{head}<body><table>{rows}<tr><td>{end}</td></tr></table></body></html>'

    def page(self) -> str:
        if self.rng.random() < 0.33:
            return self.plain()
        head = f"<head><title>{self.words(1, 6)}</title><style>p{{margin:0}}</style></head>"
        above = "".join(self.edge(True) for _ in range(self.rng.randint(0, 3)))
        below = "".join(self.edge(False) for _ in range(self.rng.randint(0, 3)))
        r = self.rng.random()
        if r < 0.08:  # a bare page: text and nothing else
            middle = "".join(f'<p data-main="1">{self.sentences(1, 6)}</p>' for _ in range(3))
            return f"<html>{head}<body>{middle}</body></html>"
        if r < 0.16:
            return f'<html>{head}<body data-main="1">{self.sentences(2, 9)}</body></html>'
        middle = self.article()
        if r < 0.35:
            middle = f'<div {self.named("wrapper", "container", "page")}>{middle}</div>'
        return f'<!DOCTYPE html><html data-main="0">{head}<body>{above}{middle}{below}</body></html>'


def labelled_pages(n: int = PAGES, seed: int = 7) -> list[str]:
    writer = _Writer(seed)
    return [writer.page() for _ in range(n)]
