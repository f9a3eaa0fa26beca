"""A small forgiving HTML reader: a page becomes a tree of elements and text blocks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements whose inside is never text of the page.
HIDDEN = frozenset("script style template noscript iframe textarea title svg head".split())
#: All that can stand in a head. The first other tag or text ends a head that is open.
HEAD = frozenset(
    "base basefont bgsound head html link meta noframes noscript script style template title".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: What an opening tag closes, if it is open further in than a container.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "thead": {"tr", "td", "th"},
    "tbody": {"thead", "tr", "td", "th"},
    "tfoot": {"tbody", "tr", "td", "th"},
}
STOPS = frozenset("ul ol dl table select body html div article section main aside nav td th".split())
TAG = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
LABEL = re.compile(r"""\bdata-main\s*=\s*["']?([01])""")


@dataclass
class Node:
    """An element, or a text block (tag ``#text``): the text between two block borders."""

    tag: str
    parent: int
    names: str = ""
    label: int | None = None
    children: list[int] = field(default_factory=list)
    text: str = ""
    linked: int = 0  # characters of the text inside links


def parse(html: str) -> list[Node]:
    """Nodes with parents before children; text blocks in page order."""
    nodes = [Node("#page", -1)]
    stack = [0]
    hidden = links = 0
    run: list[tuple[str, bool]] = []

    def flush() -> None:
        text = " ".join("".join(t for t, _ in run).split())
        if text:
            at = next(i for i in reversed(stack) if i == 0 or nodes[i].tag in BLOCKS)
            linked = sum(len("".join(t.split())) for t, link in run if link)
            nodes[at].children.append(len(nodes))
            nodes.append(Node("#text", at, text=text, linked=linked))
        run.clear()

    def close(upto: int) -> None:
        nonlocal hidden, links
        for i in stack[upto:]:
            hidden -= nodes[i].tag in HIDDEN
            links -= nodes[i].tag == "a"
        del stack[upto:]

    def end_head(tag: str) -> None:
        """Closes an open head before body content, with what is hidden inside it."""
        if not hidden or tag in HEAD:
            return
        for k in range(len(stack) - 1, 0, -1):
            if nodes[stack[k]].tag == "head":
                close(k)
                return
            # What stands in these is theirs; only the body itself ends them.
            if tag != "body" and nodes[stack[k]].tag in HIDDEN:
                return

    def open_tag(tag: str, attributes: str) -> None:
        nonlocal hidden, links
        end_head(tag)
        if tag in BLOCKS:
            flush()
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == "p":
                    close(k)
                    break
                if nodes[stack[k]].tag in BLOCKS:
                    break
        shut = CLOSES.get(tag, ())
        cut = 0
        for k in range(len(stack) - 1, 0, -1) if shut else ():
            if nodes[stack[k]].tag in shut:
                cut = k
            elif nodes[stack[k]].tag in STOPS:
                break
        if cut:
            close(cut)
        if tag == "a" and links:  # links don't nest
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == "a":
                    close(k)
                    break
        if tag == "br":
            run.append((" ", False))
        if tag in VOID:
            return
        named = [x for m in NAMES.findall(attributes) for x in m if x] if attributes else []
        label = LABEL.search(attributes) if attributes else None
        nodes[stack[-1]].children.append(len(nodes))
        nodes.append(Node(tag, stack[-1], " ".join(named), int(label[1]) if label else None))
        stack.append(len(nodes) - 1)
        hidden += tag in HIDDEN
        links += tag == "a"

    def close_tag(tag: str) -> None:
        if tag in BLOCKS:
            flush()
        for k in range(len(stack) - 1, 0, -1):
            if nodes[stack[k]].tag == tag:
                close(k)
                return
            # A stray end tag of an inline element doesn't close a block.
            if tag not in BLOCKS and nodes[stack[k]].tag in BLOCKS:
                return

    at = 0
    while at < len(html):
        found = TAG.search(html, at)
        start = found.start() if found else len(html)
        if hidden and not html[at:start].isspace() and start > at:
            end_head("#text")
        if start > at and not hidden:
            run.append((unescape(html[at:start]), links > 0))
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            close_tag(tag)
            continue
        attributes = found[3] or found[6] or ""
        open_tag(tag, attributes)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            close_tag(tag)
    flush()
    return nodes
