"""A small tolerant HTML reader: elements with their statistics, and text blocks in page order."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")

# Fixed values of HTML: elements without content, with raw text, that start blocks, and what an opening tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot "
    "th thead tr ul button label title".split()
)
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
SCOPE = {"li": ("ul", "ol", "menu"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "dt": ("dl",), "dd": ("dl",)}


@dataclass(slots=True)
class Element:
    tag: str
    attributes: str
    parent: int
    depth: int
    index: int  # among its siblings
    children: list[int] = field(default_factory=list)
    own: int = 0  # characters of text directly inside
    first: int = 0  # characters of the page before it
    end: int = 0  # one past its last descendant


@dataclass(slots=True)
class Page:
    elements: list[Element]
    blocks: list[tuple[str, list[tuple[int, int]]]]  # text and (element, characters) it came from


def _closed_by(stack: list[int], elements: list[Element], tag: str) -> int:
    """How much of the stack stays when `tag` opens."""
    if tag in CLOSES:
        for at in range(len(stack) - 1, 0, -1):
            name = elements[stack[at]].tag
            if name in SCOPE.get(tag, ()):
                break
            if name in CLOSES[tag]:
                return at
    if tag in BLOCKS:
        for at in range(len(stack) - 1, 0, -1):
            name = elements[stack[at]].tag
            if name == "p":
                return at
            if name in BLOCKS:
                break
    return len(stack)


def parse(source: str) -> Page:
    """Elements in page order and the text blocks between block boundaries. Never fails, whatever the markup."""
    elements = [Element("#root", "", -1, 0, 0)]
    blocks: list[tuple[str, list[tuple[int, int]]]] = []
    stack, parts, owners = [0], [], []
    seen = 0

    def flush() -> None:
        nonlocal parts, owners
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((text, owners))
            parts, owners = [], []

    def add(raw: str) -> None:
        nonlocal seen
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if n := len(text.strip()):
            owner = stack[-1]
            owners.append((owner, n))
            elements[owner].own += n
            seen += n

    def close(to: int) -> None:
        for node in stack[to:]:
            elements[node].end = len(elements)
        del stack[to:]

    at, size = 0, len(source)
    while at < size:
        token = TOKEN.search(source, at)
        if token is None:
            tail = source[at:]
            cut = re.search(r"<[/a-zA-Z!][^>]*$", tail)  # a tag that the end of the page cut off
            add(tail[: cut.start()] if cut else tail)
            break
        if token.start() > at:
            add(source[at : token.start()])
        at = token.end()
        closing, tag, attributes = token.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                name = elements[stack[i]].tag
                if name == tag:
                    if any(elements[n].tag in BLOCKS for n in stack[i:]):
                        flush()
                    close(i)
                    break
                if tag not in BLOCKS and name in BLOCKS:
                    break  # an inline end tag closes nothing outside its block
            continue
        if tag in RAW:
            ended = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(source, at)
            at = ended.end() if ended else (size if tag in ("script", "style") else at)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        close(_closed_by(stack, elements, tag))
        parent = elements[stack[-1]]
        node = len(elements)
        elements.append(Element(tag, attributes, stack[-1], parent.depth + 1, len(parent.children), first=seen, end=node + 1))
        parent.children.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
    flush()
    close(0)
    return Page(elements, blocks)
