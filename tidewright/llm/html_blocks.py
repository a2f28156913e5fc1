"""A tolerant HTML reader: the text blocks of a page in order, and its media elements with their captions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

#: Element names of the HTML standard.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements of scripts and styles, of what no reader sees, and of forms' controls.
SKIPPED_TAGS = frozenset("script style noscript template svg iframe title textarea select button".split())
RAW_TAGS = frozenset("script style textarea title".split())
MEDIA_TAGS = frozenset("img audio video source embed".split())
#: What an opening tag closes: the open element of these names, unless one of the second names lies above it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*+)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_RAW_END = {t: re.compile(f"</{t}\\b[^>]*>", re.I) for t in RAW_TAGS}


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): unescape(v.strip("\"'")) for k, v in reversed(_ATTRIBUTE.findall(text))} if text.strip() else {}


def events(html: str) -> Iterator[tuple[str, str, str]]:
    """('text', text, ''), ('open', tag, attribute text) and ('close', tag, ''); raw elements come as open and close."""
    at, n = 0, len(html)
    while at < n:
        found = _TAG.search(html, at)
        if found is None:
            yield "text", unescape(html[at:]), ""
            return
        if found.start() > at:
            yield "text", unescape(html[at : found.start()]), ""
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            yield "close", tag, ""
            continue
        yield "open", tag, found[3]
        if found[3].endswith("/") and tag not in BLOCK_TAGS:
            yield "close", tag, ""
        elif tag in RAW_TAGS:
            end = _RAW_END[tag].search(html, at)
            if tag in ("title", "textarea"):
                yield "text", unescape(html[at : end.start() if end else n]), ""
            at = end.end() if end else n
            yield "close", tag, ""


@dataclass
class Block:
    """Text of one block with white space as single blanks, its open elements (with class and id words), and how many of
    its characters are in links. For media, ``media`` has the attributes and ``text`` is empty."""

    path: tuple[str, ...]
    text: str
    link_chars: int = 0
    media: dict[str, str] | None = None


def _names(tag: str, attr: str) -> tuple[str, ...]:
    if not attr:
        return (tag,)
    given = attributes(attr)
    words = re.findall(r"[a-z]+", " ".join((given.get("class", ""), given.get("id", ""), given.get("role", ""))).lower())
    return (tag, *(f".{w}" for w in words))


def skipped_to(found: list[tuple[str, str, str]]) -> dict[int, int]:
    """Where each skipped element's opening and closing tags are among the events. One that isn't closed before its
    enclosing block or that has the body's tag in it is left out, so what follows its tag is read as usual."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    open_now = dict.fromkeys((*BLOCK_TAGS, *SKIPPED_TAGS), 0)

    def pop() -> tuple[str, int]:
        open_now[stack[-1][0]] -= 1
        return stack.pop()

    for i, (kind, tag, _) in enumerate(found):
        if tag not in open_now or kind == "text":
            continue
        if kind == "open":
            if tag == "body":
                while stack:
                    pop()
            if tag != "hr":
                stack.append((tag, i))
                open_now[tag] += 1
        elif open_now[tag]:
            while stack[-1][0] != tag:
                pop()
            at = pop()[1]
            if tag in SKIPPED_TAGS:
                ends[at] = i
    return ends


def blocks(html: str, media: bool = False) -> list[Block]:
    """The blocks of a page that hold text (with ``media`` also its media elements), in page order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    links = in_link = 0
    resume = 0

    def flush() -> None:
        nonlocal links
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(tuple(x for _, names in stack for x in names), text, min(links, len(text))))
            pieces.clear()
        links = 0

    def close(names: set[str], above: set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in above:
                return

    found = list(events(html))
    ends = skipped_to(found)
    for i, (kind, value, attr) in enumerate(found):
        if i < resume:
            continue
        if kind == "text":
            pieces.append(value)
            if in_link:
                links += len(value)
        elif kind == "open":
            if value in SKIPPED_TAGS:
                resume = ends.get(i, i) + 1
                pieces.append(" ")
            elif value in BLOCK_TAGS:
                flush()
                if value in CLOSES:
                    close(*CLOSES[value])
                elif stack and stack[-1][0] == "p":
                    stack.pop()
                if value != "hr":
                    stack.append((value, _names(value, attr)))
            elif value == "a":
                in_link = 1
            elif value in ("br", "wbr", "input"):
                pieces.append(" ")
            elif media and value in MEDIA_TAGS:
                flush()
                out.append(Block(tuple(x for _, names in stack for x in names), "", 0, attributes(attr)))
        elif value == "a":
            in_link = 0
        elif value in BLOCK_TAGS:
            flush()
            close({value}, set())
    flush()
    return out
