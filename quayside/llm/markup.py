"""Web pages as trees of block elements: what the content model sees of a page.

Inline elements belong to the block around them; scripts, styles, forms' controls and other elements that hold no
reading text are left out, comments and declarations too. Tags left open are closed by what follows, as a browser
would: a new paragraph ends an open one, an end tag ends all that was opened inside. A left-out element that is never
closed, or closes itself, leaves out nothing but its tag; a script, style or text area without an end tag leaves out
the rest. No recursion, so depth is no limit; a quote that never closes ends with its tag.
"""

from __future__ import annotations

import html
import re
from functools import cache
from typing import NamedTuple

# fixed values: element kinds of the HTML standard
SKIPPED = frozenset("head script style noscript template svg math iframe object canvas textarea select button datalist audio video label legend".split())
RAW = frozenset("script style textarea title iframe noscript".split())
#: Of these a browser takes all up to the end tag as text that is not shown, to the end of the page if there is none.
UNSHOWN = frozenset("script style textarea".split())
#: These may hold elements of their own kind.
NESTING = frozenset("svg math object head template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: What a new element of the kind ends, and where the search for it stops.
_ENDS = {k: (frozenset(v.split()), frozenset(w.split())) for k, v, w in (
    ("li", "li p", "ul ol menu dir"), ("dt", "dt dd p", "dl"), ("dd", "dt dd p", "dl"), ("tr", "tr td th p", "table"),
    ("td", "td th p", "tr table"), ("th", "td th p", "tr table"), ("tbody", "tbody thead tfoot tr td th p", "table"),
)}
_P_SCOPE = BLOCKS - {"p"}

# A quote opens a value only after an equals sign, and only if it closes; nothing is tried twice, so a stray quote costs
# no more than the tag.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(?:>|\Z)""", re.DOTALL
)
_NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)


class Page(NamedTuple):
    """Blocks in page order: parent, tag, names (class, id, role), link characters, own text pieces by place."""

    parent: list[int]
    tag: list[str]
    names: list[str]
    links: list[int]
    pieces: list[tuple[int, str]]
    labels: list[str]


@cache
def _tag_of(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.IGNORECASE)


def parse(source: str, label: str | None = None) -> Page:
    """The block tree of a page; node 0 stands for the page. ``label`` names an attribute to hand back per block."""
    parent, tag, names, links, labels = [-1], ["#page"], [""], [0], [""]
    pieces: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements with the block they belong to
    block, at, size = 0, 0, len(source)
    in_link = 0
    text: list[str] = []
    unclosed: set[str] = set()

    def flush() -> None:
        if text:
            own = " ".join(html.unescape("".join(text)).split())
            if own:
                pieces.append((block, own))
            text.clear()

    def close(depth: int) -> None:
        """Close all from this place of the stack on."""
        nonlocal block, in_link
        inner = stack[depth:]
        if any(b != stack[depth - 1][1] for _, b in inner):
            flush()
        in_link -= sum(t == "a" for t, _ in inner)
        del stack[depth:]
        block = stack[-1][1]

    while at < size:
        m = _TOKEN.search(source, at)
        end = m.start() if m else size
        if end > at:
            text.append(source[at:end])
            if in_link:
                links[block] += end - at
        if m is None:
            break
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] == name:
                    close(d)
                    break
                if stack[d][0] in ("table", "#page"):
                    break
            continue
        if name == "br" or name == "hr":
            text.append(" ")
            continue
        if name in VOID:
            continue
        if name in SKIPPED or name in RAW:
            if m.group(3).rstrip().endswith("/") and name not in UNSHOWN and name != "head":
                continue
            closing = None if name in unclosed else _tag_of(rf"</{name}\s*>").search(source, at)
            if closing is None:
                unclosed.add(name)  # nor is any later one
            if name not in UNSHOWN and name != "head":
                # never closed, or its kind opens again before: it has no content, the text after it is the page's
                if closing is None or name not in NESTING and _tag_of(rf"<{name}[\s>]").search(source, at, closing.start()):
                    text.append(" ")
                    continue
            if closing is None and name == "head":
                body = re.compile(r"<body\b", re.IGNORECASE).search(source, at)
                at = body.start() if body else at
            else:
                at = closing.end() if closing else size
            text.append(" ")
            continue
        if name in BLOCKS:
            ends, stops = _ENDS.get(name, (frozenset(("p",)), _P_SCOPE))
            lowest = 0
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] in ends:
                    lowest = d
                    if name not in _ENDS:
                        break
                elif stack[d][0] in stops:
                    break
            if lowest:
                close(lowest)
            flush()
            given = _NAMES.findall(m.group(3)) if m.group(3).strip() else []
            own = " ".join(v.strip("\"'") for k, v in given if k.lower() in ("class", "id", "role", "itemprop"))
            if any(k.lower() == "hidden" or k.lower() == "aria-hidden" and "true" in v or k.lower() == "style" and "display:none" in v.replace(" ", "").lower() for k, v in given):
                own += " hidden"
            parent.append(block)
            tag.append(name)
            names.append(own.lower())
            links.append(0)
            if label is not None:
                mark = re.search(rf'{label}="(\w+)"', m.group(3))
                labels.append(mark.group(1) if mark else "")
            block = len(tag) - 1
        elif name == "a":
            in_link += 1
        stack.append((name, block))
    flush()
    return Page(parent, tag, names, links, pieces, labels)
