"""Block structure of an HTML page: its block-level elements as a tree, and their text.

Tags are read as browsers read them where that matters to text: comments and
declarations vanish, scripts, styles and other elements without readable text
are left out, a paragraph ends where the next block begins, items and cells end
where the next one begins, end tags without a start are ignored, whatever is
open at the end of the page ends there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np

#: Elements that begin and end blocks.
BLOCKS = (
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead "
    "tbody tfoot tr td th blockquote pre figure figcaption details summary address center hgroup "
    "header footer nav aside menu form fieldset legend dialog search hr").split()
#: Elements whose content is no readable text.
SILENT = set(
    "title script style noscript template textarea select button iframe object svg canvas "
    "audio video datalist noembed noframes xmp".split())
#: Elements whose content holds no tags, and elements without content.
RAW = set("script style textarea title iframe noembed noframes xmp".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open one of the second set.
ENDS = {
    **dict.fromkeys("main article section div p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre "
                    "figure details address center hgroup header footer nav aside menu form "
                    "fieldset dialog search hr figcaption summary li dt dd".split(), {"p"}),
    "body": {"head"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "tbody": {"thead", "tbody", "tr", "td", "th", "p"},
    "tfoot": {"tbody", "tr", "td", "th", "p"},
}
ITEMS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
         "dd": ({"dt", "dd"}, {"dl"})}
#: Elements that an implied end doesn't reach through.
FENCES = {"p": {"table", "td", "th", "caption", "button", "object"},
          **dict.fromkeys(("tr", "td", "th", "thead", "tbody"), {"table"})}

#: Elements that the end tag of an element outside doesn't end.
CELLS = {"table", "td", "th", "caption"}

TAG = {t: i for i, t in enumerate(BLOCKS)}
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)", re.S)
_NAMING = re.compile(
    r"""(?:class|id|role|itemprop|aria-label|style|(hidden|aria-hidden))"""
    r"""(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


@dataclass
class Tree:
    """Block elements in page order (so an element's descendants follow it), and text blocks."""

    tag: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)  # of the element's descendants
    names: list[str] = field(default_factory=list)  # what names and styles the element, raw
    inline: list[int] = field(default_factory=list)  # inline elements right in it
    linked: list[int] = field(default_factory=list)  # characters in links right in it
    owner: list[int] = field(default_factory=list)  # of each text block
    text: list[str] = field(default_factory=list)

    def __len__(self) -> int:
        return len(self.tag)


def name_tokens(attributes: str) -> list[str]:
    """Words of the attributes that name, place or style an element."""
    out: list[str] = []
    for m in _NAMING.finditer(attributes):
        if m.group(1):
            if (m.group(2) or m.group(3) or m.group(4) or "true").lower() != "false":
                out.append("hidden")
        else:
            out += [p.lower() for p in _PART.findall(m.group(2) or m.group(3) or m.group(4) or "")]
    return out


def _end_fences(name: str) -> set[str]:
    """Elements that an end tag doesn't reach through."""
    if name in FENCES:
        return FENCES[name]
    if name in SILENT or name in CELLS or name == "tfoot":
        return set()
    return CELLS if name in TAG else set(TAG)


def parse(html: str) -> Tree:
    """The tree of a page; its first element stands for the page as a whole."""
    tree = Tree([TAG["html"]], [-1], [0], [0], [""], [0], [0])
    stack: list[tuple[str, int]] = [("", 0)]  # open elements, and their block (-1: inline)
    open_: dict[str, int] = {}
    pieces: list[str] = []
    block, links, silent = 0, 0, 0

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                tree.owner.append(block)
                tree.text.append(text)

    def close() -> None:
        nonlocal block, links, silent
        name, own = stack.pop()
        open_[name] -= 1
        if own >= 0:
            flush()
            tree.end[own] = len(tree)
            block = tree.parent[own]
        elif name == "a":
            links -= 1
        if name in SILENT:
            silent -= 1

    def close_to(names: set[str], fences: set[str]) -> None:
        """Ends the innermost open element of these names, if no fence stands before it."""
        if not any(open_.get(n) for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                while len(stack) > i:
                    close()
                return
            if stack[i][0] in fences:
                return

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        start = m.start() if m else size
        if start > at and not silent:
            piece = html[at:start]
            if "&" in piece:
                piece = unescape(piece)
            pieces.append(piece)
            if links:
                tree.linked[block] += len(piece)
        if not m:
            break
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        if m.group(1) or m.group(4):  # an end tag
            if open_.get(name):
                close_to({name}, _end_fences(name))
            elif name == "p":
                flush()
            elif name == "br":
                pieces.append(" ")
            continue
        attributes = m.group(3) or m.group(6) or ""
        if name in ENDS:
            for ended in ENDS[name]:
                close_to({ended}, FENCES.get(ended, set()))
        if name in ITEMS:
            close_to(*ITEMS[name])
        if name in VOID:
            if name == "br":
                pieces.append(" ")
            elif name == "hr":
                flush()
            continue
        if name in TAG and not silent:
            flush()
            own = len(tree)
            tree.tag.append(TAG[name])
            tree.parent.append(block)
            tree.depth.append(tree.depth[block] + 1)
            tree.end.append(own + 1)
            tree.names.append(attributes)
            tree.inline.append(0)
            tree.linked.append(0)
            block = own
        else:
            own = -1
            tree.inline[block] += 1
            if name == "a":
                links += 1
        if name in SILENT:
            silent += 1
        stack.append((name, own))
        open_[name] = open_.get(name, 0) + 1
        if name in RAW:
            ended = _RAW_END[name].search(html, at)
            at = ended.start() if ended else size
    while len(stack) > 1:
        close()
    flush()
    tree.end[0] = len(tree)
    return tree


def by_depth(depth: np.ndarray) -> list[np.ndarray]:
    """Element numbers by depth, from the top."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []
