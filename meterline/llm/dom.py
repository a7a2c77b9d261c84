"""A small tree of the blocks of an HTML page, for pages as they are found.

Elements that show as blocks become nodes; text between them becomes runs, the leaves. Inline elements only leave their
links. What is never shown as text (scripts, styles, head, form controls and the like) is left out while reading.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Their text is no text of the page; the first ones end only at their own end tag, whatever is inside.
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
HIDDEN = frozenset("head select button option svg math object canvas audio video datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD_ONLY = frozenset("meta link base title style script noscript template".split())
#: A start tag on the left ends open elements on the right, up to the nearest of the last set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass
class Node:
    tag: str
    up: int
    depth: int
    marks: str = ""
    words: list[str] = field(default_factory=list)
    linked: int = 0
    chars: int = 0
    text: bool = False
    label: str = ""


def read(page: str) -> list[Node]:
    """The nodes of a page in page order; the first is the root, runs have ``text``."""
    nodes = [Node("html", -1, 0)]
    open_: list[tuple[str, int]] = [("html", 0)]  # tag and the node whose block it is in or makes
    hidden = links = 0
    run: list[str] = []
    linked = at = 0

    def close_run() -> None:
        nonlocal linked
        words = html.unescape("".join(run)).split() if run else []
        if words:
            block = open_[-1][1]
            chars = sum(map(len, words))
            nodes.append(Node("#text", block, nodes[block].depth + 1, words=words, linked=min(linked, chars), chars=chars, text=True))
        run.clear()
        linked = 0

    def pop() -> None:
        nonlocal hidden, links
        tag = open_[-1][0]
        if tag in BLOCKS:
            close_run()
        hidden -= tag in HIDDEN
        links -= tag == "a"
        open_.pop()

    def say(text: str) -> None:
        nonlocal linked
        if not hidden and text:
            run.append(text)
            if links:
                linked += len(text) - text.count(" ")

    end = len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        name = found[2] or found[5]
        if not name:
            if page.startswith("<![CDATA[", found.start()):
                continue
            continue
        tag, closing, attributes = name.lower(), found[1] or found[4], found[3] if found[2] else found[6]
        if closing:
            if tag == "br":
                say(" ")
                continue
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] == tag:
                    while len(open_) > i:
                        pop()
                    break
                if open_[i][0] in ("article", "main", "section", "aside", "table", "td", "nav", "footer", "header") and tag not in BLOCKS:
                    break
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else (end if tag in ("script", "style", "textarea") else at)
            continue
        if tag == "br":
            say(" ")
            continue
        if hidden and open_[-1][0] == "head" and tag not in HEAD_ONLY:
            pop()  # a body that begins without its tag
        if tag in BLOCKS:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] == "p":
                    while len(open_) > i:
                        pop()
                    break
                if open_[i][0] in BLOCKS:
                    break
        if tag in _ENDS:
            ended, within = _ENDS[tag]
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] in ended:
                    while len(open_) > i:
                        pop()
                    if tag not in ("tr", "tbody"):
                        break
                elif open_[i][0] in within:
                    break
        if tag in VOID:
            if tag == "hr":
                close_run()
            continue
        if tag in ("html", "body") and tag == "html":
            continue
        if tag in BLOCKS:
            close_run()
            block = open_[-1][1]
            marks, label = [], ""
            for key, *values in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), values[0] or values[1] or values[2]
                if key in ("class", "id", "role", "aria-label", "itemprop"):
                    marks.append(value)
                elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                    marks.append("hidden")
                elif key == LABEL:
                    label = value
            nodes.append(Node(tag, block, nodes[block].depth + 1, " ".join(marks).lower(), label=label))
            open_.append((tag, len(nodes) - 1))
        else:
            if attributes.rstrip().endswith("/") and tag not in ("a", "span", "b", "i", "em", "strong"):
                continue
            hidden += tag in HIDDEN
            links += tag == "a"
            open_.append((tag, open_[-1][1]))
    while len(open_) > 1:
        pop()
    close_run()
    return nodes


#: Attribute that says, in a labelled page, whether what is inside is content (1) or not (0).
LABEL = "data-content"
