"""A forgiving HTML reader: a tree of elements with a hash of each subtree.

It follows the tree rules of HTML that change which text belongs to which
element (optional end tags, unclosed paragraphs and inline marks, raw text
elements, cut-off pages); nothing else of a browser. One pass, no recursion, so
depth and length of a page are bounded by its own size only.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import xxhash

# element names (fixed values)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search"
    " section select summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body caption head html legend optgroup option select tbody td tfoot th thead tr".split())
BARRIER = frozenset("table td th caption template button object html".split())
TABLE_PARTS = {"tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
               "tbody": ("tbody", "thead", "tfoot"), "thead": ("tbody", "thead", "tfoot"),
               "tfoot": ("tbody", "thead", "tfoot")}
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}

_MARK = re.compile(
    r"""<(?:(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)(?:>|\Z)"""
    r"""|!--(?:-?>|.*?(?:--!?>|\Z))|[!?/][^>]*+(?:>|\Z))""", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


class Node:
    """An element: name, attribute text, children (texts and nodes), text length and hash of its subtree."""

    __slots__ = ("tag", "attrs", "kids", "size", "digest", "main")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids = tag, attrs, []
        self.size, self.digest, self.main = 0, b"", False

    def close(self) -> None:
        """Size and hash, once all children are there: name, texts with white space evened out, children's hashes."""
        parts, size = [self.tag], 0
        for k in self.kids:
            if type(k) is str:
                t = " ".join(k.split())
                if t:
                    parts.append(t)
                    size += len(t)
            else:
                parts.append(k.digest)
                size += k.size
        self.size = size
        self.digest = xxhash.xxh3_64_hexdigest("\0".join(parts).encode("utf-8", "surrogatepass"))


def signed(digest: str) -> int:
    """The hash as a signed 64-bit integer."""
    v = int(digest, 16)
    return v - (1 << 64) if v >> 63 else v


def parse(html: str) -> Node:
    """The tree of a page; any text gives one."""
    root = Node("html")
    stack, opened = [root], defaultdict(int)
    pos, end = 0, len(html)

    def pop_to(at: int) -> None:
        while len(stack) > at:
            node = stack.pop()
            opened[node.tag] -= 1
            node.close()

    def find(names, stops) -> int:
        """Place of the nearest open element of ``names`` that no element of ``stops`` hides (0: none)."""
        for at in range(len(stack) - 1, 0, -1):
            tag = stack[at].tag
            if tag in names:
                return at
            if tag in stops:
                return 0
        return 0

    while pos < end:
        m = _MARK.search(html, pos)
        cut = m.start() if m else end
        if cut > pos:
            text = html[pos:cut]
            stack[-1].kids.append(unescape(text) if "&" in text else text)
        if m is None:
            break
        pos = m.end()
        closing, tag, attrs = m.group(1, 2, 3)
        if tag is None:   # a comment, a doctype, an instruction
            continue
        if html[pos - 1] != ">":   # the page ends inside a tag
            break
        tag = tag.lower()
        if closing:
            if tag == "br":
                stack[-1].kids.append(" ")
            elif opened[tag] and tag not in ("body", "html"):
                if tag in BLOCK:
                    stops = () if tag in ("table", "template") else (
                        ("table",) if tag in TABLE_PARTS else BARRIER - {tag})
                else:   # an inline mark closes nothing but inline marks
                    stops = BLOCK
                at = find((tag,), stops)
                if at:
                    pop_to(at)
            continue
        if tag in ("html", "body"):   # their start tags are optional, their attributes not needed
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                if tag == "hr" and opened["p"]:
                    at = find(("p",), BARRIER)
                    if at:
                        pop_to(at)
                stack[-1].kids.append(" ")
            continue
        if tag in CLOSES_P and opened["p"]:
            at = find(("p",), BARRIER)
            if at:
                pop_to(at)
        if tag in ITEMS:
            at = find(ITEMS[tag], BLOCK - {"address", "div", "p", *ITEMS[tag]})
            if at:
                pop_to(at)
        elif tag in TABLE_PARTS:
            at = find(TABLE_PARTS[tag], ("table",))
            if at:
                pop_to(at)
        elif opened["head"] and tag in BLOCK:   # body content ends an unclosed head
            at = find(("head",), BLOCK - {"head"})
            if at:
                pop_to(at)
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        if tag in RAW:
            close = _RAW_END[tag].search(html, pos)
            if tag == "textarea":
                node.kids.append(unescape(html[pos:close.start() if close else end]))
            node.close()
            if close is None:
                break
            pos = html.find(">", close.end()) + 1 or end
            continue
        stack.append(node)
        opened[tag] += 1
    pop_to(0)
    return root


def nodes(root: Node):
    """All elements, parents before children, in page order."""
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo.extend(k for k in reversed(node.kids) if type(k) is not str)


def text_of(root: Node, drop) -> str:
    """Text below ``root`` but for elements that ``drop`` names: blocks apart by a space, white space evened out."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if type(node) is str:
            out.append(node)
        elif not drop(node):
            if node.tag in BLOCK:
                out.append(" ")
                todo.append(" ")
            todo.extend(reversed(node.kids))
    return " ".join("".join(out).split())
