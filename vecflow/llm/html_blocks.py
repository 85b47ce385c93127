"""The leaf sequence of a page: its blocks of text in page order, each with the path of tags above it.

A block is the text between two tags that are not inline. Text keeps its order; character references are decoded, white
space becomes one space, and blocks without text are left out. Scripts, styles, templates, frames' contents and
comments are no text. The rules are those of lenient readers: elements that need no end tag are closed by what follows
them, end tags without a start tag are passed over, and a page may break off anywhere.

Paths are nodes of a tree that a task keeps for all its pages, as pages repeat the same few; a node carries the hashed
words of all elements above (tag names, and words of their class, id, role and itemprop attributes) and those of the
innermost two. Beyond MAX_DEPTH levels elements add nothing to the path.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from typing import NamedTuple

#: Hashed words of a path: so many buckets for all elements above, and as many for the innermost two.
BUCKETS = 4096
MAX_DEPTH = 512
#: Nodes that a tree of paths holds before it is started anew.
MAX_NODES = 50_000

# Element names of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
SKIPPED = frozenset("script style template iframe noembed noframes xmp".split())
PLAIN = frozenset("title textarea".split())
NO_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: A start tag closes the nearest of these, looked for no further than the bounds.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "body": (("head",), ()),
} | {n: (("p",), ("td", "th", "button", "caption", "object")) for n in NO_P}

# A quote opens a value behind "=" only, and only where it is closed again: both loops give nothing back, and an
# unclosed quote is met once at most, so a page is read in linear time.
_TAG = re.compile(r"""<!--(?s:.*?)(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>="']|=\s*+(?:"[^"]*+"|'[^']*+')?|["'])*+)(?:>|\Z)|<[!?/](?:[^>]*+)(?:>|\Z)""")
_NAMED = re.compile(r"""(?i)(?<![\w-])(class|id|role|itemprop|style|hidden|aria-hidden)(?![\w-])\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PART = re.compile(r"[a-z]+")
_ENDS = {n: re.compile(rf"(?i)</{n}(?=[\s/>])[^>]*>?") for n in SKIPPED | PLAIN}


def _bucket(kind: str, word: str) -> int:
    return zlib.crc32(f"{kind}:{word}".encode()) % BUCKETS


def _words(attrs: str) -> list[str]:
    """Words of the telling attributes of a start tag, without digits, case and plural s."""
    out = []
    for m in _NAMED.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in ("hidden", "aria-hidden"):
            out += ["hidden"] * (value.lower() != "false")
        elif name == "style":
            out += ["hidden"] * ("display:none" in value.lower().replace(" ", ""))
        else:
            out += [w[:-1] if len(w) > 3 and w.endswith("s") and not w.endswith("ss") else w for w in _PART.findall(_CASE.sub(" ", value).lower())]
    return out


class Path:
    """A node of the tree of paths."""

    __slots__ = ("above", "children", "depth", "inner", "own", "vector")

    def __init__(self, above: frozenset, own: frozenset, inner: frozenset, depth: int):
        self.above, self.own, self.inner, self.depth, self.children, self.vector = above, own, inner, depth, {}, None


class Paths:
    """The tree of paths of one task."""

    def __init__(self):
        self.root, self.size = Path(frozenset(), frozenset(), frozenset(), 0), 0

    def fresh(self) -> Path:
        """The root, of an empty tree if the old one has grown too large."""
        if self.size > MAX_NODES:
            self.__init__()
        return self.root

    def child(self, at: Path, tag: str, attrs: str) -> Path:
        telling = "".join(m[0] for m in _NAMED.finditer(attrs)) if attrs else ""
        if at.depth >= MAX_DEPTH or (tag in INLINE and tag != "a" and not telling):
            return at
        key = (tag, telling)
        if (node := at.children.get(key)) is None:
            words = _words(attrs)
            own = frozenset([_bucket("tag", tag), *(_bucket("word", w) for w in words)])
            node = at.children[key] = Path(at.above | own, own, own | at.own, at.depth + 1)
            self.size += 1
        return node


class Leaf(NamedTuple):
    text: str
    path: Path
    linked: float  # part of the text that is in links


def leaves(page: str, paths: Paths) -> list[Leaf]:
    out: list[Leaf] = []
    stack: list[tuple[str, Path]] = [("", paths.fresh())]
    n_open: dict[str, int] = {}
    parts: list[str] = []
    first: Path | None = None
    linked = 0

    def flush():
        nonlocal first, linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Leaf(text, first or stack[-1][1], min(1.0, linked / len(text))))
        parts.clear()
        first, linked = None, 0

    def put(text: str):
        nonlocal first, linked
        if "&" in text:
            text = entities.unescape(text)
        parts.append(text)
        if first is None and not text.isspace():
            first = stack[-1][1]
        if n_open.get("a"):
            linked += len(text.strip())

    def cut(i: int):
        for name, _ in stack[i:]:
            n_open[name] -= 1
        del stack[i:]

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            put(page[at:])
            break
        if m.start() > at:
            put(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        inline = name in INLINE
        if m[1]:
            if not inline:
                flush()
            if n_open.get(name):
                i = next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name)
                if inline and any(n not in INLINE for n, _ in stack[i + 1 :]):  # a block is open in it: that stays
                    del stack[i]
                    n_open[name] -= 1
                else:
                    cut(i)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if not inline:
            flush()
        if name in SKIPPED:
            close = _ENDS[name].search(page, at)
            at = close.end() if close else end
            continue
        if name in CLOSES:
            mine, bounds = CLOSES[name]
            if any(n_open.get(x) for x in mine):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in mine:
                        cut(i)
                        break
                    if stack[i][0] in bounds:
                        break
        if name in VOID:
            continue
        stack.append((name, paths.child(stack[-1][1], name, m[3])))
        n_open[name] = n_open.get(name, 0) + 1
        if name in PLAIN:
            close = _ENDS[name].search(page, at)
            put(page[at : close.start() if close else end])
            flush()
            cut(len(stack) - 1)
            at = close.end() if close else end
    flush()
    return out
