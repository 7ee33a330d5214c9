"""A small document tree over the standard library's HTML parser, with the selectors that sources use."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html.entities import html5
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open tag of the key is closed by a new one of the value.
CLOSED_BY = {"li": {"li"}, "p": {"p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "section", "article"}, "tr": {"tr", "tbody"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
STEP = re.compile(r"\s*([>\s])\s*(?=[\w.#*\[:])(?![^\[]*\])")
#: A mark and a name; or an attribute, how it is compared, its value, and whether case is let go; or a position.
PART = re.compile(r"([.#]?)([\w-]+|\*)|\[([\w-]+)(?:([*^$~]?=)[\"']?([^\"'\]]*?)[\"']?(\s+i)?)?\]|:(first-child|last-child|first-of-type)")


#: A script or style, which has no references; or an ampersand and what a whole reference has after it.
REFERENCE = re.compile(r"<(script|style)\b.*?</\1\b|&(?:(#[0-9]+|#x[0-9a-f]+|[a-z][a-z0-9]*);)?", re.I | re.S)


class Node:
    """An element. Texts are its strings among `parts`; `closed` says whether its end tag was there."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list[Node | str] = []
        self.index: dict[str, list] | None = None
        self.closed = False

    def children(self) -> list[Node]:
        return [x for x in self.parts if isinstance(x, Node)]

    def walk(self) -> Iterator[Node]:
        """Descendants in document order; a stack, not recursion, as pages can nest deeply."""
        todo = self.children()[::-1]
        while todo:
            node = todo.pop()
            yield node
            todo += node.children()[::-1]

    def raw_text(self) -> str:
        out, todo = [], self.parts[::-1]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo += x.parts[::-1]
        return "".join(out)

    def text(self) -> str:
        return " ".join(self.raw_text().split())

    def get(self, name: str) -> str:
        return " ".join((self.attrs.get(name) or "").split())

    def up(self) -> Iterator[Node]:
        node: Node | None = self
        while node is not None:
            yield node
            node = node.parent

    def closest(self, selector: str) -> Node | None:
        return next((x for x in self.up() if matches(x, selector)), None)

    def find(self, selector: str) -> list[Node]:
        return [x for x in self.likely(selector) if matches(x, selector)]

    def first(self, selector: str) -> Node | None:
        return next((x for x in self.likely(selector) if matches(x, selector)), None)

    def likely(self, selector: str) -> Iterable[Node]:
        """Descendants that may match, in document order: a whole document looks them up by tag, class and id."""
        keys = keys_of(selector)
        if self.parent is not None or keys is None:
            return self.walk()
        if self.index is None:
            self.index = {}
            for at, x in enumerate(self.walk()):
                names = {x.tag, *(f".{c}" for c in x.attrs.get("class", "").split()), f"#{x.attrs.get('id')}"}
                for name in names:
                    self.index.setdefault(name, []).append((at, x))
        if len(keys) == 1:
            return [x for _, x in self.index.get(keys[0], ())]
        return [x for _, x in sorted(dict(y for k in keys for y in self.index.get(k, ())).items())]

    def first_text(self, selector: str) -> str:
        found = self.first(selector)
        return found.text() if found else ""

    def drop(self, selector: str) -> None:
        for x in self.find(selector):
            x.parent.parts = [y for y in x.parent.parts if y is not x]
        self.index = None

    def html(self) -> str:
        out, todo = [], list(self.parts[::-1])
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif isinstance(x, tuple):
                out.append(x[0])
            else:
                out.append("<" + x.tag + "".join(f' {k}="{v}"' for k, v in x.attrs.items()) + ">")
                if x.tag not in VOID:
                    todo.append((f"</{x.tag}>",))
                    todo += x.parts[::-1]
        return "".join(out)


class Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        while tag in CLOSED_BY.get(self.at.tag, ()):
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.parts.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        for node in self.at.up():
            if node.tag == tag and node.parent is not None:
                self.at, node.closed = node.parent, True
                return

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)


def whole_only(html: str) -> str:
    """HTML in which an ampersand is text unless it begins a known reference that ends with its semicolon."""

    def kept(m: re.Match) -> str:
        name = m[2] or ""
        known = m[1] or name.startswith("#") or f"{name};" in html5
        return m[0] if known else f"&amp;{m[0][1:]}"

    return REFERENCE.sub(kept, html)


def parse(html: str | None, cut_references: bool = True) -> Node:
    """The document. Browsers also resolve some references without their semicolon; without `cut_references` these are text."""
    builder = Builder()
    builder.feed((html or "") if cut_references else whole_only(html or ""))
    builder.close()
    return builder.root


@lru_cache(maxsize=2048)
def compiled(selector: str) -> tuple:
    """A selector list as chains of (combinator, tests), the last step first."""
    chains = []
    for one in re.split(r",(?![^\[]*\])", selector):
        pieces = STEP.split(one.strip())
        steps = [(" " if i == 0 else pieces[i - 1], tuple(PART.findall(pieces[i]))) for i in range(0, len(pieces), 2)]
        chains.append(tuple(steps[::-1]))
    return tuple(chains)


@lru_cache(maxsize=2048)
def keys_of(selector: str) -> tuple[str, ...] | None:
    """For each selector of a list one tag, class or id that a match must have; None if one of them has none."""
    out = []
    for chain in compiled(selector):
        named = [mark + name for mark, name, *_ in chain[0][1] if name and name != "*"]
        if not named:
            return None
        out.append(max(named, key=lambda n: n[0] in ".#"))
    return tuple(dict.fromkeys(n if n[0] in ".#" else n.lower() for n in out))


def passes(node: Node, tests: tuple) -> bool:
    for mark, name, attr, op, value, fold, position in tests:
        if position:
            siblings = [x for x in (node.parent.children() if node.parent else [node]) if position != "first-of-type" or x.tag == node.tag]
            ok = siblings[-1 if position == "last-child" else 0] is node
        elif attr:
            own = node.attrs.get(attr)
            have, want = (x.lower() if fold else x for x in (own or "", value))
            ok = own is not None and {"": True, "=": have == want, "*=": want in have, "^=": have.startswith(want), "$=": have.endswith(want), "~=": want in have.split()}[op]
        elif mark == ".":
            ok = name in node.attrs.get("class", "").split()
        elif mark == "#":
            ok = node.attrs.get("id") == name
        else:
            ok = name == "*" or node.tag == name.lower()
        if not ok:
            return False
    return True


def matches(node: Node, selector: str) -> bool:
    def above(at: Node, steps: tuple) -> bool:
        if not steps[1:]:
            return True
        combinator, (_, tests) = steps[0][0], steps[1]
        for up in list(at.up())[1:]:
            if up.parent is None:
                return False
            if passes(up, tests) and above(up, steps[1:]):
                return True
            if combinator == ">":
                return False
        return False

    return any(passes(node, chain[0][1]) and above(node, chain) for chain in compiled(selector))
