"""A small tree of HTML elements with the few selectors that extraction needs.

Well-formed pages give the tree that browsers build; void elements and paragraphs and
list items without an end tag are closed as in browsers, other errors are not repaired.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

# Elements without an end tag, and elements whose start ends an open one.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
ENDS_PARAGRAPH = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
RAW = {"script", "style"}

_STEP = re.compile(r"(?P<tag>[a-z][a-z0-9]*)?(?P<rest>(?:[#.][\w-]+|\[[\w-]+(?:[*^]?=(?:'[^']*'|\"[^\"]*\"|[^\]]*))?\])*)")
_MARK = re.compile(r"#([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:([*^]?=)(?:'([^']*)'|\"([^\"]*)\"|([^\]]*)))?\]")


class Element:
    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[Element | str] = []
        self.classes = set(attrs.get("class", "").split())

    def children(self) -> list[Element]:
        return [x for x in self.items if isinstance(x, Element)]

    def inside(self) -> Iterator[Element]:
        """All elements below, in document order."""
        stack = self.children()[::-1]
        while stack:
            e = stack.pop()
            yield e
            stack += e.children()[::-1]

    def text(self) -> str:
        out, stack = [], self.items[::-1]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                stack += x.items[::-1]
        return "".join(out)

    def inner_html(self) -> str:
        return _written([(x, self) for x in reversed(self.items)])

    def html(self) -> str:
        return _written([(self, None)])

    def closest(self, *tags: str) -> Element | None:
        e = self
        while e is not None and e.tag not in tags:
            e = e.parent
        return e

    def before(self) -> Element | None:
        """The element before this one under the same parent."""
        siblings = self.parent.children() if self.parent else []
        k = siblings.index(self) if self in siblings else 0
        return siblings[k - 1] if k else None

    def select(self, selector: str) -> list[Element]:
        """Elements below that match one of some comma-separated selectors, in document order."""
        ways = [_steps(s) for s in selector.split(",")]
        return [e for e in self.inside() if any(_matches(e, w) for w in ways)]

    def first(self, selector: str) -> Element | None:
        return next(iter(self.select(selector)), None)


def _escaped(text: str, quote: bool = False) -> str:
    text = text.replace("&", "&amp;").replace("\u00a0", "&nbsp;")
    return text.replace('"', "&quot;") if quote else text.replace("<", "&lt;").replace(">", "&gt;")


def _written(stack: list[tuple[Element | str, Element | None]]) -> str:
    """Markup of a stack of items with their parents, the first on top; an item without a parent that is a text is written as it is.
    A stack of its own, as pages may be nested deeper than calls can be."""
    out = []
    while stack:
        x, parent = stack.pop()
        if isinstance(x, str):
            out.append(x if parent is None or parent.tag in RAW else _escaped(x))
            continue
        attrs = "".join(f' {k}="{_escaped(v, quote=True)}"' for k, v in x.attrs.items())
        out.append(f"<{x.tag}{attrs}>")
        if x.tag not in VOID:
            stack.append((f"</{x.tag}>", None))
            stack += [(item, x) for item in reversed(x.items)]
    return "".join(out)


def _steps(selector: str) -> list[tuple[bool, str | None, list[tuple]]]:
    """(is it a child of the step before?, tag, marks) for each step."""
    steps, child = [], False
    for part in selector.split():
        if part == ">":
            child = True
            continue
        m = _STEP.fullmatch(part)
        if m is None:
            raise ValueError(f"selector not understood: {selector}")
        marks = [(i, c, a, op, v1 or v2 or v3 or "") for i, c, a, op, v1, v2, v3 in _MARK.findall(m["rest"])]
        steps.append((child, m["tag"], marks))
        child = False
    return steps


def _fits(e: Element, step: tuple) -> bool:
    _, tag, marks = step
    if tag and e.tag != tag:
        return False
    for ident, cls, attr, op, value in marks:
        own = e.attrs.get(attr) if attr else None
        ok = (
            e.attrs.get("id") == ident if ident else cls in e.classes if cls else own is not None
            and (not op or op == "=" and own == value or op == "^=" and own.startswith(value) or op == "*=" and value in own)
        )
        if not ok:
            return False
    return True


def _matches(e: Element, steps: list[tuple]) -> bool:
    if not _fits(e, steps[-1]):
        return False
    if len(steps) == 1:
        return True
    up = e.parent
    if steps[-1][0]:
        return up is not None and _matches(up, steps[:-1])
    while up is not None:
        if _matches(up, steps[:-1]):
            return True
        up = up.parent
    return False


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#root", {}, None)
        self.at = self.root

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH and self.at.closest("p"):
            self._end("p")
        if tag in ENDS and self.at.tag in ENDS[tag]:
            self._end(self.at.tag)
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.items.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._end(tag)

    def handle_endtag(self, tag):
        self._end(tag)

    def _end(self, tag: str) -> None:
        found = self.at.closest(tag)
        if found is not None and found.parent is not None:
            self.at = found.parent

    def handle_data(self, data):
        self.at.items.append(data)


def parse(page: str | None) -> Element:
    b = _Builder()
    b.feed(page or "")
    b.close()
    return b.root
