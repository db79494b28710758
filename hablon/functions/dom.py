"""A tolerant tree of HTML elements, for extraction that depends on nesting. Used from Arrow batches only."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
# elements whose start ends an open paragraph
BLOCKS = frozenset(("address", "article", "aside", "blockquote", "div", "dl", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"))
HIDDEN = frozenset(("script", "style", "template"))


class Node:
    """An element with its attributes and its children, which are nodes and texts."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Node | None") -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self, skip: Callable[["Node"], bool] | None = None) -> Iterator["Node"]:
        """Elements below this one in document order, without those that ``skip`` holds for and what they hold."""
        todo = [c for c in reversed(self.children) if isinstance(c, Node)]
        while todo:
            node = todo.pop()
            if skip and skip(node):
                continue
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def texts(self) -> Iterator[str]:
        """Texts in document order, scripts and styles left out."""
        todo: list[Node | str] = list(reversed(self.children))
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                yield node
            elif node.tag not in HIDDEN:
                todo += reversed(node.children)

    def text(self, between: str = "") -> str:
        return between.join(self.texts())

    def words(self) -> str:
        """Stripped texts that are not blank, joined by blanks."""
        return " ".join(t for x in self.texts() if (t := x.strip()))

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            node = self.at
            while node.parent is not None and node.tag not in ("p", "td", "li", "div", "section", "article", "body"):
                node = node.parent
            if node.tag == "p":
                self.at = node.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:  # an end without a start is ignored
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The tree of a page; NULL, empty and broken pages give what can be made of them."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root
