"""HTML without a third-party parser: a small tree, and what is read from it, in Arrow batches.

The tree follows lenient rules: void elements hold nothing, an end tag closes up to its nearest open
match and is ignored without one, unclosed elements stay open, of repeated attributes the last counts.
Text leaves out comments, and scripts, styles and templates below the node that is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import escape, unescape
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

# Elements that hold nothing, whose text is no text, that are removed, and that are kept.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template".split())
RUBY_NOTES = frozenset("rt rp".split())
REMOVED = frozenset("script style form input button iframe object img".split())
KEPT = frozenset("a strong b em i br p div span ul ol li table tbody tr td th ruby rt rp sub sup code pre blockquote".split())
HIGHLIGHT = "#00b060"


@dataclass(slots=True, eq=False)
class Node:
    """An element; children are nodes and strings (tag "" holds a comment). Attributes aren't changed: nodes of equal tags can share them."""

    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)
    parent: Node | None = None

    def walk(self) -> Iterator[Node]:
        """The elements below, in order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            if node.tag:
                yield node
                held = node.children
                if len(held) > 1:
                    stack += [c for c in reversed(held) if isinstance(c, Node)]
                elif held and isinstance(held[0], Node):
                    stack.append(held[0])

    def leaves(self, skip: frozenset[str] = frozenset()) -> Iterator[tuple[str, Node]]:
        """(text, its element) below, in order, a line break for each br; elements named in skip are passed over."""
        stack: list = [(c, self) for c in reversed(self.children)]
        while stack:
            item, parent = stack.pop()
            if isinstance(item, str):
                yield item, parent
            elif item.tag == "br":
                yield "\n", parent
            elif item.tag and item.tag not in skip:
                stack += [(c, item) for c in reversed(item.children)]

    def up(self) -> Iterator[Node]:
        node: Node | None = self
        while node is not None:
            yield node
            node = node.parent

    def elements(self, tag: str | None = None) -> list[Node]:
        """The children that are elements."""
        if tag is None:
            return [c for c in self.children if isinstance(c, Node) and c.tag]
        return [c for c in self.children if isinstance(c, Node) and c.tag == tag]

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def style(self) -> str:
        return "".join(self.attrs.get("style", "").split()).lower()

    def among(self, names: frozenset[str]) -> bool:
        """Whether one of the names is a class of the element."""
        named = self.attrs.get("class")
        return bool(named) and (named in names or not names.isdisjoint(named.split()))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("[document]")
        self.met = [self.root]

    def updatepos(self, i, j):
        """Lines aren't counted: no error names one."""
        return j

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, [], self.at)
        self.at.children.append(node)
        self.met.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        match = next((n for n in self.at.up() if n.tag == tag and n.parent is not None), None)
        if match is not None:
            self.at = match.parent

    def handle_data(self, data):
        if self.at.children and isinstance(self.at.children[-1], str):
            self.at.children[-1] += data
        else:
            self.at.children.append(data)

    def handle_comment(self, data):
        node = Node("", {}, [data], self.at)
        self.at.children.append(node)
        self.met.append(node)


#: Elements whose content the library's parser reads by rules of its own, and a plain tag: an end tag, or a start tag with quoted attributes without references.
_RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript plaintext".split())
_TAG = re.compile(r'/([a-z][a-z0-9]*)|([a-z][a-z0-9]*)((?: +[a-z][a-z0-9-]*="[^"<>&]*")*)')
_ATTRIBUTE = re.compile(r'([a-z][a-z0-9-]*)="([^"]*)"')
#: Characters of a tag up to which it is remembered.
_SHORT = 200


def _read_tag(inside: str) -> tuple[str, dict[str, str] | None] | None:
    """The name and attributes of what is between < and >, None for attributes of an end tag; None where it isn't plain."""
    found = _TAG.fullmatch(inside)
    if found is None or found[2] in _RAW:
        return None
    return (found[1], None) if found[1] else (found[2], dict(_ATTRIBUTE.findall(found[3])))


_known_tag = lru_cache(4096)(_read_tag)


def _plain(html: str, met: list[Node] | None = None) -> Node | None:
    """The tree of a page of plain tags only, as the library's parser would build it, in a fraction of its time; None for any other page. Tags that come again are read once.
    Its nodes are added to met in order."""
    first, *pieces = html.split("<")
    root = at = Node("[document]", {}, [], None)
    shown = root.children
    met = [] if met is None else met
    met.append(root)
    if first:
        shown.append(unescape(first))
    for piece in pieces:
        inside, closed, said = piece.partition(">")
        read = (_known_tag(inside) if len(inside) <= _SHORT else _read_tag(inside)) if closed else None
        if read is None:
            return None
        tag, attrs = read
        if attrs is not None:
            node = Node(tag, attrs, [], at)
            shown.append(node)
            met.append(node)
            if tag not in VOID:
                at, shown = node, node.children
        else:
            match = at
            while match is not root and match.tag != tag:
                match = match.parent
            if match is not root:
                at = match.parent
                shown = at.children
        if said:
            if "&" in said:
                said = unescape(said)
            if shown and isinstance(shown[-1], str):
                shown[-1] += said
            else:
                shown.append(said)
    return root


def nodes(html: str | None) -> list[Node]:
    """The nodes of a page's tree in order, the document first, comments too."""
    met: list[Node] = []
    if _plain(html or "", met) is not None:
        return met
    release(met)
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.met


def parse(html: str | None) -> Node:
    return nodes(html)[0]


def release(met: list[Node]) -> None:
    """Takes a tree apart that is no longer needed: its nodes name each other, so only Python's collector, which looks at all objects, would free them otherwise."""
    for node in met:
        node.parent = None


def terminated(html: Column) -> Column:
    """Pages in which only references that end in a semicolon are read as characters: any other & is written as &amp;. By HTML's own rules, which parse() follows, &amp and &copy
    count without a semicolon too, as where a title was cut. In scripts and comments, whose text isn't read, the change stays unseen."""
    return F.regexp_replace(html, "&(?!(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);)", "&amp;")


_UNSAID = SILENT | RUBY_NOTES


def text(node: Node | None) -> str:
    """All text, with line breaks for br, without white space at either end."""
    if node is None:
        return ""
    held = node.children
    if len(held) == 1 and isinstance(held[0], str):
        return held[0].strip()
    return "".join([t for t, _ in node.leaves(_UNSAID)]).strip()


def segments(node: Node, colour: str = HIGHLIGHT) -> list[dict]:
    """Runs of text, not stripped, by whether an element between them and the node is styled in the highlight colour."""
    runs: list[dict] = []
    stack: list = [(c, False) for c in reversed(node.children)]
    while stack:
        item, lit = stack.pop()
        if not isinstance(item, str):
            if item.tag != "br":
                if item.tag and item.tag not in SILENT:
                    lit = lit or colour in item.attrs.get("style", "").lower()
                    stack += [(c, lit) for c in reversed(item.children)]
                continue
            item = "\n"
        if runs and runs[-1]["grammar_highlight"] == lit:
            runs[-1]["text"] += item
        else:
            runs.append({"text": item, "grammar_highlight": lit})
    return runs


#: The tags around a kept element without attributes.
_BARE = {tag: (f"<{tag}>", f"</{tag}>") for tag in KEPT} | {"br": ("<br/>", "")}


def _opening(node: Node, base: str) -> tuple[str, str]:
    """The tags around a kept element; a pair of empty strings where only its content stays."""
    tag = node.tag
    if not node.attrs:
        return _BARE.get(tag, ("", ""))
    if tag == "span" and "font-weight:bold" in node.style() or tag == "font" and node.attrs.get("color", "").lower() in ("red", "#ff0000"):
        tag = "strong"
    if tag != "a" or not node.attrs.get("href"):
        return _BARE.get(tag, ("", ""))
    href = urljoin(base, node.attrs["href"])
    shown = f' href="{escape(href)}"' if urlsplit(href).scheme in ("http", "https") else ""
    return f"<{tag}{shown}>", f"</{tag}>"


def fragment(node: Node, base: str) -> str:
    """The content as HTML that is safe to show: a few elements, no attributes but absolute links, bold and red as strong."""
    held = node.children
    if len(held) == 1 and isinstance(held[0], str):
        return escape(held[0], quote=False).strip()
    out: list[str] = []
    stack: list = held[::-1]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(escape(item, quote=False))
        elif isinstance(item, tuple):
            out.append(item[0])
        elif item.tag and item.tag not in REMOVED:
            before, after = _opening(item, base)
            out.append(before)
            if after:
                stack.append((after,))
            stack += item.children[::-1]
        elif not item.tag:
            out.append(f"<!--{item.children[0]}-->")
    return "".join(out).strip()


def links(root: Node, base: str) -> list[dict]:
    return [{"url": urljoin(base, n.attrs["href"]), "label": text(n)} for n in root.walk() if n.tag == "a" and "href" in n.attrs]


def labelled_value(root: Node, label: str, italic: bool = False) -> str | None:
    """What follows a bold label, up to a line break; or the next italic text."""
    nodes = list(root.walk())
    marker = next((n for n in nodes if n.tag == "b" and "".join(t for t, _ in n.leaves()).rstrip() == label), None)
    if marker is None:
        return None
    if italic:
        later = nodes[nodes.index(marker) + 1 :]
        return text(next((n for n in later if n.tag == "i"), None)) or None
    out: list[str] = []
    siblings = marker.parent.children
    for item in siblings[next(i for i, s in enumerate(siblings) if s is marker) + 1 :]:
        if isinstance(item, Node) and item.tag == "br":
            break
        out.append(item if isinstance(item, str) else "".join(t for t, _ in item.leaves(SILENT)))
    return "".join(out).lstrip(": ").strip() or None


def _last(node: Node) -> bool:
    """Whether a node is the last of its parent's elements."""
    return next(c for c in reversed(node.parent.children) if isinstance(c, Node) and c.tag) is node


def credit(card: Node, footers: tuple[str, ...]) -> str | None:
    """The right-floated last span of the card's footer (a last child of one of the classes), without a leading number."""
    named = frozenset(footers)
    footer = next((n for n in card.walk() if n.attrs and n.among(named) and _last(n)), None)
    spans = footer.elements("span") if footer else []
    if not spans or "float:right" not in spans[-1].style():
        return None
    value = text(spans[-1])
    head, _, rest = value.partition("#") if value.startswith("#") else ("", "", "")
    return (rest.lstrip("0123456789").lstrip() if rest[:1].isdigit() else value) or None


def date_marks(root: Node) -> bool:
    """Whether any element carries a date."""
    return any(n.tag == "time" or {"datetime", "data-date", "data-timestamp"} & set(n.attrs) for n in root.walk())


def column(make, returns):
    """A column function of html that parses each page once and applies make to its tree.

    It is marked as not deterministic, so Spark evaluates it where it is written and once: a filter that explode() brings along would otherwise parse each page again below a shuffle.
    """

    def of(html: Column) -> Column:
        @F.pandas_udf(returns)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for pages in batches:
                yield pages.map(lambda x: None if x is None else made(x))

        def made(page: str):
            met = nodes(page)
            found = make(met[0])
            release(met)
            return found

        return run.asNondeterministic()(html)

    return of


LINK = StructType([StructField("url", StringType()), StructField("label", StringType())])
SEGMENT = StructType([StructField("text", StringType()), StructField("grammar_highlight", BooleanType())])

text_column = column(text, StringType())
date_marks_column = column(date_marks, BooleanType())
segments_column = column(segments, ArrayType(SEGMENT))


def fragment_column(html: Column, base: str) -> Column:
    return column(lambda root: fragment(root, base), StringType())(html)


def links_column(html: Column, base: str) -> Column:
    return column(lambda root: links(root, base), ArrayType(LINK))(html)


def labelled_value_column(html: Column, label: str, italic: bool = False) -> Column:
    return column(lambda root: labelled_value(root, label, italic), StringType())(html)
