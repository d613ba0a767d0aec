"""Container choice in a landed page, for use inside tasks: a small tree of the standard library's parser."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)

    def walk(self):
        """This node and those below it in document order; no recursion, so depth doesn't matter."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def matches(self, selector: str) -> bool:
        """tag, tag#id, tag.class, .class, #id, tag[name=value] or tag.*part for a class that holds the part."""
        if selector.endswith("]"):
            tag, _, rest = selector[:-1].partition("[")
            name, _, value = rest.partition("=")
            return tag in ("", self.tag) and self.attrs.get(name) == value
        for mark, name in (("#", "id"), (".", "class")):
            if mark in selector:
                tag, _, value = selector.partition(mark)
                have = self.attrs.get(name, "")
                fits = value[1:] in have if value.startswith("*") else have == value or (name == "class" and value in have.split())
                return tag in ("", self.tag) and bool(have) and fits
        return self.tag == selector

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                stack.extend(reversed(node.children))
        return "".join(out)

    def html(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                out.append(node[0])
            elif isinstance(node, str):
                out.append(escape(node, quote=False))
            else:
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in node.attrs.items())
                out.append(f"<{node.tag}{attrs}>")
                if node.tag not in VOID:
                    stack.append((f"</{node.tag}>",))
                    stack.extend(reversed(node.children))
        return "".join(out)

    def without(self, selectors) -> Node:
        for node in self.walk():
            node.children = [c for c in node.children if isinstance(c, str) or not any(c.matches(s) for s in selectors)]
        return self


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("document")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def choose(html: str, unwanted: list[str], selectors: list[str]) -> tuple[Node, str]:
    """The first element of the first selector that has one, once unwanted ones are gone; else the whole page."""
    root = parse(html).without(unwanted)
    for selector in selectors:
        for node in root.walk():
            if node.matches(selector):
                return node, selector
    return root, ""


def _local(tag) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


#: How elements' own texts are shown; those of other elements are left out.
MARKED = {"LongTitle": "\n= %s", "ShortTitle": "\n= %s", "Heading": "\n- %s", "TitleText": "\n- %s", "Label": "\n- %s", "MarginalNote": "\n[%s]", "Text": "%s", "FormGroup": "%s"}


def xml_text(xml: str, profile: str) -> str | None:
    """Text of an XML document, a line for each piece; null where it isn't well formed. "federal" shows own texts as MARKED
    says, "flat" shows all as they are. An element's tail always counts and comes before the texts of its children."""
    try:
        nodes = ET.fromstring(xml).iter()
    except ET.ParseError:
        return None
    shown = lambda node: "%s" if profile == "flat" else MARKED.get(_local(node.tag), "")
    pieces = ((form, text.strip()) for node in nodes for form, text in ((shown(node), node.text or ""), ("%s", node.tail or "")))
    return "\n".join(form % text for form, text in pieces if form and text)
