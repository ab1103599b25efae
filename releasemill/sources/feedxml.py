"""Task-side helper: items of one feed document, as many as can be read.

A pull parser over tags that never fails: what cannot be read is left out and it goes
on at the next item.  An item counts if it is closed; one that is cut off, or whose
end is missing before the next one begins, is lost.
"""

from __future__ import annotations

import html
import re

from releasemill.sources import devicexml

# Sections without tags first, so that nothing in them is taken for one.
TOKEN = re.compile(
    r"<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<!--.*?(?:-->|\Z)|<\?.*?(?:\?>|\Z)|<![^<>]*+>"
    r"|<(?P<close>/?)(?P<name>[A-Za-z_][\w:.\-]*+)(?P<rest>(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([\w:.\-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")

# Roots and items of the feed formats (RSS 2.0, RSS 1.0, Atom).
ROOTS = frozenset(("rss", "rdf", "feed"))
ITEMS = frozenset(("item", "entry"))

WHOLE, PARTIAL, EMPTY, FOREIGN = "whole", "partial", "empty", "foreign"


def _events(text: str):
    """(kind, name or text, attributes) of tags and of the text between them."""
    at = 0
    for token in TOKEN.finditer(text):
        if token.start() > at:
            yield "text", html.unescape(text[at : token.start()]), None
        at = token.end()
        if token["cdata"] is not None:
            yield "text", token["cdata"], None
        elif token["name"] is not None:
            name = token["name"].rpartition(":")[2].lower()
            if token["close"]:
                yield "end", name, None
            else:
                yield "start", name, token["rest"]
                if token["rest"].endswith("/"):
                    yield "end", name, None
    if at < len(text):
        yield "text", html.unescape(text[at:]), None


class _Item:
    """Title and link of an item; the first of each that says anything counts."""

    def __init__(self, name: str):
        self.name = name
        self.found = {"title": "", "link": ""}
        self.open: list[str] = []
        self.parts: list[str] = []

    def start(self, name, rest):
        self.open.append(name)
        if len(self.open) == 1:
            self.parts = []
            if name == "link":  # Atom keeps the address in an attribute
                given = {k: a or b for k, a, b in ATTRIBUTE.findall(rest)}
                if given.get("rel", "alternate") == "alternate" and not self.found["link"]:
                    self.found["link"] = html.unescape(given.get("href", "")).strip()

    def text(self, text):
        if self.open and self.open[0] in self.found:
            self.parts.append(text)

    def end(self, name):
        if name not in self.open:
            return  # the end of nothing
        while self.open:
            last = self.open.pop()
            if not self.open and last in self.found and not self.found[last]:
                self.found[last] = "".join(self.parts).strip()
            if last == name:
                return


def read(text: str) -> tuple[str, int, list[dict]]:
    """Verdict, number of lost items, and the items as `{title, link}` in feed order."""
    if not text.strip("﻿ \t\r\n\0"):
        return EMPTY, 0, []
    root, closed, item, lost, items = None, False, None, 0, []
    for kind, what, rest in _events(text):
        if kind == "text":
            if item is not None:
                item.text(what)
        elif root is None:
            if kind == "start":
                if what not in ROOTS:
                    return FOREIGN, 0, []
                root = what
        elif kind == "start":
            if what in ITEMS and (item is None or not item.open or what == item.name):
                lost += item is not None
                item = _Item(what)
            elif item is not None:
                item.start(what, rest)
        elif item is not None and what == item.name:
            item.end(item.open[0]) if item.open else None
            items.append(item.found)
            item = None
        elif what == root:
            closed = True
            lost, item = lost + (item is not None), None
        elif item is not None:
            item.end(what)
    if root is None:
        return FOREIGN, 0, []
    lost += item is not None
    return (WHOLE if closed and not lost else PARTIAL), lost, items


def read_bytes(data: bytes | None) -> tuple[str, int, list[dict]]:
    return read(devicexml.ILLEGAL_CONTROLS.sub("", devicexml.decode_charset(data or b"")))
