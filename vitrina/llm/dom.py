"""A page as a light tree of elements with text blocks; runs inside tasks.

Tags are read as browsers do where it matters for text: quoted attributes, comments,
raw text of scripts and styles, void elements, and end tags that HTML lets out (a
paragraph ends at the next block, a list item at the next item).  Each node has a
presentation (tag, classes and id, digits as one) and a 64-bit key of the
presentations from the root down to it, so nodes of many pages meet under one key.
"""

from __future__ import annotations

import hashlib
import html
import re

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul").split())
#: Elements within a line whose end tag ends all that is open in them.
CONTAINER = frozenset("noscript template svg canvas object audio video button select math".split())
_CLOSED = BLOCK | CONTAINER
#: A start tag on the left ends an open element on the right, up to the nearest of SCOPE.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
        "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"tr", "td", "th", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
        "tfoot": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"}}
_P_SCOPE = frozenset(["table", "td", "th", "button", "object", "template", "svg"])
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"},
         "option": {"select"}, "optgroup": {"select"}, "body": set()}
#: Containers whose place among equal siblings is part of their presentation when they have no class or id.
PLACED = frozenset("div section table td ul ol".split())
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?=[\s/]|$))""", re.I)
_DIGITS = re.compile(r"\d+")


def _key(parent: int, sign: str, memo: dict) -> int:
    found = memo.get((parent, sign))
    if found is None:
        found = int.from_bytes(hashlib.blake2b(f"{parent}/{sign}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
        if len(memo) > 1 << 18:
            memo.clear()
        memo[(parent, sign)] = found
    return found


class Page:
    """Nodes by number, in page order (0: the root), and blocks of (node, text) segments."""

    def __init__(self, text: str, site: str, memo: dict):
        self.memo = memo
        self.tag, self.sign, self.parent, self.attributes = [""], [""], [-1], [{}]
        self.key = [_key(0, site, memo)]
        self.children: list[list[int]] = [[]]
        self.blocks: list[list[tuple[int, str]]] = [[]]
        self._open = [0]
        self._read(text)

    def _read(self, text: str) -> None:
        at, n, tags = 0, len(text), _TAG
        while at < n:
            lt = text.find("<", at)
            if lt < 0:
                self._text(text[at:])
                return
            if lt > at:
                self._text(text[at:lt])
            after = text[lt + 1 : lt + 2]
            if after == "!" or after == "?":
                comment = text.startswith("<!--", lt)
                end = text.find("-->", lt + 2) if comment else text.find(">", lt)
                if end < 0:
                    return
                at = end + (3 if comment else 1)
                continue
            m = tags.match(text, lt)
            if m is None and tags is _TAG and _PLAIN_TAG.match(text, lt):
                # a quote stays open up to the end: from here on quotes are not looked at, which keeps reading linear
                tags = _PLAIN_TAG
                m = tags.match(text, lt)
            if m is None:
                if after.isascii() and after.isalpha() or after == "/":
                    end = text.find(">", lt)
                    if end < 0:
                        return  # cut within a tag
                    at = end + 1
                else:
                    self._text("<")
                    at = lt + 1
                continue
            at, name = m.end(), m.group(2).lower()
            if m.group(1):
                self._end(name)
                continue
            self._start(name, m.group(3))
            if name in RAW:
                end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(text, at)
                if end is None:
                    return
                at = end.start()

    def _text(self, raw: str) -> None:
        if raw.isspace() or not raw:
            self.blocks[-1].append((self._open[-1], " "))
        else:
            self.blocks[-1].append((self._open[-1], html.unescape(raw) if "&" in raw else raw))

    def _break(self) -> None:
        if self.blocks[-1]:
            self.blocks.append([])

    def _start(self, name: str, rest: str) -> None:
        if name == "br":
            self.blocks[-1].append((self._open[-1], " "))
            return
        if name in BLOCK:
            self._break()
            self._close({"p"}, _P_SCOPE)
            if name in ENDS:
                while self._close(ENDS[name], SCOPE[name]):
                    pass
        parent = self._open[-1]
        found = {a.lower(): b or c or d or "" for a, b, c, d in _ATTRIBUTE.findall(rest)} if rest and not rest.isspace() else {}
        own = " ".join(sorted(found.get("class", "").split())) + "#" + found.get("id", "") if found else "#"
        sign = name if own == "#" else f"{name}.{_DIGITS.sub('0', own)}"
        if own == "#" and name in PLACED:
            sign = f"{name}:{sum(self.tag[c] == name for c in self.children[parent])}"
        node = len(self.tag)
        self.tag.append(name), self.sign.append(sign), self.parent.append(parent), self.attributes.append(found)
        self.key.append(_key(self.key[parent], sign, self.memo)), self.children.append([])
        self.children[parent].append(node)
        if name not in VOID and not rest.endswith("/") or name in RAW:
            self._open.append(node)

    def _close(self, names: set[str], until: set[str]) -> bool:
        """End the nearest open element of ``names`` unless one of ``until`` is nearer."""
        for i in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[i]]
            if tag in names:
                del self._open[i:]
                return True
            if tag in until:
                return False
        return False

    def _end(self, name: str) -> None:
        if name in BLOCK:
            self._break()
        self._close({name}, set() if name in BLOCK or name in CONTAINER else _CLOSED)
