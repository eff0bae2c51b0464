"""Tokens of HTML source, in one pass whatever the source is like."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: fixed values: elements whose content is no markup, up to their end tag
RAW = frozenset("script style textarea title iframe noembed noframes".split())
TEXT, START, END = 0, 1, 2
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
# Up to the end of a tag.  A quote begins a value only behind an equals sign,
# and only if it is closed; nothing is tried twice.
_TAIL = re.compile(r"""(?>[^>=]*+(?:=\s*+(?>"[^"]*+"|'[^']*+')?+[^>=]*+)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")


def tokens(html: str) -> Iterator[tuple[int, str, str, int, int]]:
    """(kind, tag, text, start, stop): text, start tags with the source of
    their attributes, end tags.  Comments and declarations are left out.  A
    raw element's content is one text.  Where a tag does not end (a quote left
    open), tags end at their first ``>`` from there on; without any, the rest
    is text."""
    pos, end = 0, len(html)
    last = html.rfind(">")
    plain = False
    while pos < end:
        at = html.find("<", pos)
        if at != pos:
            at = end if at < 0 else at
            yield TEXT, "", html[pos:at], pos, at
            pos = at
            continue
        if html.startswith("<!--", pos):
            close = html.find("-->", pos + 2)
            pos = end if close < 0 else max(close + 3, pos + 4)
            continue
        m = _OPEN.match(html, pos)
        if pos > last or not (m or html[pos + 1 : pos + 2] in ("!", "?", "/")):
            stop = html.find("<", pos + 1)
            stop = end if stop < 0 else stop
            yield TEXT, "", html[pos:stop], pos, stop
            pos = stop
            continue
        if m is None:
            pos = html.find(">", pos) + 1
            continue
        tail = None if plain else _TAIL.match(html, m.end())
        if tail is None:
            plain = True
        stop = tail.end() if tail else html.find(">", m.end()) + 1
        tag = m[2].lower()
        yield END if m[1] else START, tag, html[m.end() : stop - 1], pos, stop
        pos = stop
        if not m[1] and tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, pos)
            inner = close.start() if close else end
            yield TEXT, tag, html[pos:inner], pos, inner
            pos = inner


def attributes(source: str) -> dict[str, str]:
    """Names in lower case; of repeated names the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1:
            value = value[1:-1]
        found.setdefault(name.lower(), value)
    return found
