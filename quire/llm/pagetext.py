"""Readable text of page HTML as block units, tolerant of unclosed tags and missing classes."""

from __future__ import annotations

import html as _html
import re
from typing import NamedTuple

TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>|<!--.*?-->|<[!?][^>]*>", re.S)
# Tags that end a line of text, and those whose content is not readable.
BLOCKS = frozenset("p div section article main header footer nav aside h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr blockquote pre figure figcaption hr body html form address".split())
LISTS = {"ul": "li", "ol": "li", "table": "tr", "dl": "dl"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SILENT = re.compile(r"<(script|style|head|title)\b[^>]*>.*?</\1\s*>", re.S | re.I)


class Unit(NamedTuple):
    """One block: ``kind`` is p, b (wholly bold), h, li, tr, dl, header or footer; ``text`` has its lines; ``group`` counts the enclosing lists and tables."""

    kind: str
    text: str
    group: int


def units(source: str | None) -> list[Unit]:
    """Blocks in reading order; line breaks in the source and ``<br>`` end lines; entities are decoded."""
    if not source:
        return []
    if "<script" in source or "<style" in source or "<head" in source or "<title" in source:
        source = SILENT.sub("", source)
    out: list[Unit] = []
    parts: list[str] = []
    kind, zone, group, inside, bold = "p", "", 0, 0, 0
    # Text, then a slash, a name, attributes and the text behind for each tag.
    pieces = TAG.split(source)
    if pieces[0]:
        parts.append(pieces[0])
    for slash, name, attributes, behind in zip(pieces[1::4], pieces[2::4], pieces[3::4], pieces[4::4]):
        if name is not None:
            name = name.lower()
            if name in BLOCKS and name != "dt" and name != "dd":
                end = bool(slash)
                if parts:
                    if (u := _unit(parts, kind, zone, group if inside else 0, bold)) is not None:
                        out.append(u)
                    parts, bold = [], 0
                if name in LISTS:
                    inside = 0 if end else 1
                    group += not end
                    kind = "p" if end else LISTS[name]
                elif name == "header" or name == "footer":
                    zone = "" if end else name
                elif name == "li" or name == "tr":
                    kind = "p" if end and not inside else name
                elif name in HEADINGS:
                    kind = "p" if end else "h"
                elif not inside:
                    kind = "p"
                    zone = zone if zone == "header" or zone == "footer" else ""
                    if not end and "class" in attributes:
                        c = attributes.lower()
                        if "running-head" in c or "page-header" in c or "pagehead" in c:
                            zone = "header!"
                        elif "page-number" in c or "page-footer" in c or "pagenum" in c or "pageno" in c:
                            zone = "footer!"
                if end and zone and zone[-1] == "!":
                    zone = ""
            elif name == "br":
                # A break at the source's own line end is one break.
                if behind[:1] != "\n":
                    parts.append("\n")
            elif name == "b" or name == "strong":
                if slash and parts:
                    bold += len(parts[-1].strip())
            elif name == "td" or name == "th":
                if not slash and parts and not parts[-1].endswith(" | "):
                    parts.append(" | ")
            elif name == "dt" or name == "dd":
                if not slash and parts:
                    parts.append("   ")
        if behind:
            parts.append(behind)
    if parts and (u := _unit(parts, kind, zone, group if inside else 0, bold)) is not None:
        out.append(u)
    return out


def _unit(parts: list[str], kind: str, zone: str, group: int, bold: int) -> Unit | None:
    """The block of some pieces of text, ``bold`` of its characters in bold; none if it is empty."""
    text = parts[0] if len(parts) == 1 else "".join(parts)
    whole = 0 < bold >= len(text.strip()) and kind == "p" and not zone
    if "&" in text:
        text = _html.unescape(text)
    text = text.strip()
    return Unit(zone.rstrip("!") or ("b" if whole else kind), text, group) if text else None


def blocks(source: str | None) -> list[tuple[str, str]]:
    """(kind, text) with the rows of one list or table joined to one block; list rows get a bullet."""
    out: list[tuple[str, str]] = []
    last = 0
    for u in units(source):
        text = ("- " + u.text) if u.kind == "li" and not re.match(r"[-*•–o]\s|\(?\w{1,3}[.)]\s", u.text) else u.text
        if u.group and u.group == last:
            out[-1] = (out[-1][0], out[-1][1] + "\n" + text)
        else:
            out.append((u.kind, text))
        last = u.group
    return out
