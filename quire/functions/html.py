"""HTML to text and to ordered blocks, by the standard library's tolerant parser in Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements with a line of their own in plain text; of ordered blocks those with text and those that hold others.
LINE_TAGS = frozenset("p h1 h2 h3 li tr dt dd caption".split())
TEXT_BLOCKS = frozenset("h1 h2 p dt dd li caption th td img a".split())
CONTAINERS = frozenset("table thead tbody tr ol ul dl".split())
# Classes of lines that are no part of the text.
EDGE_CLASSES = ("running-head", "page-number")


class _Events(HTMLParser):
    """The markup as a list of (what, name or text, attributes, source)."""

    def __init__(self, decode: bool = True) -> None:
        super().__init__(convert_charrefs=decode)
        self.events: list[tuple[str, str, dict, str]] = []

    def handle_starttag(self, tag, attrs):
        self.events.append(("start", tag, dict(reversed(attrs)), self.get_starttag_text()))

    def handle_endtag(self, tag):
        self.events.append(("end", tag, {}, f"</{tag}>"))

    def handle_data(self, data):
        self.events.append(("text", data, {}, data))

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def events_of(html: str, decode: bool = True) -> list[tuple[str, str, dict, str]]:
    p = _Events(decode)
    p.feed(html)
    p.close()
    return p.events


def text_of(html: str | None) -> str | None:
    """Readable text: a line per block and per row, a space between cells, images as a line in brackets."""
    if html is None:
        return None
    out = []
    for what, name, attrs, _ in events_of(html):
        if what == "text":
            out.append(name)
        elif name in LINE_TAGS:
            out.append("\n")
        elif what == "start" and name == "img":
            alt = attrs.get("alt")
            out.append(f"\n[image: {alt}]\n" if alt else "\n[image]\n")
        elif what == "end" and name in ("td", "th"):
            out.append(" ")
    return "\n".join(line for x in "".join(out).split("\n") if (line := " ".join(x.split())))


def blocks_of(html: str | None, drop_empty: bool = True) -> list[dict]:
    """Ordered blocks: those with text (``text``), opening containers, images with their caption, and an end block (``/tag``) per closed tag.

    Links within a block stay in its text as tags. ``drop_empty`` leaves out text blocks without text; the order has no holes.
    """
    out: list[tuple[str, str]] = []
    tag, parts = None, []

    def flush() -> None:
        nonlocal tag, parts
        if tag is not None:
            out.append((tag, " ".join(" ".join(parts).split())))
        tag, parts = None, []

    for what, name, attrs, _ in events_of(html or ""):
        if what == "text":
            if tag is not None:
                parts.append(name)
        elif name == "a" and tag is not None:
            parts.append("</a>" if what == "end" else f'<a href="{attrs["href"]}">' if attrs.get("href") else "<a>")
        elif what == "start" and name == "img":
            out.append(("img", attrs.get("alt") or ""))
        elif what == "start" and name in CONTAINERS:
            out.append((name, ""))
        elif what == "start" and name in TEXT_BLOCKS:
            flush()
            tag = name
        elif what == "end" and name in TEXT_BLOCKS | CONTAINERS:
            if name == tag:
                flush()
            if not (name == "p" and tag is None and out and out[-1] == ("p", "")):
                out.append((f"/{name}", ""))
    flush()
    kept = [x for x in out if not drop_empty or x[1] or x[0][0] == "/" or x[0] == "img" or x[0] in CONTAINERS]
    return [{"block_type": t, "text": x, "order": i} for i, (t, x) in enumerate(kept, 1)]


def presented(html: str | None, section: str | None = None, images: bool = True) -> str | None:
    """Markup for reading: without running heads and page numbers by class, the heading that is only the section's number, and images where ``images`` is false."""
    if html is None:
        return None
    out: list[str] = []
    gone, heading = "", None  # the element being left out; where a second-level heading began
    for what, name, attrs, source in events_of(html, decode=False):
        if gone:
            gone = "" if what == "end" and name == gone else gone
            continue
        if what == "start" and set(EDGE_CLASSES) & set((attrs.get("class") or "").split()):
            gone = name
            continue
        if what == "start" and name == "img" and not images:
            continue
        if what == "start" and name == "h2":
            heading = len(out)
        out.append(source)
        if what == "end" and name == "h2" and heading is not None:
            if section and "".join(x for x in out[heading:] if x[:1] != "<").strip() == section:
                del out[heading:]
            heading = None
    return "".join(out)


def html_to_text(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(text_of)

    return run(c)


def parse_blocks(c: Column) -> Column:
    @F.pandas_udf("array<struct<block_type:string,text:string,order:int>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(blocks_of)

    return run(c)


# Elements that cleaned markup keeps.
KEPT_TAGS = frozenset("h1 h2 h3 p strong em ol ul li table thead tbody tr th td caption figure figcaption img dl dt dd a br".split())


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.broken = True  # something stood between two tables
        self.joined: list[bool] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self.joined.append(not self.broken)
            self.broken = False
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables:
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.tables[-1][-1].append("")
            self.cell = []
        elif tag in ("h1", "h2", "h3", "p", "ul", "ol", "img"):
            self.broken = True

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None and self.tables and self.tables[-1] and self.tables[-1][-1]:
            self.cell.append(data)
            self.tables[-1][-1][-1] = " ".join("".join(self.cell).split())
        elif data.strip():
            self.broken = True


def tables_of(html: str | None, merge: bool = True) -> list[list[list[str]]]:
    """Tables as rows of cells. With ``merge`` a table that follows another with nothing between and equal width goes on with it; a repeated head row is left out."""
    if not html or "<t" not in html:
        return []
    p = _Tables()
    p.feed(html)
    p.close()
    out: list[list[list[str]]] = []
    for rows, goes_on in zip(p.tables, p.joined, strict=True):
        rows = [r for r in rows if r]
        if merge and goes_on and out and rows and out[-1] and len(rows[0]) == len(out[-1][0]):
            out[-1] += rows[1:] if rows[0] == out[-1][0] else rows
        else:
            out.append(rows)
    return out


def continued_rows(rows: list[list[str]]) -> list[list[str]]:
    """Rows whose first cell is empty go on with the row before, cell by cell."""
    out: list[list[str]] = []
    for r in rows:
        if out and r and not r[0] and any(r) and len(r) <= len(out[-1]):
            out[-1] = [" ".join(x for x in (a, b) if x) for a, b in zip(out[-1], [*r, *[""] * (len(out[-1]) - len(r))])]
        else:
            out.append(list(r))
    return out


def cleaned(html: str | None) -> str | None:
    """Markup with kept elements only: links stay where they point into the page, images keep caption and count, paragraphs the
    classes of running heads and page numbers; scripts and styles go with their content. Entities stay as they are written."""
    if html is None:
        return None
    out: list[str] = []
    silent = 0
    for what, name, attrs, source in events_of(html, decode=False):
        if name in ("script", "style") and what != "text":
            silent = silent + 1 if what == "start" else max(0, silent - 1)
        elif silent:
            continue
        elif what == "text":
            out.append(source)
        elif name in KEPT_TAGS and not (what == "end" and name in ("img", "br")):
            if what == "end":
                out.append(source)
                continue
            kept = {}
            if name == "a" and (attrs.get("href") or "").startswith("#"):
                kept = {"href": attrs["href"]}
            elif name == "img":
                kept = {"alt": attrs.get("alt") or ""} | ({"data-count": attrs["data-count"]} if attrs.get("data-count") else {})
            elif name == "p" and attrs.get("class") in EDGE_CLASSES:
                kept = {"class": attrs["class"]}
            out.append(f"<{name}{''.join(f' {k}={chr(34)}{v}{chr(34)}' for k, v in kept.items())}>")
    return re.sub(r">\s+<", ">\n<", re.sub(r"\s+", " ", "".join(out))).strip()


def parse_tables(c: Column) -> Column:
    @F.pandas_udf("array<array<array<string>>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda h: [continued_rows(t) for t in tables_of(h)])

    return run(c)


def sanitize(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(cleaned)

    return run(c)


def present(html: Column, section: Column) -> Column:
    @F.pandas_udf("string")
    def run(h: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([presented(x, y) for x, y in zip(h, n, strict=True)], dtype=object)

    return run(html, section)
