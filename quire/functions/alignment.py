"""Comparison and voting of readings, tables and boxes of one page. Plain functions for use in Arrow batches; inputs are bounded by a page."""

from __future__ import annotations

import bisect
import difflib
from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def likeness(a: str, b: str) -> float:
    """Sequence ratio without the junk rule; 1 for two empty texts."""
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def disagreement(readings: Sequence[str]) -> float:
    """Mean unlikeness over all pairs of whole readings, by the sequence ratio with its junk rule as in the reference; 0 with fewer than two."""
    pairs = list(combinations(readings, 2))
    return round(sum(1 - difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs) / len(pairs), 4) if pairs else 0.0


def outlier(readings: dict[str, str], least: float = 0.6) -> str | None:
    """The reading that is far from the others, unless it belongs to the closest pair; needs three."""
    if len(readings) < 3:
        return None
    far = {(a, b): 1 - likeness(readings[a], readings[b]) for a, b in combinations(sorted(readings), 2)}
    best = min(far, key=far.get)
    mean = {k: sum(v for p, v in far.items() if k in p) / (len(readings) - 1) for k in readings}
    worst = max(sorted(mean), key=mean.get)
    return worst if mean[worst] > least and worst not in best else None


def vote_lines(primary: Sequence[str], other: Sequence[str], drop: float = 0.35) -> list[str]:
    """Lines of two readings aligned; in a replaced stretch the longer line wins if both are alike enough, else the primary's."""
    out: list[str] = []
    for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, primary, other, autojunk=False).get_opcodes():
        if tag in ("equal", "delete"):
            out += primary[i1:i2]
        elif tag == "insert":
            out += other[j1:j2]
        else:
            a, b = primary[i1:i2], other[j1:j2]
            for k in range(max(len(a), len(b))):
                x, y = a[k] if k < len(a) else "", b[k] if k < len(b) else ""
                out.append(y if not x or (y and len(y.strip()) > len(x.strip()) and 1 - likeness(x, y) <= drop) else x)
    return out


def fuse(a: str, b: str, known: frozenset[str]) -> str:
    """Words of two like readings of a line: a known word beats an unknown one, else the first stays."""
    x, y = a.split(), b.split()
    if len(x) != len(y):
        return a
    bare = lambda w: w.strip(".,;:!?\"'").lower()
    return " ".join(v if bare(u) not in known and bare(v) in known else u for u, v in zip(x, y))


# What a cell counts that equals its partner or contains it, and a row whose width is off by more than so many cells.
SAME_CELL, PART_CELL = 1.0, 0.5
WIDTH_SLACK, OTHER_WIDTH = 2, 0.1


def row_likeness(a: Sequence[str], b: Sequence[str]) -> float:
    """Mean likeness of the cells of two rows, place by place."""
    longer, shorter = max(len(a), len(b)), min(len(a), len(b))
    if longer - shorter > WIDTH_SLACK:
        return OTHER_WIDTH
    same = [a[i] == b[i] for i in range(shorter)]
    part = [not s and bool(a[i] and b[i]) and (a[i] in b[i] or b[i] in a[i]) for i, s in enumerate(same)]
    return (SAME_CELL * sum(same) + PART_CELL * sum(part)) / max(longer, 1)


def aligned_rows(golden: Sequence[Sequence[str]], output: Sequence[Sequence[str]], least: float = 0.5) -> list[tuple[int, int]]:
    """A longest list of like rows in the order of both tables: the longest chain that rises on both sides, among all like pairs."""
    tails: list[int] = []  # for each length, the least output row that a chain of it ends in
    ends: list[tuple[int, int, int]] = []  # for each length, (golden, output, index in links of the pair before)
    links: list[tuple[int, int, int]] = []
    for i, g in enumerate(golden):
        for j in reversed([j for j, o in enumerate(output) if row_likeness(g, o) >= least]):
            n = bisect.bisect_left(tails, j)
            links.append((i, j, ends[n - 1][2] if n else -1))
            entry = (i, j, len(links) - 1)
            if n == len(tails):
                tails.append(j), ends.append(entry)
            else:
                tails[n], ends[n] = j, entry
    chain, at = [], ends[-1][2] if ends else -1
    while at >= 0:
        i, j, at = links[at]
        chain.append((i, j))
    return chain[::-1]


def table_alignment(golden: Sequence[Sequence[str]], output: Sequence[Sequence[str]], least: float = 0.5) -> float:
    """Share of golden rows that the longest common alignment finds; without golden rows 1 if there is no output either."""
    return round(len(aligned_rows(golden, output, least)) / len(golden), 4) if golden else float(not output)


def signature(table: Sequence[Sequence[str]], heads: int = 0) -> str:
    """All cells of a table after its ``heads`` head rows, white space in one form."""
    return " ".join(x for row in table[heads:] for c in row if (x := " ".join(c.split()).lower()))


def match_tables(golden: Sequence[Sequence[Sequence[str]]], output: Sequence[Sequence[Sequence[str]]], least: float = 0.25) -> list[tuple[int, int]]:
    """Pairs of tables: each golden one in turn takes the free output table whose cells are likest, if above ``least``; empty tables match nothing."""
    free = {j: x for j, o in enumerate(output) if (x := signature(o))}
    out = []
    for i, g in enumerate(golden):
        want = signature(g)
        ranked = [(difflib.SequenceMatcher(None, want, x).ratio(), -j) for j, x in free.items()] if want else []
        if ranked and max(ranked)[0] > least:
            out.append((i, -max(ranked)[1]))
            del free[out[-1][1]]
    return out


def cell_score(golden: Sequence[Sequence[str]], output: Sequence[Sequence[str]]) -> float:
    """Mean likeness of the cells at the same place."""
    cells = [(x, output[i][j] if i < len(output) and j < len(output[i]) else "") for i, row in enumerate(golden) for j, x in enumerate(row)]
    return round(sum(likeness(a, b) for a, b in cells) / len(cells), 4) if cells else 1.0


def row_count_score(golden: int, output: int) -> float:
    return max(0.0, round(1 - abs(golden - output) / golden, 4)) if golden else float(output == 0)


def column_score(golden: Sequence[int], output: Sequence[int]) -> float:
    """Most frequent column counts compared: equal 1, off by one a half."""
    mode = lambda v: max(sorted(set(v)), key=list(v).count) if v else 0
    d = abs(mode(golden) - mode(output))
    return 1.0 if d == 0 else 0.5 if d == 1 else 0.0


def iou(a: Sequence[float], b: Sequence[float]) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(0.0, w) * max(0.0, h)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / union if union > 0 else 0.0


def match_boxes(predicted: Sequence[Sequence[float]], golden: Sequence[Sequence[float]], least: float = 0.0) -> list[tuple[int, int, float]]:
    """Greedy one-to-one pairs by falling overlap."""
    ranked = sorted(((-iou(p, g), i, j) for i, p in enumerate(predicted) for j, g in enumerate(golden)))
    used_p, used_g, out = set(), set(), []
    for s, i, j in ranked:
        if -s > least and i not in used_p and j not in used_g:
            used_p.add(i), used_g.add(j), out.append((i, j, round(-s, 6)))
    return out


def inner_boxes(boxes: Sequence[Sequence[float]], cover: float = 0.9, larger: float = 1.5) -> list[int]:
    """Boxes without those that contain a smaller kept one; smallest first."""
    area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
    kept: list[int] = []
    for i in sorted(range(len(boxes)), key=lambda i: (area(boxes[i]), i)):
        b = boxes[i]
        holds = any(
            area(boxes[k]) > 0
            and max(0.0, min(b[2], boxes[k][2]) - max(b[0], boxes[k][0])) * max(0.0, min(b[3], boxes[k][3]) - max(b[1], boxes[k][1])) >= cover * area(boxes[k])
            and area(b) >= larger * area(boxes[k])
            for k in kept
        )
        if not holds:
            kept.append(i)
    return sorted(kept)


# Fixed value: what a pair on the diagonal gains.
SAME_PLACE = 0.05


def best_assignment(score: Sequence[Sequence[float]]) -> list[int]:
    """Column of each row in the one-to-one assignment of highest total score, -1 for none; exact at any size.

    Shortest augmenting paths over reduced costs: each row in turn is led to a free column at least cost, moving
    rows that stand in the way. Every row has a column of its own for "none".
    """
    n, m = len(score), len(score[0]) if score else 0
    if not n:
        return []
    gain = np.zeros((n, m + n))
    gain[:, :m] = score
    places = np.arange(min(n, m))
    gain[places, places] += SAME_PLACE
    cost = gain.max() - gain
    row_price, column_price = np.zeros(n), np.zeros(m + n)
    holder, held = np.full(m + n, -1), np.full(n, -1)
    for row in range(n):
        way = cost[row] - row_price[row] - column_price
        via, reached = np.full(m + n, row), np.zeros(m + n, dtype=bool)
        while True:
            column = int(np.argmin(np.where(reached, np.inf, way)))
            if holder[column] < 0:
                break
            reached[column] = True
            moved = holder[column]
            onward = way[column] + cost[moved] - row_price[moved] - column_price
            shorter = ~reached & (onward < way)
            way[shorter], via[shorter] = onward[shorter], moved
        slack = way[column] - way[reached]
        column_price[reached] -= slack
        row_price[holder[reached]] += slack
        row_price[row] += way[column]
        while True:
            taker = via[column]
            holder[column], held[taker], column = taker, column, held[taker]
            if taker == row:
                break
    return [int(c) if c < m else -1 for c in held]


def retention(old: str, new: str, least_recall: float = 0.9, least_length: float = 0.8) -> tuple[bool, float]:
    """Whether a rewritten text keeps the old one: share of its tokens that the new one has at all, and its length where the old text is long."""
    tokens, there = old.lower().split(), set(new.lower().split())
    recall = round(sum(t in there for t in tokens) / len(tokens), 4) if tokens else 1.0
    return recall >= least_recall and (len(old) < 120 or len(new) >= least_length * len(old)), recall


def similarity(a: str, b: str, least: float = 0.0) -> float:
    """The higher of token overlap and sequence ratio; the ratio is worked out only where its bounds reach ``least`` and the overlap."""
    x, y = set(a.lower().split()), set(b.lower().split())
    share = len(x & y) / len(x | y) if x or y else 1.0
    bound = max(share, least)
    if share == 1 or 2 * min(len(a), len(b)) < bound * (len(a) + len(b)):
        return share
    m = difflib.SequenceMatcher(None, a, b)
    return share if m.quick_ratio() < bound else max(share, m.ratio())


def matched_captions(golden: Sequence[str], output: Sequence[str], least: float = 0.25) -> int:
    """How many captions find, in turn, a free one that shares enough of their words; captions without words match each other."""
    words = lambda s: frozenset("".join(c for c in s.lower() if c.isalnum() or c in "_ \t\n").split())
    free = [words(o) for o in output]
    hits = 0
    for want in map(words, golden):
        alike = (i for i, have in enumerate(free) if (len(want & have) >= least * len(want | have) if want and have else not want and not have))
        if (i := next(alike, None)) is not None:
            del free[i]
            hits += 1
    return hits


def similarity_column(a: Column, b: Column, least: float) -> Column:
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([round(similarity(u, v, least), 4) for u, v in zip(x, y, strict=True)])

    return run(a, b)


def disagreement_column(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([disagreement([u or "", v or ""]) for u, v in zip(x, y, strict=True)])

    return run(a, b)
