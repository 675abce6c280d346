"""Order-dependent keep-or-drop scans, one entity per group.

These are defined by a scan over an entity's rows in order (what is kept decides what
comes next), so an entity is one group; entities are books or pages, whose own size is
bounded by what a book or page can hold. Rows outside the entity never meet.
"""

from __future__ import annotations

import bisect
from collections import deque
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.alignment import similarity


def greedy_intervals(df: DataFrame, group: str, key: str, start: str, end: str, score: str) -> DataFrame:
    """Best-first intervals without overlap: by score, then length, then start; rows without bounds are skipped. Binary search keeps each group at n log n."""
    slim = df.select(group, key, F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e"), F.col(score).cast("double").alias("c")).dropna(subset=["s", "e"])

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.assign(n=f["s"] - f["e"]).sort_values(["c", "n", "s", key], ascending=[False, True, True, True])
        starts: list[int] = []
        ends: list[int] = []
        keep = []
        for s, e in zip(f["s"], f["e"], strict=True):
            i = bisect.bisect_right(starts, e)
            ok = e >= s and (i == 0 or ends[i - 1] < s)
            keep.append(ok)
            if ok:
                starts.insert(i, s)
                ends.insert(i, e)
        return f[np.array(keep, dtype=bool)].drop(columns="n")

    return slim.groupBy(group).applyInPandas(run, slim.schema).select(group, key, F.col("s").alias(start), F.col("e").alias(end))


def sequential_scan(df: DataFrame, group: str, key: str, page: str, number: str, jump: int = 10, pages: int = 3) -> DataFrame:
    """Numbers that rise over the pages of a group, by page and number.

    A higher number is kept if it comes on a later page or within ``jump`` of the last kept one. A number not above
    the last kept one takes its place if it is at most ``jump`` below and at most ``pages`` later; a number kept
    already is passed over.
    """
    slim = df.select(group, key, F.col(page).cast("long").alias("p"), F.col(number).cast("long").alias("n")).dropna(subset=["p", "n"])

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["p", "n", key])
        kept: list[int] = []
        held: set[int] = set()
        at_page = at_number = 0
        for i, (p, n) in enumerate(zip(f["p"].to_list(), f["n"].to_list(), strict=True)):
            rises, later = n - at_number, p - at_page
            goes_on = rises > 0 and (later > 0 or rises <= jump)
            replaces = rises <= 0 and bool(kept) and -rises <= jump and 0 <= later <= pages
            if n in held or not (goes_on or replaces):
                continue
            if replaces:
                held.discard(at_number)
                kept.pop()
            kept.append(i)
            held.add(n)
            at_page, at_number = p, n
        return f.iloc[kept]

    return slim.groupBy(group).applyInPandas(run, slim.schema).select(group, key, F.col("p").alias(page), F.col("n").alias(number))


def repeated_pages(df: DataFrame, group: str, key: str, order: str, text: str, look_back: int = 3, threshold: float = 0.9, min_tokens: int = 5) -> DataFrame:
    """Pages that repeat one of the last kept pages: ``of`` and ``similarity``. A dropped page is never compared with again."""
    slim = df.select(group, key, order, text).where(F.col(text).isNotNull())

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values([order, key])
        kept: deque = deque(maxlen=look_back)
        rows = []
        for k, t in zip(f[key], f[text], strict=True):
            if len(set(t.lower().split())) < min_tokens:
                continue
            best = max(((similarity(t, u, threshold), ku) for ku, u in kept), default=(0.0, None))
            if best[0] >= threshold:
                rows.append((f[group].iloc[0], k, best[1], round(best[0], 4)))
            else:
                kept.append((k, t))
        return pd.DataFrame(rows, columns=[group, key, "of", "similarity"])

    kinds = {c: t for c, t in slim.dtypes}
    return slim.groupBy(group).applyInPandas(run, f"{group} {kinds[group]}, {key} {kinds[key]}, of {kinds[key]}, similarity double")


def columns_of(df: DataFrame, group: Sequence[str], key: str, x: str, rounds: int = 5, least: int = 4, spread: float = 0.2, gap: float = 0.12) -> DataFrame:
    """Two text columns: by 2-means on x where the lines spread far enough, or else at the widest gap; each side needs ``least`` lines, else there is one column."""
    slim = df.select(*group, key, F.col(x).cast("double").alias("x")).dropna(subset=["x"])

    def run(f: pd.DataFrame) -> pd.DataFrame:
        v = f["x"].to_numpy()
        enough = lambda right: least <= right.sum() <= len(right) - least
        side = np.zeros(len(v), dtype=bool)
        if np.ptp(v) > spread:
            centres = np.array([v.min(), v.max()])
            nearer_right = lambda: np.abs(v - centres[1]) < np.abs(v - centres[0])
            for _ in range(rounds):
                right = nearer_right()
                centres = np.array([v[~right].mean() if not right.all() else centres[0], v[right].mean() if right.any() else centres[1]])
            side = nearer_right()
        if not enough(side):
            edges = np.sort(v)
            steps = np.diff(edges)
            side = v >= edges[steps.argmax() + 1] if len(steps) and steps.max() >= gap else np.zeros(len(v), dtype=bool)
        return f.drop(columns="x").assign(column=(side & enough(side)).astype("int32"))

    fields = ", ".join(f"{c} {t}" for c, t in slim.dtypes if c != "x")
    return slim.groupBy(*group).applyInPandas(run, f"{fields}, column int")


def distinct_boxes(df: DataFrame, group: str, key: str, threshold: float = 0.95, centre: float = 10.0, size: float = 0.02) -> DataFrame:
    """Boxes (x0, y0, x1, y1) of a page without near-equal ones; the first by key stays. Near-equal are boxes that overlap by
    ``threshold``, or whose centres are at most ``centre`` apart each way and whose sides (one at least) differ by at most the share ``size``."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(key)
        boxes = f[["x0", "y0", "x1", "y1"]].to_numpy()
        middles = (boxes[:, :2] + boxes[:, 2:]) / 2
        sides = boxes[:, 2:] - boxes[:, :2]
        wide = np.maximum(sides, 1)
        kept: list[int] = []
        for i in range(len(boxes)):
            k = np.array(kept, dtype=int)
            meet = np.clip(np.minimum(boxes[k, 2:], boxes[i, 2:]) - np.maximum(boxes[k, :2], boxes[i, :2]), 0, None).prod(axis=1)
            union = sides[k].prod(axis=1) + sides[i].prod() - meet
            over = (union > 0) & (meet >= threshold * union)
            close = (np.abs(middles[k] - middles[i]) <= centre).all(axis=1)
            alike = (np.abs(wide[k] - wide[i]) <= size * np.maximum(wide[k], wide[i])).all(axis=1)
            if not (over | (close & alike)).any():
                kept.append(i)
        return f.iloc[kept]

    slim = df.select(group, key, *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])
    return slim.groupBy(group).applyInPandas(run, slim.schema).select(group, key)


def select_boxes(df: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """The ``most`` largest boxes (x0, y0, x1, y1) of a page that do not overlap, in order of size; ``rank`` from 1. A group is one page."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.assign(area=(f["x1"] - f["x0"]) * (f["y1"] - f["y0"])).sort_values(["area", key], ascending=[False, True])
        boxes = f[["x0", "y0", "x1", "y1"]].to_numpy()
        kept: list[int] = []
        for i, b in enumerate(boxes):
            if len(kept) == most:
                break
            k = boxes[kept]
            apart = (k[:, 2] <= b[0]) | (b[2] <= k[:, 0]) | (k[:, 3] <= b[1]) | (b[3] <= k[:, 1])
            if apart.all():
                kept.append(i)
        return f.iloc[kept][[group, key]].assign(rank=np.arange(1, len(kept) + 1, dtype="int32"))

    slim = df.select(group, key, *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")]).dropna()
    kinds = dict(slim.dtypes)
    return slim.groupBy(group).applyInPandas(run, f"{group} {kinds[group]}, {key} {kinds[key]}, rank int")
