"""Several readings of one page: the best one, their quality, and one text voted from all."""

from __future__ import annotations

import difflib
from collections.abc import Iterator, Sequence
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import alignment as al
from quire.functions import scan as fs


def spelled(readings: DataFrame, known: DataFrame, word: str) -> DataFrame:
    """``readings`` (with ``lines``) and their ``spell``. ``known`` is a word list of fixed size: one row is broadcast."""
    words = known.agg(F.collect_set(F.lower(word)).alias("__known"))
    return fs.spell_columns(readings.crossJoin(F.broadcast(words)), F.array_join(F.col("lines"), "\n"), "__known", "spell").drop("__known")


def engine_quality(spelled_readings: DataFrame, least_words: int = 10) -> DataFrame:
    """Adds ``eligible`` and ``quality`` (1 less the worse of both spelling scores); readings with few words have no quality."""
    eligible = F.col("spell.words") >= least_words
    worst = F.greatest("spell.dictionary", "spell.confusion")
    return spelled_readings.withColumn("eligible", eligible).withColumn("quality", F.when(eligible, F.round(1 - worst, 4)))


def best_engine(spelled_readings: DataFrame, keys: Sequence[str], preference: str, least_chars: int = 40) -> DataFrame:
    """The reading with the lowest score among those of some length; on ties the preferred one. Keys, ``engine``, ``score``."""
    long = spelled_readings.where(F.length(F.trim(F.array_join("lines", ""))) >= least_chars)
    scored = long.select(*keys, "engine", preference, fs.engine_score(F.col("lines"), F.col("spell")).alias("score"))
    best = scored.groupBy(*keys).agg(F.min_by(F.struct("engine", "score"), F.struct("score", preference)).alias("r"))
    return best.select(*keys, "r.engine", "r.score")


def aligned(spine: list[dict[str, str]], texts: list[str], engine: str, lines: Sequence[str]) -> tuple[list[dict[str, str]], list[str]]:
    """A further reading laid against the rows of those before: equal and replaced stretches pair up in order, other lines become rows of their own."""
    rows, out = [], []
    for tag, i, i2, j, j2 in difflib.SequenceMatcher(None, texts, list(lines), autojunk=False).get_opcodes():
        for k in range(max(i2 - i, j2 - j)):
            row = dict(spine[i + k]) if i + k < i2 else {}
            if j + k < j2 and tag != "delete":
                row[engine] = lines[j + k]
            rows.append(row)
            out.append(texts[i + k] if i + k < i2 else lines[j + k])
    return rows, out


def voted_line(row: dict[str, str], quality: dict[str, float], known: frozenset[str], drop: float = 0.35, near: float = 0.15) -> tuple[str, str, float]:
    """(text, source, distance) of one row: a form that two readings share, else words fused from the likest pair if it is near, else the
    reading of the best quality, or the longest line where none has any."""
    held = {e: t for e, t in sorted(row.items()) if t.strip()}
    if len(held) < 2:
        return (*next(((t, e) for e, t in held.items()), ("", "none")), 0.0)
    pairs = [(al.likeness(held[a], held[b]), a, b) for a, b in combinations(held, 2)]
    like, first, second = max(pairs, key=lambda x: x[0])
    distance = round(1 - like, 4)
    forms: dict[str, list[str]] = {}
    for e, t in held.items():
        forms.setdefault(" ".join(t.split()), []).append(e)
    rank = lambda e: (quality.get(e, -1.0), len(held[e].strip()))
    most = max(forms.values(), key=len)
    if len(most) > 1:
        e = max(most, key=rank)
        return held[e], e, distance
    if distance <= near and not (len(held) > 2 and quality):
        return al.fuse(held[first], held[second], known), "fused", distance
    e = max(held, key=rank)
    return held[e], e, distance


def voted(readings: dict[str, Sequence[str]], quality: dict[str, float] | None = None, known: frozenset[str] = frozenset()) -> list[tuple[str, str, float]]:
    """Lines voted from all readings of a page; the longest reading is the spine that the others are aligned to, by name."""
    full = {e: list(x) for e, x in readings.items() if any(t.strip() for t in x)}
    if len(full) < 2:
        return [(t, e, 0.0) for e, x in full.items() for t in x]
    base = max(sorted(full), key=lambda e: sum(len(t.strip()) for t in full[e]))
    rows, texts = [{base: t} for t in full[base]], list(full[base])
    for e in sorted(set(full) - {base}):
        rows, texts = aligned(rows, texts, e, full[e])
    return [x for r in rows if (x := voted_line(r, quality or {}, known))[1] != "none"]


def voted_pages(readings: DataFrame, keys: Sequence[str], known: frozenset[str]) -> DataFrame:
    """keys, ``place``, ``text``, ``source``, ``distance``: every page voted from its readings (``engine``, ``lines``, ``quality``). A group is the readings of one page."""
    per = readings.groupBy(*keys).agg(F.collect_list(F.struct("engine", "lines", "quality")).alias("r"))
    kinds = dict(per.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, rows = [], []
            for i, found in enumerate(b.column(len(keys)).to_pylist()):
                lines = voted({r["engine"]: [x or "" for x in r["lines"] or ()] for r in found}, {r["engine"]: r["quality"] for r in found if r["quality"] is not None}, known)
                index += [i] * len(lines)
                rows += [(n, *x) for n, x in enumerate(lines)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            take = pa.array(index, pa.int64())
            made = [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.string(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(i).take(take) for i in range(len(keys))], *made], names=[*keys, "place", "text", "source", "distance"])

    return per.select(*keys, "r").mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", place int, text string, source string, distance double")
