"""Per-document text statistics and text types by labelling functions and EM.

Statistics (words, mean word length, symbols, digits, line ends, common words and so
on) are thresholded into labelling functions that vote for prose, list, table or junk,
or abstain. No function is trusted: their accuracies and the class shares are learnt
by expectation-maximization from how their votes agree over the whole corpus, without
labels, and every text gets its posterior over the types. The votes of a text form a
short pattern; EM runs on pattern counts, whose number is bounded by the vote
alphabet, not by the corpus.

Defined results: null or empty text and a bare number have no type; a page's blocks are judged one by
one and its type is that of most of its characters, running heads and page numbers
aside; delivered copies count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import lookalike, pagetext
from quire.session import cut

CLASSES = ("prose", "list", "table", "junk")
CODES = "pltj"
MIN_CHARS = 60

MARKER = re.compile(r"^\s*(?:[-*•–‣◦▪]|o(?= )|\(?[0-9ivxlc]{1,4}[.)]|\(?[a-z][.)])\s+\S", re.M)
LEADER = re.compile(r"(?:\.{3,}|(?:\. ){3,}|…{1,})\s*[0-9ivxlc]+\s*$", re.M)
LOCATORS = re.compile(r"(?:\s{2,}|,\s)\d+(?:[-–]\d+)?(?:,\s*\d+(?:[-–]\d+)?)*\s*$", re.M)
CELLS = re.compile(r"^[^\n]*?\S(?:\t+| *\| *| *; *| {2,})[^\n]*?(?:\t+| *\| *| *; *| {2,})[^\n]*$", re.M)
STATS = re.compile(r"\b[A-Z]{2,}:? *\d+\s+[A-Z]{2,}:? *\d+")  # score lines of a fight, no table
CLOSED = re.compile(r"[.!?:;,\"”»)…-]\s*$", re.M)
VOWELS = frozenset("aeiouyàáâãäåæèéêëìíîïòóôõöøœùúûüýÿаеиоуыэюяєіїαεηιουω")
ONE_MARKER = re.compile(MARKER.pattern)
SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"’‘“”()«»¿¡–—-]|_")


#: Deletes from ASCII text all that SYMBOLS does not count.
NO_SYMBOL = {c: None for c in range(128) if not SYMBOLS.match(chr(c))}
CLOSERS = ".!?:;,\"”»)…-"


class Stats(NamedTuple):
    """Statistics of one text."""

    chars: int
    words: int
    mean_word_length: float
    lines: int
    symbol_ratio: float
    digit_ratio: float
    closed_lines: float
    common_share: float
    distinct_share: float
    odd_words: float
    marker_lines: float
    index_lines: float
    cell_lines: float
    score_lines: int


def is_odd(word: str) -> bool:
    """A word that no language would write: digits inside, no vowel, or a case jumble."""
    core = word.strip(".,;:!?'\"()[]{}_-")
    if not core:
        return len(word) > 2
    if core.isalpha():
        if len(core) == 1:
            return False
        low = core.lower()
        return VOWELS.isdisjoint(low) or (not core.isupper() and not core[1:].islower()) or len(core) > 24
    if core.isdigit():
        return False
    return not all(p.isalpha() for p in re.split(r"[-'’/]", core) if p)


class Words(dict):
    """Memo of word kinds in a worker: 1 common, 2 odd, 0 neither. Emptied when large: a bound on memory, not on the data."""

    def __init__(self, common: frozenset[str]):
        super().__init__()
        self.common = common

    def __missing__(self, word: str) -> int:
        low = word.lower()
        kind = 1 if low in self.common or low.strip(".,;:!?'\"()¿¡«»") in self.common else 2 if is_odd(word) else 0
        if len(self) > 300_000:
            self.clear()
        self[word] = kind
        return kind


def stats(text: str, kinds: Words) -> Stats:
    """All statistics of a non-empty text. The line patterns run only where their signs occur at all."""
    chars = len(text)
    words = text.split()
    n = max(1, len(words))
    lines = text.count("\n") + 1
    marks = [kinds[w] for w in words]
    digits = sum(map(text.count, "0123456789"))
    gaps = "  " in text or "|" in text or ";" in text or "\t" in text
    scores = len(STATS.findall(text)) if digits and gaps else 0
    leaders = len(LEADER.findall(text)) if ".." in text or "…" in text or ". ." in text else 0
    locators = len(LOCATORS.findall(text)) if digits and (lines > 1 or text[-1:].isdigit()) else 0
    if lines == 1:
        closed = text[-1:] in CLOSERS
        markers = ONE_MARKER.match(text) is not None
    else:
        closed = len(CLOSED.findall(text)) / lines
        markers = len(MARKER.findall(text)) / lines
    symbols = len(text.translate(NO_SYMBOL)) if text.isascii() else sum(map(len, SYMBOLS.findall(text)))
    return Stats(
        chars,
        len(words),
        (chars - text.count(" ") - lines + 1) / n,
        lines,
        symbols / chars,
        digits / chars,
        float(closed),
        marks.count(1) / n,
        len(set(words)) / n,
        marks.count(2) / n,
        float(markers),
        (leaders + locators) / lines,
        len(CELLS.findall(text)) / lines if gaps and not scores else 0.0,
        scores,
    )


def votes(s: Stats) -> str:
    """One character per labelling function: p, l, t, j, or a dot where it abstains."""
    sentence = s.common_share >= 0.2 and s.closed_lines >= 0.99  # semicolons part its clauses, not cells
    cells = 0.0 if sentence else s.cell_lines
    index = s.index_lines >= 0.6 and s.common_share < 0.2
    shaped = s.marker_lines >= 0.6 or index or cells >= 0.6
    bare = not shaped and not s.score_lines
    per_line = s.words / s.lines
    terse = s.lines >= 3 and per_line <= 3 and s.closed_lines <= 0.2
    return "".join(
        (
            "p" if s.common_share >= 0.2 and not terse else "j" if s.common_share < 0.03 and s.words >= 5 and bare and (s.odd_words >= 0.3 or s.distinct_share <= 0.5) else ".",
            "p" if s.closed_lines >= 0.99 and s.common_share >= 0.1 else ".",
            "l" if s.marker_lines >= 0.6 and s.words >= 2 and (s.lines > 1 or s.common_share < 0.2) else ".",
            "l" if index and cells < 0.6 else ".",
            "t" if cells >= 0.6 else ".",
            "t" if s.digit_ratio >= 0.08 and cells >= 0.4 else ".",
            "j" if s.symbol_ratio >= 0.15 and bare else ".",
            "j" if s.odd_words >= 0.35 and bare else ".",
            "j" if bare and (s.words >= 6 and s.distinct_share <= 0.25 or s.mean_word_length > 20 and s.chars >= 40) else ".",
            "p" if s.score_lines or (bare and not terse and s.odd_words < 0.35 and s.distinct_share > 0.4 and (s.common_share >= 0.1 or s.lines == 1 or per_line >= 5)) else ".",
            "l" if bare and s.lines >= 3 and per_line <= 4.5 and s.closed_lines <= 0.2 and (terse or s.common_share < 0.2) and s.odd_words < 0.2 else ".",
            "p" if s.score_lines or (bare and s.lines == 1 and s.words <= 4 and s.chars <= 40) else ".",
        )
    )


ALPHABETS = ("p.j", "p.", "l.", "l.", "t.", "t.", "j.", "j.", "j.", "p.", "l.", "p.")
#: Share of all texts that speaks, before any evidence, for a function's votes being right.
TRUST = 0.02


def learn(patterns: dict[str, int], rounds: int = 60) -> dict[str, np.ndarray]:
    """EM over vote patterns: posterior over CLASSES of each pattern.

    Starts from the majority of votes; every function has an own distribution of votes
    per class (abstaining included), the classes have shares; counts are smoothed.
    """
    keys = sorted(patterns)
    if not keys:
        return {}
    n = np.array([patterns[k] for k in keys], dtype=float)
    post = np.full((len(keys), 4), 0.02)
    for i, k in enumerate(keys):
        for c in k:
            if c != ".":
                post[i, CODES.index(c)] += 1.0
        if set(k) == {"."}:
            post[i, 0] += 1.0
    # An undecided start leans to structure: a table or list may hold plain words.
    post = post**2
    post /= post.sum(axis=1, keepdims=True)
    seen = [np.array([a.index(k[f]) for k in keys]) for f, a in enumerate(ALPHABETS)]
    for _ in range(rounds):
        share = (n[:, None] * post).sum(axis=0) + 1.0
        share /= share.sum()
        logp = np.tile(np.log(share), (len(keys), 1))
        for f, a in enumerate(ALPHABETS):
            table = np.zeros((len(a), 4))
            np.add.at(table, seen[f], n[:, None] * post)
            table += 0.5
            for v, c in enumerate(a):
                if c != ".":
                    table[v, CODES.index(c)] += TRUST * n.sum() * share[CODES.index(c)]
            table /= table.sum(axis=0, keepdims=True)
            logp += np.log(table[seen[f]])
        logp -= logp.max(axis=1, keepdims=True)
        new = np.exp(logp)
        new /= new.sum(axis=1, keepdims=True)
        if np.abs(new - post).max() < 1e-6:
            post = new
            break
        post = new
    return dict(zip(keys, post, strict=True))


def plain(text: str) -> str:
    """The text with one form of each character, so that look-alikes do not pass for junk."""
    if text.isascii():
        return text.strip()
    twin = lookalike.tables()[1]
    text = lookalike.base_form(text)
    if lookalike.tables()[5].search(text):
        text = "".join(twin.get((c, "latin"), c) if ord(c) > 0x36F else c for c in text)
    return text.strip()


PAGE_NUMBER = re.compile(r"\W*(?:page|seite|página|p\.)?\W*[0-9ivxlc]+\W*(?:[0-9]+\W*)?", re.I)


def is_edge(kind: str, text: str, first_or_last: bool) -> bool:
    """Running heads and page numbers."""
    if kind in ("header", "footer"):
        return True
    return first_or_last and kind != "h" and len(text) < 50 and (PAGE_NUMBER.fullmatch(text) is not None or text.isupper())


def common_words(spark: SparkSession, base: str) -> frozenset[str]:
    """The common words of the fixed word list (a table of some hundred rows whatever the corpus)."""
    rows = spark.read.parquet(f"{base}/word_list.parquet").where("is_common").select(F.lower("word").alias("w")).distinct().collect()
    return frozenset(r["w"] for r in rows)


def vote_rows(df: DataFrame, src: str, key: str, text: str, common: frozenset[str], html: bool) -> DataFrame:
    """(src_table, rec_key, chars, units): readable characters and (votes, chars) of each unit. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = pa.list_(pa.struct([("votes", pa.string()), ("chars", pa.int32())]))
        kinds = Words(common)
        for batch in batches:
            keys, chars, units = [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not t:
                    continue
                if html:
                    parts = pagetext.blocks(t)
                    size = sum(len(x) for _, x in parts) + len(parts) - 1
                    last = len(parts) - 1
                    body = [x for i, (kind, x) in enumerate(parts) if not is_edge(kind, x, i in (0, last))]
                else:
                    size, body = len(t), [t]
                found = []
                for x in body:
                    x = plain(x)
                    if x and not (len(x) <= 16 and PAGE_NUMBER.fullmatch(x)):  # a bare number is no text
                        s = stats(x, kinds)
                        found.append({"votes": votes(s), "chars": s.chars})
                keys.append(k), chars.append(size), units.append(found)
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([src] * n, pa.string()), pa.array(keys, pa.int64()), pa.array(chars, pa.int32()), pa.array(units, unit)], names=["src_table", "rec_key", "chars", "units"]
            )

    return df.select(F.col(key).cast("long").alias("k"), text).mapInArrow(run, "src_table string, rec_key long, chars int, units array<struct<votes:string,chars:int>>")


def text_types(rows: DataFrame) -> DataFrame:
    """:func:`vote_rows` with ``text_type`` (the most probable class), a posterior per class (``p_prose`` and so on, the units weighted
    by their characters; they sum to 1) and ``other_share``, the posterior of list, table and junk together. Records without a unit have no type.

    The patterns collected for EM are distinct vote strings: at most the product of the alphabets' sizes, 6144.
    """
    rows = cut(rows)
    counted = rows.select(F.explode("units").alias("u")).groupBy("u.votes").agg(F.count("*").alias("n")).collect()
    post = learn({r["votes"]: r["n"] for r in counted})
    names = ["src_table", "rec_key", "chars", "text_type", *[f"p_{c}" for c in CLASSES], "other_share"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {k: i for i, k in enumerate(sorted(post))}
        matrix = np.array([post[k] for k in sorted(post)]).reshape(-1, 4)
        for batch in batches:
            units = batch.column(3)
            flat = units.flatten()
            owner = np.repeat(np.arange(len(units)), np.asarray(units.value_lengths().fill_null(0)))
            mass = np.zeros((len(units), 4))
            if len(flat):
                codes = pc.dictionary_encode(flat.field("votes"))
                lookup = np.array([place[v] for v in codes.dictionary.to_pylist()])
                np.add.at(mass, owner, matrix[lookup[np.asarray(codes.indices)]] * np.asarray(flat.field("chars"))[:, None])
            total = mass.sum(axis=1)
            keep = total > 0
            share = np.round(mass[keep] / total[keep, None], 6)
            top = pa.array([CLASSES[i] for i in share.argmax(axis=1)] if keep.any() else [], pa.string())
            some = batch.filter(pa.array(keep))
            cols = [*some.columns[:3], top, *[pa.array(share[:, i]) for i in range(4)], pa.array(np.round(share[:, 1:].sum(axis=1), 6))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "src_table string, rec_key long, chars int, text_type string, " + ", ".join(f"p_{c} double" for c in CLASSES) + ", other_share double"
    return rows.select("src_table", "rec_key", "chars", "units").mapInArrow(run, schema)


def statistics(df: DataFrame, key: str, text: str, common: frozenset[str], html: bool = False) -> DataFrame:
    """All statistics of each non-empty text (of ``html``: its readable text, a line or more per block), as columns."""
    names = Stats._fields
    types = [pa.int64() if t in ("int", int) else pa.float64() for t in Stats.__annotations__.values()]
    spark_types = ", ".join(f"{n} {'long' if t == pa.int64() else 'double'}" for n, t in zip(names, types, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Words(common)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if html:
                texts = ["\n".join(x for _, x in pagetext.blocks(t)) for t in texts]
            rows = [(k, stats(p, kinds)) for k, t in zip(batch.column(0).to_pylist(), texts, strict=True) if t and (p := plain(t))]
            cols = [pa.array([k for k, _ in rows], pa.int64())]
            cols += [pa.array([round(s[i], 6) for _, s in rows], types[i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=[key, *names])

    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, f"{key} long, {spark_types}")
