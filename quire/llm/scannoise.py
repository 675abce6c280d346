"""Noise of scanned pages: divided words, misread words, running heads, page numbers.

One pass over the texts gives, per record, the words that the word list lacks, the
words divided at line ends, and the short lines at page edges; running text only, as
lists, tables and junk are no prose to repair.

Misread words. The anagram hash of a word is the sum of the fifth powers of its
character codes, so replacing ``a`` by ``b`` changes it by a fixed difference. For
every rare word and every known confusion that can apply, the shifted hash is joined
with the hashes of frequent words in SQL; the replacement is then verified in place.
The most frequent target wins; words that no single confusion explains are tried with two.
A target must be that much more frequent by records or by
different texts, so a misread word in a text of many copies is still a rare one.

Divided words. The joined and the hyphenated form are looked up; the more frequent one
is the word, corrected like any other where neither is known.

Edge lines. Lines at a page's edges that are its number, a range of section numbers,
the book's title (misread or not), or a line repeated over the run's pages.

Defined results: null and empty texts have no noise; delivered copies count once.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import pagetext, quality
from quire.session import cut

# What scanners read -> what stood there.
CONFUSIONS = (
    ("c", "e"), ("e", "c"), ("u", "a"), ("a", "u"), ("0", "o"), ("o", "0"), ("f", "t"), ("t", "f"), ("5", "s"), ("1", "l"), ("11", "ll"), ("1", "i"), ("l", "i"), ("i", "l"),
    ("9", "g"), ("q", "g"), ("6", "b"), ("8", "b"), ("b", "h"), ("h", "b"), ("n", "r"), ("r", "n"), ("ri", "n"), ("n", "ri"), ("ii", "u"), ("u", "ii"), ("rn", "m"), ("m", "rn"),
    ("nn", "m"), ("rm", "nn"), ("ni", "m"), ("in", "m"), ("cl", "d"), ("d", "cl"), ("tl", "d"), ("vv", "w"), ("w", "vv"), ("li", "h"), ("lc", "k"), ("3", "e"), ("2", "z"), ("4", "a"), ("7", "t"),
    ("n", "u"), ("u", "n"), ("v", "y"), ("y", "v"), ("o", "e"), ("e", "o"), ("o", "c"), ("c", "o"), ("fi", "h"), ("s", "5"), ("ll", "u"), ("1", "t"), ("l", "t"), ("t", "l"),
    ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("$", "s"),
)
#: A target must be that many times as frequent as the word it replaces.
RATIO = 10
MIN_TARGET = 5
#: Two confusions are undone only in words of that length.
TWICE_LENGTH = 6
#: A running head or page number does not end like a sentence: one of these signs, with or without closing ones behind it.
SENTENCE_ENDS, CLOSING = ".!?:;,", "\"'”»)"
#: Tables of words up to that many rows are broadcast, larger ones joined by shuffle.
BROADCAST_ROWS = 50_000

WORD = re.compile(r"(?:(?<![^\s\"'“‘(«])[!|])?[^\W_]+(?:[-!|$][^\W_]+)*")
#: The same words where no sign can stand within one.
PLAIN_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
SIGN_IN_WORD = re.compile(r"[!|$][^\W_]")
DIVIDED = re.compile(r"((?:[^\W\d_][^\W_]*-)?[^\W_]+)[-¬][^\S\n]*\n\s*([^\W\d_][^\W_]*(?:-[^\W\d_][^\W_]*)*(?![-¬][^\S\n]*\n))")
WRAP = re.compile(r"[-¬][^\S\n]*\n\s*")
ENDS = frozenset(SENTENCE_ENDS)
SENTENCE = re.compile(r"[^\W\d_][.!?][\"'”»)]*(?:\s|$)")
MARKS = frozenset("-*•–‣◦▪o(0123456789")
#: All that cannot stand in a word of ASCII text becomes a space.
SPACED = "".join(chr(c).lower() if chr(c).isalnum() or chr(c) == "-" else " " for c in range(128))
EDGE_HYPHENS = re.compile("(?<![a-z0-9])-+|-+(?![a-z0-9])|--+")


def ascii_words(text: str) -> list[str]:
    """The words of ASCII text in lower case: letters and digits, with single hyphens between."""
    flat = text.translate(SPACED)
    if "-" in flat and ("- " in flat or " -" in flat or "--" in flat or flat[0] == "-" or flat[-1] == "-"):
        flat = EDGE_HYPHENS.sub(" ", flat)
    return flat.split()


def divided_words(text: str) -> tuple[set[tuple[str, str]], str]:
    """(divided words, the text with a space for each), as DIVIDED finds them; it is tried only where a word ends in a hyphen at a line end."""
    found: set[tuple[str, str]] = set()
    parts, at = [], 0
    for wrap in WRAP.finditer(text):
        start = end = wrap.start()
        while start > at and ((c := text[start - 1]) == "-" or c.isalnum()):
            start -= 1
        for i in range(start, end):
            if (m := DIVIDED.match(text, i)) is not None:
                found.add((m.group(1).lower(), m.group(2).lower()))
                parts += text[at:i], " "
                at = m.end()
                break
    return found, "".join(parts) + text[at:] if at else text


def is_worded(words: list[str], distinct: set[str], text: str) -> bool:
    """Whether a text whose words the list hardly knows (another language, a book's own names) is made of words all the same: a sentence's
    length and end, words of sounds and of usual length, and no few ones over and over."""
    n = len(distinct)
    return n >= 5 and 3 * n >= len(words) and 2.5 <= sum(map(len, distinct)) / n <= 12 and SENTENCE.search(text) is not None and 5 * sum(map(quality.is_odd, distinct)) <= n


def is_running_text(text: str, found: list[str], unlike: set[str], known: int) -> bool:
    """Whether a text is prose to repair: words among its different ones (``unlike``), and no list or table by its lines."""
    words, distinct = len(found), len(unlike)
    if 6 * known < distinct and not is_worded(found, unlike, text):
        return False
    lines = text.count("\n") + 1
    if lines >= 3 and words <= 4.5 * lines and len(quality.CLOSED.findall(text)) <= 0.2 * lines:
        return False
    shaped = len(quality.MARKER.findall(text)) if text[0] in MARKS else 0
    if ".." in text or "…" in text:
        shaped += len(quality.LEADER.findall(text))
    if lines > 1 and text[-1].isdigit():
        shaped += len(quality.LOCATORS.findall(text))
    if shaped >= 0.6 * lines and (lines > 1 or 2 * known < distinct or ".." in text or text[0] in "-*•–"):
        return False
    if "|" in text or "\t" in text or "  " in text or ";" in text:
        # A line of cells has two separators.
        if text.count("|") + text.count("\t") + text.count("  ") + text.count(";") < 1.2 * lines:
            return True
        return len(quality.CELLS.findall(text)) < 0.6 * lines or quality.STATS.search(text) is not None
    return True


def is_word(w: str) -> bool:
    """Words worth correcting: with letters, no number and no single letter."""
    return len(w) > 1 and (w.isalpha() or (not w.isdigit() and any(map(str.isalpha, w))))


NOTHING = (frozenset(), frozenset(), frozenset())


class Reader:
    """Reads the texts of one task; texts of several copies are looked at once as long as they are remembered. Both limits bound
    memory, not the data: characters remembered (each text counts 200 more), and texts whose words wait to be counted."""

    REMEMBERED, WAITING = 2_000_000, 1_000

    def __init__(self, known: frozenset[str]):
        self.known, self.memo, self.remembered, self.waiting = known, {}, 0, 0
        self.counts: dict[int, Counter] = defaultdict(Counter)
        self.listed: dict[int, list[set[str]]] = defaultdict(list)

    def read(self, text: str, copies: int = 1) -> tuple[set[str], set[tuple[str, str]]]:
        """(unknown words, divided words) of one text."""
        if copies == 1:
            unlike, divided, there = self.look(text)
        else:
            if (found := self.memo.get(text)) is None:
                self.remembered += len(text) + 200
                if self.remembered > self.REMEMBERED:
                    self.memo.clear()
                    self.remembered = len(text) + 200
                found = self.memo[text] = self.look(text)
            unlike, divided, there = found
        if there:
            self.listed[copies].append(there)
            self.waiting += 1
            if self.waiting >= self.WAITING:
                self.settle()
        return unlike, divided

    def settle(self) -> None:
        """Counts the listed words read since the last call."""
        for copies, found in self.listed.items():
            self.counts[copies].update(chain.from_iterable(found))
        self.listed.clear()
        self.waiting = 0

    def look(self, text: str) -> tuple[set[str], set[tuple[str, str]], set[str]]:
        """(unknown words, divided words, listed words) of running text."""
        text = quality.plain(text)
        divided: set[tuple[str, str]] = set()
        flat = text
        if "\n" in text and ("-" in text or "¬" in text):
            divided, flat = divided_words(text)
        if ("!" in flat or "|" in flat or "$" in flat) and SIGN_IN_WORD.search(flat):
            words = WORD.findall(flat.lower())
        else:
            words = ascii_words(flat) if flat.isascii() else PLAIN_WORD.findall(flat.lower())
        if not words:
            return NOTHING
        distinct = set(words)
        there = distinct & self.known
        if not is_running_text(text, words, distinct, len(there)):
            return NOTHING
        return distinct - there, divided, there


SCHEMA = (
    "kind string, src_table string, a string, b string, keys array<bigint>, n bigint, copies bigint, rec_key bigint, run_id string, book_id string, page int, "
    "edges array<struct<text:string,place:int,count:int,kind:string>>"
)
EDGES = pa.list_(pa.struct([("text", pa.string()), ("place", pa.int32()), ("count", pa.int32()), ("kind", pa.string())]))
TYPES = {
    "kind": pa.string(), "src_table": pa.string(), "a": pa.string(), "b": pa.string(), "keys": pa.list_(pa.int64()), "n": pa.int64(), "copies": pa.int64(),
    "rec_key": pa.int64(), "run_id": pa.string(), "book_id": pa.string(), "page": pa.int32(), "edges": EDGES,
}


def as_batch(size: int, **columns) -> pa.RecordBatch:
    """A batch of SCHEMA with the given columns (lists or arrays; a string stands for all rows), the others null."""
    arrays = []
    for name, kind in TYPES.items():
        v = columns.get(name)
        arrays.append(pa.nulls(size, kind) if v is None else pa.array([v] * size, kind) if isinstance(v, str) else v if isinstance(v, pa.Array) else pa.array(v, kind))
    return pa.RecordBatch.from_arrays(arrays, names=list(TYPES))


def values(column: pa.Array) -> list:
    """A column as Python values, by way of numpy where that is the same and faster."""
    if column.null_count and not pa.types.is_string(column.type):
        return column.to_pylist()
    return column.to_numpy(zero_copy_only=False).tolist()


def index_rows(kind: str, src: str, index: dict, single: dict | None = None) -> pa.RecordBatch:
    """An inverted index of one batch as rows: entry (a word or a pair), the keys of its records, and the ``single`` count of those without copies."""
    entries, lists = list(index), list(index.values())
    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(list(chain.from_iterable(lists)), pa.int64()))
    first, second = (entries, None) if kind == "w" else ([e[0] for e in entries], [e[1] for e in entries])
    return as_batch(len(entries), kind=kind, src_table=src, a=first, b=second, keys=keys, n=None if single is None else [single[e] for e in entries])


def counted_rows(kind: str, src: str, counts: dict[int, dict[str, int]]) -> pa.RecordBatch:
    """Counts of words by the number of copies of their texts as rows of kind c (listed words) or r (others)."""
    rows = [(w, n, copies) for copies, c in counts.items() for w, n in c.items()]
    return as_batch(len(rows), kind=kind, src_table=src, a=[x[0] for x in rows], n=[x[1] for x in rows], copies=[x[2] for x in rows])


def scan(df: DataFrame, src: str, key: str, text: str, known: frozenset[str], html: bool) -> DataFrame:
    """One narrow pass. Per batch an inverted index of its unknown words (kind w: word ``a``, ``keys``) and its divided words
    (h: ``a``, ``b``, ``keys``), for pages the edge lines (e: one row per page), per task the counts of listed words (c: ``a``, ``n``,
    ``copies`` of their texts). Unlisted words of texts without copies are counted in ``n`` of w, the others per batch (r: as c)."""
    df = df.withColumn("text_digest", F.xxhash64(text))
    repeated = small(df.where(F.col(text) != "").groupBy("text_digest").agg(F.count("*").alias("text_copies")).where("text_copies > 1"))
    df = df.join(repeated, "text_digest", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(known)
        for batch in batches:
            words: dict[str, list[int]] = defaultdict(list)
            pairs: dict[tuple[str, str], list[int]] = defaultdict(list)
            pages, edges, offsets = [], [], [0]
            others: dict[int, Counter] = defaultdict(Counter)
            cols = [values(c) for c in batch.columns]
            for k, t, copies, *place in zip(*cols, strict=True):
                if not t:
                    continue
                if html:
                    parts = pagetext.units(t)
                    got: set[str] = set()
                    cut_: set[tuple[str, str]] = set()
                    for u in parts:
                        if u.kind not in ("li", "tr"):
                            w, h = reader.read(u.text, copies)
                            got |= w
                            cut_ |= h
                    n = len(parts)
                    for at in {0, 1, 2, n - 2, n - 1}:
                        if 0 <= at < n and "\n" not in (line := parts[at].text) and line.rstrip(CLOSING)[-1:] not in ENDS:
                            edges.append((line, at, n, parts[at].kind))
                    if len(edges) > offsets[-1]:
                        pages.append((k, *place))
                        offsets.append(len(edges))
                else:
                    got, cut_ = reader.read(t, copies)
                if copies > 1:
                    others[copies].update(got)
                for w in got:
                    words[w].append(k)
                for h in cut_:
                    pairs[h].append(k)
            words = {w: v for w, v in words.items() if is_word(w)}
            others = {c: {w: n for w, n in x.items() if w in words} for c, x in others.items()}
            # Each text of a word is in its list once; those of many copies are counted apart.
            single = {w: len(v) for w, v in words.items()}
            for c in others.values():
                for w, n in c.items():
                    single[w] -= n
            yield index_rows("w", src, words, single)
            if others:
                yield counted_rows("r", src, others)
            yield index_rows("h", src, pairs)
            if pages:
                keys, runs, books, numbers = zip(*pages, strict=True)
                lines = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*edges, strict=True), EDGES.value_type, strict=True)], names=[f.name for f in EDGES.value_type])
                yield as_batch(
                    len(pages), kind="e", src_table=src, rec_key=keys, run_id=runs, book_id=books, page=numbers, edges=pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines)
                )
        reader.settle()
        yield counted_rows("c", src, reader.counts)

    place = ["run_id", "book_id", "page"] if html else []
    return df.select(F.col(key).cast("long").alias("k"), text, F.coalesce("text_copies", F.lit(1)).alias("copies"), *place).mapInArrow(run, SCHEMA)


def anagram_hash(word: str) -> Column:
    """Sum of fifth powers of the character codes (mod 1021, so that no script overflows)."""
    return F.expr(f"aggregate(transform(split({word}, ''), c -> cast(ascii(c) % 1021 as bigint)), 0L, (s, x) -> s + x * x * x * x * x)")


def _power(s: str) -> int:
    return sum((ord(c) % 1021) ** 5 for c in s)


def changed(word: str, a: str, b: str) -> str:
    """SQL: the words that one replacement of ``a`` by ``b`` in ``word`` gives."""
    spots = f"filter(sequence(1, length({word}) - length({a}) + 1), i -> substr({word}, i, length({a})) = {a})"
    return f"transform({spots}, i -> concat(substr({word}, 1, i - 1), {b}, substr({word}, i + length({a}))))"


def corrections(rare: DataFrame, frequent: DataFrame) -> DataFrame:
    """(word, target): the most frequent word that one confusion leads to, or else two in a word of some length. Both: word, ``n`` records and, if known, different ``texts``.

    Two confusions meet half way: the words one confusion from a rare word and those one confusion back from a frequent
    word are joined by hash, so neither side grows with the square of the confusions.
    """
    rare, frequent = (x if "texts" in x.columns else x.withColumn("texts", F.col("n")) for x in (rare, frequent))
    changes = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(_power(b) - _power(a)).alias("shift")) for a, b in CONFUSIONS])
    shifted = rare.withColumn("x", changes).select("word", "n", "texts", F.explode(F.expr("filter(x, c -> instr(word, c.a) > 0)")).alias("c"), anagram_hash("word").alias("h"))
    shifted = shifted.select("word", "n", "texts", "c.a", "c.b", (F.col("h") + F.col("c.shift")).alias("h"))
    targets = frequent.where(f"n >= {MIN_TARGET}").select(F.col("word").alias("target"), F.col("n").alias("target_n"), F.col("texts").alias("target_texts"), anagram_hash("word").alias("h"))
    often = f"(target_n >= {RATIO} * n or (target_texts >= {MIN_TARGET} and target_texts >= {RATIO} * texts))"
    met = shifted.join(targets, "h").where(f"{often} and word <> target").where(f"array_contains({changed('word', 'a', 'b')}, target)")
    once = cut(met.groupBy("word").agg(F.max(F.struct("target_n", "target")).alias("m")))
    back = targets.where(f"length(target) >= {TWICE_LENGTH - 2}").withColumn("x", changes).select("target", "target_n", "target_texts", F.explode(F.expr("filter(x, c -> instr(target, c.b) > 0)")).alias("d"), "h")
    back = back.select("target", "target_n", "target_texts", F.col("d.a").alias("a2"), F.col("d.b").alias("b2"), (F.col("h") - F.col("d.shift")).alias("h"))
    left = shifted.where(f"length(word) >= {TWICE_LENGTH}").join(once.select("word"), "word", "left_anti")
    met = left.join(back, "h").where(f"{often} and word <> target").where(f"arrays_overlap({changed('word', 'a', 'b')}, {changed('target', 'b2', 'a2')})")
    twice = met.groupBy("word").agg(F.max(F.struct("target_n", "target")).alias("m"))
    return once.unionByName(twice).select("word", F.col("m.target").alias("target"))


def small(df: DataFrame) -> DataFrame:
    """A computed table, marked for broadcast only if its checked size allows."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def word_noise(rows: DataFrame) -> DataFrame:
    """(src_table, rec_key, noise, value, stored): divided and misread words of :func:`scan` rows (kept by checkpoint), with the stored spelling."""
    words = rows.where("kind = 'w'").select("src_table", F.col("a").alias("word"), "keys")
    # Of n records in texts of c copies each, n / c are different texts.
    copies = F.coalesce("copies", F.lit(1))
    records, texts = F.when(F.col("kind") == "w", F.size("keys")).when(F.col("kind") == "c", F.col("n")), F.col("n") / copies
    counted = rows.where("kind in ('c', 'r', 'w')").groupBy(F.col("a").alias("word"), (F.col("kind") == "c").alias("listed"))
    vocabulary = cut(counted.agg(F.sum(records).alias("n"), F.round(F.sum(texts)).cast("long").alias("texts")))
    divided = rows.where("kind = 'h'").select("src_table", "a", "b", "keys")
    pairs = divided.select("a", "b").distinct().select("a", "b", F.concat("a", "b").alias("joined"), F.concat_ws("-", "a", "b").alias("hyphenated"))
    counts = vocabulary.groupBy("word").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    pairs = pairs.join(counts.select(F.col("word").alias("joined"), F.col("n").alias("n1"), F.col("texts").alias("x1")), "joined", "left")
    pairs = cut(pairs.join(counts.select(F.col("word").alias("hyphenated"), F.col("n").alias("n2"), F.col("texts").alias("x2")), "hyphenated", "left").na.fill(0, ["n1", "n2", "x1", "x2"]))
    # A divided word is rare, too, if a confusion leads to a far more frequent one.
    joined = pairs.select(F.col("joined").alias("word"), F.col("n1").alias("n"), F.col("x1").alias("texts"))
    forms = joined.unionByName(pairs.where("n2 >= n1").select(F.col("hyphenated").alias("word"), F.col("n2").alias("n"), F.col("x2").alias("texts")))
    rare = vocabulary.where("not listed").select("word", "n", "texts").unionByName(forms).groupBy("word").agg(F.max("n").alias("n"), F.max("texts").alias("texts"))
    fixed = small(corrections(rare, vocabulary.where(f"listed or n >= {MIN_TARGET}").select("word", "n", "texts")))
    fix1 = fixed.select(F.col("word").alias("joined"), F.col("target").alias("t1"))
    fix2 = fixed.select(F.col("word").alias("hyphenated"), F.col("target").alias("t2"))
    pairs = pairs.join(fix1, "joined", "left").join(fix2, "hyphenated", "left")
    value = F.when(F.col("n2") > F.col("n1"), F.coalesce("t2", "hyphenated")).when(F.col("n1") > 0, F.coalesce("t1", "joined")).otherwise(F.coalesce("t1", "t2", "joined"))
    pairs = small(pairs.select("a", "b", value.alias("value"), "t1", "t2").select("a", "b", "value", F.expr("coalesce(value = t1, false) or coalesce(value = t2, false)").alias("bent")))
    # One row per noise: a divided word that was also misread is both.
    kinds = F.explode(F.expr("if(bent, array('hyphen', 'misread'), array('hyphen'))")).alias("noise")
    found = divided.join(pairs, ["a", "b"]).select("src_table", "keys", kinds, "value", F.concat_ws("\n", "a", "b").alias("stored"))
    misread = words.join(fixed, "word").select("src_table", "keys", F.lit("misread").alias("noise"), F.col("target").alias("value"), F.col("word").alias("stored"))
    both = found.unionByName(misread)
    return both.select("src_table", F.explode("keys").alias("rec_key"), "noise", "value", "stored")


NUMBER = re.compile(r"\W*(?:(page|seite|pagina|página|pág|p|s)\b\.?)?\W*(\d{1,5}|[ivxlc]{1,7})\W*", re.I)
RANGE = re.compile(r"\d{1,5}\s*[-–—]\s*\d{1,5}")
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def roman(s: str) -> int:
    v = [ROMAN[c] for c in s]
    return sum(-x if i + 1 < len(v) and x < v[i + 1] else x for i, x in enumerate(v))


@lru_cache(maxsize=10_000)
def number_line(text: str) -> tuple[int | None, bool]:
    """(the number that is all of a line, whether signs or words mark it as a page number)."""
    m = NUMBER.fullmatch(text)
    if not m:
        return None, False
    core = m.group(2)
    bare = core == text
    if core.isdigit():
        return int(core), not bare
    if core != core.lower() or m.group(1):
        return None, False
    return roman(core), True


@lru_cache(maxsize=10_000)
def letters(s: str) -> str:
    return " ".join(re.findall(r"[^\W\d_]+", s.lower()))


@lru_cache(maxsize=10_000)
def is_like(own: str, want: str) -> bool:
    """Whether letters are those of a title, some misread or missing."""
    if own == want:
        return True
    return len(own) > 3 and abs(len(own) - len(want)) <= 3 and difflib.SequenceMatcher(None, own, want, autojunk=False).ratio() >= 0.85


def edge_kind(text: str, want: str, page: int | None, place: int, count: int, kind: str, repeated: bool) -> str | None:
    """header, pageno or none for one line; ``want``: letters of the title, ``place`` of ``count`` blocks, ``kind`` of block (t where markup is unknown)."""
    top, last = place <= 1, place == count - 1
    if text[:1].isdigit() and RANGE.fullmatch(text):
        return "header" if (top or kind == "header") and kind not in ("h", "b") else None
    number, marked = number_line(text) if len(text) <= 16 else (None, False)
    if number is not None:
        if kind in ("h", "b") or not (top or last or kind in ("header", "footer")):
            return None
        if kind in ("header", "footer") or (marked and (number == page or text.strip() != str(number))):
            return "pageno"
        return "pageno" if number == page else None
    if kind == "h" or not (place <= 2 or last or kind in ("header", "footer")):
        return None
    if want and abs(len(text) - len(want)) <= 16 and is_like(letters(text), want):
        return "header"
    if kind == "header":
        return "header"
    return "header" if repeated and top and not re.search(r"[.!?,;:]$", text) else None


#: A number with signs or a short word around it, or a range of numbers.
NUMBER_LIKE = r"^[^\p{L}0-9]*(\p{L}{1,6}\.?)?[^\p{L}0-9]*([0-9]{1,5}|[ivxlc]{1,7})[^\p{L}0-9]*([0-9]{1,5})?[^\p{L}0-9]*$"


def letters_of(c: str) -> Column:
    """Words of letters in lower case, one space between."""
    return F.trim(F.lower(F.regexp_replace(c, r"[^\p{L}]+", " ")))


def edge_noise(lines: DataFrame, books: DataFrame) -> DataFrame:
    """(src_table, rec_key, noise, value) of edge lines: src_table, rec_key, run_id, book_id, page, text, place, count, kind.

    A page is grouped whole (some lines, a delivered copy once); repetition over a run is counted by key first.
    """
    lines = lines.withColumn("text", F.trim(F.regexp_replace("text", r"^[\s ]+|[\s ]+$", "")))
    lines = cut(lines.withColumn("key", F.lower(F.regexp_replace("text", r"[^\p{L}]+", " "))))
    tops = lines.where("place <= 1 and length(key) > 4").select("src_table", "run_id", "page", "key").distinct()
    often = tops.groupBy("src_table", "run_id", "key").agg(F.count("*").alias("n"))
    extent = lines.select("src_table", "run_id", "page").distinct().groupBy("src_table", "run_id").agg(F.count("*").alias("pages"))
    often = often.join(extent, ["src_table", "run_id"]).where("n >= 4 and 4 * n >= pages").select("src_table", "run_id", "key", F.lit(True).alias("repeated"))
    lines = lines.join(often, ["src_table", "run_id", "key"], "left").join(books.select("book_id", "title").dropDuplicates(["book_id"]), "book_id", "left")
    # Only these can be a head or a number; the rest needs no further look.
    near = F.abs(F.length("key") - F.length(letters_of("title"))) <= 3
    lines = lines.where(F.col("text").rlike(NUMBER_LIKE) | near | F.col("repeated") | F.col("kind").isin("header", "footer"))
    pages = lines.groupBy("src_table", "run_id", "page").agg(F.collect_list(F.struct(*Line._fields)).alias("lines"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            found = batch.column(2)
            lines = list(map(Line, *map(values, found.flatten().flatten())))
            ends = np.cumsum(values(found.value_lengths())).tolist()
            for src, page, start, end in zip(values(batch.column(0)), values(batch.column(1)), [0, *ends], ends):
                rows += [(src, *x) for x in page_noise(page, lines[start:end])]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            types = [pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["src_table", "rec_key", "noise", "value"])

    return pages.select("src_table", "page", "lines").mapInArrow(run, "src_table string, rec_key long, noise string, value string")


class Line(NamedTuple):
    """One edge line of a page."""

    rec_key: int
    place: int
    count: int
    kind: str
    text: str
    title: str | None
    repeated: bool | None


def page_noise(page: int | None, lines: list[Line]) -> list[tuple[int, str, str]]:
    """(rec_key, noise, value) of the edge lines of one page, judged together."""
    if len(lines) > 1:
        lines = sorted({(x.place, x.rec_key): x for x in lines}.values(), key=lambda x: x.place)
    title = lines[0].title
    want = letters(title or "")
    found = [[x.rec_key, edge_kind(x.text, want, page, x.place, x.count, x.kind, x.repeated is True), x.text, x.place, x.kind] for x in lines]
    heads = {x[3] for x in found if x[1] == "header"}
    # A bare number at the top is a section's own if the page ends with its number or sections could have come so far.
    ends = any(x[1] == "pageno" and x[3] >= 2 for x in found)
    for x, line in zip(found, lines, strict=True):
        if x[1] == "pageno" and x[2].isdigit() and x[4] in ("t", "p") and x[3] < 2 and line.count > 2:
            above_head = x[3] + 1 in heads
            below_head = x[3] == 1 and 0 in heads and int(x[2]) > 3
            if (ends and not above_head) or (x[3] == 1 and not above_head and not below_head) or (x[3] == 0 and x[4] == "t" and not above_head and int(x[2]) <= 6):
                x[1] = None
    # One number a page: that above the running head, before a bare one at the end.
    if any(x[1] == "pageno" and x[3] + 1 in heads for x in found):
        for x in found:
            if x[1] == "pageno" and x[2].isdigit() and x[3] >= 2 and x[4] in ("t", "p"):
                x[1] = None
    # The title of the book on its first page is no running head unless it stands there twice.
    if page == 1 and title:
        plain = [x for x in found if x[1] == "header" and x[2] == title and x[4] in ("t", "p", "b")]
        marked = any(x[4] == "h" and x[2] == title for x in found)
        if plain and not marked:
            plain[-1][1] = None
    return [(x[0], x[1], x[2]) for x in found if x[1]]


def element_edges(df: DataFrame) -> DataFrame:
    """Edge lines of element tables: the first three and last two elements of each page by ``seq``."""
    df = df.select("element_key", "run_id", "book_id", "page", "seq", "text")
    extent = df.groupBy("run_id", "page").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    short = df.where(~F.col("text").contains("\n") & ~F.right(F.rtrim("text", F.lit(CLOSING)), F.lit(1)).isin(*SENTENCE_ENDS))
    near = short.join(extent, ["run_id", "page"]).where("seq - lo <= 2 or hi - seq <= 1")
    return near.select(
        F.lit("element").alias("src_table"), F.col("element_key").cast("long").alias("rec_key"), "run_id", "book_id", "page", "text",
        (F.col("seq") - F.col("lo")).cast("int").alias("place"), (F.col("hi") - F.col("lo") + 1).cast("int").alias("count"), F.lit("t").alias("kind"),
    )


def page_edges(rows: DataFrame) -> DataFrame:
    """Edge lines of pages from :func:`scan` rows."""
    return rows.where("kind = 'e'").select("src_table", "rec_key", "run_id", "book_id", "page", F.explode("edges").alias("e")).select("src_table", "rec_key", "run_id", "book_id", "page", "e.*")


def repair(df: DataFrame, src: str, key: str, text: str, noise: DataFrame, html: bool) -> DataFrame:
    """(src_table, rec_key, text): continuous paragraphs. ``noise``: src_table, rec_key, noise, value, stored."""
    per = noise.where(F.col("src_table") == src).groupBy("rec_key").agg(F.collect_list(F.struct("noise", "value", "stored")).alias("fix"))

    @F.pandas_udf("string")
    def mend(texts: pd.Series, fixes: pd.Series) -> pd.Series:
        out = []
        for t, fix in zip(texts, fixes, strict=True):
            if not t:
                out.append(t)
                continue
            fix = [] if fix is None else fix
            drop = {f["value"] for f in fix if f["noise"] in ("header", "pageno")}
            divided = {f["stored"]: f["value"] for f in fix if f["noise"] == "hyphen"}
            words = {f["stored"]: f["value"] for f in fix if f["noise"] == "misread" and "\n" not in f["stored"]}
            blocks = [x for _, x in pagetext.blocks(t)] if html else [t]
            done = []
            for b in blocks:
                if b.strip() in drop:
                    continue
                b = quality.plain(b)

                def join(m, divided=divided) -> str:
                    value = divided.get(f"{m.group(1).lower()}\n{m.group(2).lower()}", m.group(1) + m.group(2))
                    return (value[:1].upper() + value[1:] if m.group(1)[:1].isupper() else value) + " "

                def word(m, words=words) -> str:
                    value = words.get(m.group(0).lower())
                    return m.group(0) if value is None else value[:1].upper() + value[1:] if m.group(0)[:1].isupper() else value

                if divided:
                    b = DIVIDED.sub(join, b)
                if words:
                    b = WORD.sub(word, b)
                listed = quality.MARKER.search(b) or quality.CELLS.search(b) or quality.LEADER.search(b)
                done.append(b if listed else re.sub(r"\s*\n\s*|  +", " ", b).strip())
            out.append("\n\n".join(done))
        return pd.Series(out)

    one = df.select(F.col(key).cast("long").alias("rec_key"), text).dropDuplicates(["rec_key"])
    return one.join(per, "rec_key", "left").select(F.lit(src).alias("src_table"), "rec_key", mend(text, "fix").alias("text"))
