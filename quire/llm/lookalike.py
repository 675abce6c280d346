"""Visually identical text with different characters: one consistent form.

Step 1, by character: invisible characters go, spaces of every kind become a plain
space (none before a line end), full-width forms, ligatures and Roman-numeral signs
become their letters, accents are composed, equal-looking hyphens become one. What a
reader can tell apart stays: case, accents, raised figures, dash lengths, punctuation,
digits against letters, line breaks.

Step 2, script-aware: in a token of mixed scripts the letters of the minority script
are replaced by their look-alikes of the dominant one. The dominant script is the
token's own or, where that gives no word, the text's (a short token may be written in
foreign letters throughout). A repair is made only if its result is in the corpus
vocabulary: the words that the corpus writes in one script, and words that two
different spellings lead to.

Defined results: null text has no form; empty text is its own form; delivered copies
count once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.relational import hot_join
from quire.session import cut

# Letters of different scripts (Latin first) that look the same.
LOOKALIKES = (
    "aа", "cсϲ", "dԁ", "eе", "gց", "hһհ", "iі", "jјϳ", "lӏ", "nո", "oоοօ", "pр", "qԛգ", "sѕ", "uս", "vν", "wԝ", "xх", "yу",
    "AАΑ", "BВΒ", "CСϹ", "EЕΕ", "HНΗ", "IІΙӀ", "JЈ", "KКΚ", "MМΜ", "NΝ", "OОΟՕ", "PРΡ", "SЅՏ", "TТΤ", "UՍ", "WԜ", "XХΧ", "YҮΥУ", "ZΖ",
    "ëё", "ïї", "ËЁ", "ÏЇ", "äӓ", "öӧ", "óό",
)
# Characters without any width.
INVISIBLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿"
#: Fillers, Mongolian and other variation selectors, tags: they have no width either.
INVISIBLE_RANGES = ((0x115F, 0x1160), (0x3164, 0x3164), (0xFFA0, 0xFFA0), (0x180B, 0x180D), (0x180F, 0x180F), (0xFE00, 0xFE0F), (0xE0000, 0xE007F), (0xE0100, 0xE01EF))
HYPHENS = "‐‑"


def script(c: str) -> str:
    """Script of a letter, by block; empty for everything else."""
    o = ord(c)
    if c.isalpha():
        if o < 0x250 or 0x1E00 <= o < 0x1F00:
            return "latin"
        if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
            return "greek"
        if 0x400 <= o < 0x530:
            return "cyrillic"
        if 0x530 <= o < 0x590:
            return "armenian"
        return "other"
    return ""


@lru_cache(maxsize=1)
def tables():
    import re

    plain = {ord(c): None for c in INVISIBLE} | {ord(c): "-" for c in HYPHENS}
    for block in (range(0xFF01, 0xFFEF), range(0xFB00, 0xFB07), range(0x2160, 0x2180)):
        plain |= {o: n for o in block if (n := unicodedata.normalize("NFKC", chr(o))) != chr(o)}
    plain |= {o: " " for o in (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)}
    plain |= {o: None for low, high in INVISIBLE_RANGES for o in range(low, high + 1)}
    twin = {(c, script(d)): d for group in LOOKALIKES for c in group for d in group if c != d}
    soft_end, line_end = re.compile("­(?=\\s*\\n)"), re.compile(r"[ \t\r\f\v]+(?=\n|$)")
    token = re.compile(r"[^\W\d_](?:[\w'’̀-ͯ-]*\w)?")
    odd = re.compile(r"[Ͱ-֏ἀ-῿]")
    return plain, twin, soft_end, line_end, token, odd


@lru_cache(maxsize=1)
def mapped():
    """Finds a character that step 1 changes; most accented texts have none. Characters beyond the first plane are looked for
    apart: a class with both is searched range by range, some twenty times slower."""
    import re

    chars = sorted(map(chr, tables()[0]))
    near = re.compile("[" + "".join(re.escape(c) for c in chars if c <= "\uffff") + "]").search
    beyond = re.compile("[" + "".join(f"{chr(a)}-{chr(z)}" for a, z in INVISIBLE_RANGES if a > 0xFFFF) + "]").search
    return lambda text: near(text) or beyond(text)


def base_form(text: str) -> str:
    """Step 1 of the consistent form."""
    plain, _, soft_end, line_end, _, _ = tables()
    if not text.isascii():
        if mapped()(text):
            text = soft_end.sub("-", text).translate(plain)
        text = unicodedata.normalize("NFC", text)
    return line_end.sub("", text)


def repairs(token: str, main: str) -> list[str]:
    """Readings of a token in one script: that of most of its letters, then that of the text."""
    counts: dict[str, int] = {}
    for c in token:
        if s := script(c):
            counts[s] = counts.get(s, 0) + 1
    if not counts or set(counts) == {main}:
        return []
    twin = tables()[1]
    out = []
    for target in dict.fromkeys((max(counts, key=lambda s: (counts[s], s == main)), main)):
        made = "".join(c if script(c) in ("", target) else twin.get((c, target), "\0") for c in token)
        if "\0" not in made and made != token:
            out.append(made)
    return out


def main_script(text: str) -> str:
    """The script with most letters that no other script can imitate; without such letters, the most frequent one."""
    twin = tables()[1]
    known = {c for c, _ in twin}
    counts: dict[str, tuple[int, int]] = {}
    for c in text:
        if s := script(c):
            own, all_ = counts.get(s, (0, 0))
            counts[s] = (own + (c not in known), all_ + 1)
    return max(counts, key=counts.get) if counts else "latin"


FLUSH_WORDS = 100_000


def scan(df: DataFrame, key: str, group: str, text: str) -> DataFrame:
    """One pass. Rows of elements: key, group, digest of the stored text (``raw``), its step-1 form (``base``) and, where letters of
    other scripts occur, the ``doubt``ful tokens with their readings. Rows without key: words written in one script, in lower case."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in (key, group)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        _, _, _, _, token, odd = tables()
        words: set[str] = set()
        doubt_type = pa.list_(pa.struct([("token", pa.string()), ("reading", pa.string())]))

        def word_rows(types) -> pa.RecordBatch:
            n = len(words)
            none = pa.nulls(n, pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, types[0]), pa.nulls(n, types[1]), none, none, pa.nulls(n, doubt_type), pa.array(list(words), pa.string())], names=names_
            )

        names_ = [key, group, "raw", "base", "doubt", "word"]
        types = None
        for batch in batches:
            types = (batch.column(0).type, batch.column(1).type)
            raw, base, doubt, keep = [], [], [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                if t is None:
                    continue
                keep.append(i)
                b = base_form(t)
                found = []
                if odd.search(b):
                    main = main_script(b)
                    for w in dict.fromkeys(token.findall(b)):
                        readings = repairs(w, main)
                        found += [{"token": w, "reading": r} for r in readings]
                        if not readings:
                            words.add(w.lower())
                else:
                    words.update(token.findall(b.lower()))
                raw.append(xxhash.xxh3_128_hexdigest(t.encode()))
                base.append(b)
                doubt.append(found)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(raw, pa.string()), pa.array(base, pa.string()), pa.array(doubt, doubt_type), pa.nulls(len(keep), pa.string())],
                names=names_,
            )
            if len(words) > FLUSH_WORDS:
                yield word_rows(types)
                words.clear()
        if words and types:
            yield word_rows(types)

    schema = f"{key} {kinds[key]}, {group} {kinds[group]}, raw string, base string, doubt array<struct<token:string,reading:string>>, word string"
    return df.select(key, group, text).mapInArrow(run, schema)


def consistent_forms(df: DataFrame, key: str, group: str, text: str) -> DataFrame:
    """key, group, ``raw`` (digest of the stored text), ``form`` (the consistent text). One row per key."""
    seen = cut(scan(df, key, group, text))
    rows = seen.where(F.col("raw").isNotNull())
    odd = rows.where(F.size("doubt") > 0).select(key, group, "raw", "base", F.explode("doubt").alias("d")).select(key, group, "raw", "base", "d.*")
    readings = odd.select("token", "reading").distinct().withColumn("word", F.lower("reading"))
    vocabulary = seen.where("word is not null").select("word").distinct().withColumn("known", F.lit(1))
    agree = readings.groupBy("word").agg(F.count_distinct("token").alias("spellings"))
    good = readings.join(vocabulary, "word", "left").join(agree, "word").where("known = 1 or spellings > 1")
    # One reading per token: a known word before an agreed one, then the first by code points.
    good = good.groupBy("token").agg(F.min(F.struct(F.when(F.col("known") == 1, 0).otherwise(1).alias("o"), "reading")).alias("m")).select("token", F.col("m.reading").alias("reading"))
    tokens = odd.select(key, group, "raw", "base", "token").distinct().join(good, "token", "left")
    per = tokens.groupBy(key, group, "raw", "base").agg(F.collect_list(F.when(F.col("reading").isNotNull(), F.struct("token", "reading"))).alias("fix"))

    @F.pandas_udf("string")
    def apply(base: pd.Series, fixes: pd.Series) -> pd.Series:
        token = tables()[4]
        out = []
        for t, fix in zip(base, fixes, strict=True):
            table = {f["token"]: f["reading"] for f in fix}
            out.append(token.sub(lambda m: table.get(m.group(0), m.group(0)), t) if table else t)  # noqa: B023
        return pd.Series(out)

    mended = per.select(key, group, "raw", apply("base", "fix").alias("form"))
    sound = rows.where(F.size("doubt") == 0).select(key, group, "raw", F.col("base").alias("form"))
    return sound.unionByName(mended)


def same_look_pairs(forms: DataFrame, key: str, group: str) -> DataFrame:
    """(key_a, key_b) of the same group, smaller first, whose forms are equal and stored texts are not.

    The spellings of a form are paired first, one row each however many elements share it, and the elements
    are joined to the pairs of their spelling; two copies of one spelling never meet. The rows of a spelling
    with many copies are cut into slices.
    """
    hashed = cut(forms.select(key, group, "raw", F.md5("form").alias("form")).dropDuplicates([key]))
    # A spelling belongs to one form, so the classes need no more than their spellings.
    spellings = hashed.groupBy(group, "form", "raw").agg(F.count("*").alias("n"))
    classes = spellings.groupBy(group, "form").agg(F.min("raw").alias("a"), F.max("raw").alias("b")).where("a <> b").select(group, "form")
    varied = cut(spellings.join(classes, [group, "form"]))
    pairs = varied.select(group, "form", F.col("raw").alias("raw_b")).join(varied.select(group, "form", "raw"), [group, "form"]).where("raw < raw_b").drop("form")
    members = cut(hashed.join(varied.select(group, "raw"), [group, "raw"], "left_semi").select(group, "raw", key))
    counts = varied.select(group, "raw", "n")
    first = hot_join(members.withColumnRenamed(key, "__a"), pairs, [group, "raw"], counts).select(group, F.col("raw_b").alias("raw"), "__a")
    both = hot_join(members.withColumnRenamed(key, "__b"), first, [group, "raw"], counts)
    return both.select(F.least("__a", "__b").alias("key_a"), F.greatest("__a", "__b").alias("key_b"))
