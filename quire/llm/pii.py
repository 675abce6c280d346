"""Personal information in free text: detection, typed placeholders, keyed surrogates.

Detection. One Arrow pass per document finds emails (also spelled out), phones,
identity numbers and street addresses by the public grammars of these things, and all
runs of capitalised words. Names are decided against the corpus: a given name comes
from the fixed list below or is learnt from the corpus (a word before an initial and
varying surnames, or after a title), a family name is a capitalised word that the
corpus never writes in lower case. Runs are decided once per distinct run.

Surrogates of what is found are those of :mod:`quire.llm.surrogates`.

Defined results: null or empty text has no entities; a text without entities comes
out unchanged; repeated values of a document count once; a line break inside a value
counts as one space.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import surrogates as sg
from quire.operators.relational import hot_join
from quire.session import cut

# Forms of address.
TITLES = "Mr Mrs Ms Miss Dr Prof Sir Herr Frau Madame Monsieur Mademoiselle Mme Señor Señora Señorita Don Doña Sr Sra".split()

GIVEN = frozenset(x.lower() for x in (*sg.FEMALE, *sg.MALE, *sg.CYRILLIC_FEMALE, *sg.CYRILLIC_MALE, *sg.GREEK_FEMALE, *sg.GREEK_MALE))
#: A learnt given name needs that many different family names after it.
LEARN_SURNAMES = 3

# Spaces within a line, and a join that may hold one line break.
_S = r"[^\S\r\n]"
_J = rf"(?:{_S}*\r?\n{_S}*|{_S}+)"
_CAP = r"\p{Lu}[\p{L}'’]*"
_STREETS = "Street|St|Road|Rd|Lane|Avenue|Ave|Close|Gardens|Drive|Way|Place|Court|Crescent|Terrace|Square|Hill|Row|Grove|Walk|Park|Mews|Green|Rise"


@lru_cache(maxsize=1)
def patterns() -> dict:
    import re

    import regex

    label = r"[^\W_](?:[\w-]*[^\W_])?"
    dot = r"(?:\[dot\]|\(dot\)|\{dot\}|<dot>|DOT|dot|punkt|punto|point)"
    local = r"(?<![\w.+@-])(?:[oO]['’])?[^\W_][\w.+%-]*"
    gap = rf"(?:[-./]|{_J})"
    phone = "|".join(
        [
            rf"\+\d{{1,3}}(?:{gap}?\(\d{{1,5}}\))?(?:{gap}?\d+){{1,6}}",
            rf"1{gap}\d{{3}}{gap}\d{{3}}{gap}\d{{4}}",
            rf"\(\d{{3}}\){_J}?\d{{3}}{gap}\d{{4}}",
            rf"\d{{3}}{gap}\d{{3}}{gap}\d{{4}}",
            rf"\(0\d{{1,5}}\){_J}?\d+(?:{gap}\d+){{0,4}}",
            rf"0\d{{1,5}}/\d+(?:[ -]\d+){{0,3}}",
            rf"0\d(?:{gap}\d\d){{4}}",
            rf"0\d{{2,5}}{_J}\d{{3,8}}(?:{_J}\d{{3,4}})?",
            rf"0\d{{8,11}}",
            rf"[6789]\d{{2}}{_J}\d{{3}}{_J}\d{{3}}",
        ]
    )
    sure_id = "|".join(
        [
            rf"\d{{3}}(?:-|{_J})\d{{2}}(?:-|{_J})\d{{4}}",
            rf"[A-Z]{{2}}{_J}?\d\d{_J}?\d\d{_J}?\d\d{_J}?[A-D]",
            rf"[12]{_J}?\d\d{_J}?\d\d{_J}?\d\d{_J}?\d{{3}}{_J}?\d{{3}}{_J}?\d\d",
            r"[XYZ]-?\d{7}-?[A-Z]",
            r"\d{8}-?[A-Z]",
        ]
    )
    cued_id = rf"\d{{2}}{_J}\d{{3}}{_J}\d{{3}}{_J}\d{{3}}|\d{{7,15}}|[A-Z]{{1,2}}\d{{6,9}}|[A-Z](?=[A-Z0-9]*\d[A-Z0-9]*\d)[A-Z0-9]{{7,11}}"
    cue = (
        r"(?i)(?:\bID\b|\bSSN\b|insurance|passport|security|identity|identit|identidad|\bDNI\b|\bNIE\b|\bNIF\b|\bNIR\b|ausweis|steuer|\btax\b|verified|\bmember|licen[cs]e|"
        r"s[ée]cu|sociale|documento|reisepass|pasaporte|passeport|fiscal|seguridad)[^.!?\d]{0,24}(?:(?:no|nr|núm|num|n)\.)?[^.!?\d]{0,12}$"
    )
    art = rf"(?:de{_J}la{_J}|de{_J}los{_J}|de{_J}las{_J}|del{_J}|des{_J}|du{_J}|de{_J}l'|de{_J}|d')?"
    suffix, before = r"(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|damm)", ("Am", "Im", "Zum", "Zur", "An{}der", "Auf{}der")
    ways = ("Calle{}", "C/{}?", r"Avda\.{}", "Avenida{}", "Plaza{}", "Paseo{}", "Camino{}", "Ronda{}")
    after = rf"(?=\s*(?:[,.;:)\]\r\n]|$)|{_J}(?:in|near|at|à|en|bei)\b)"
    address = "|".join(
        [
            rf"(?<![\w/.-])\d{{1,4}}[a-z]?(?:[-–]\d{{1,4}}[a-z]?)?{_J}(?:[NSEW]\.{_J})?(?:{_CAP}{_J}){{1,3}}(?:{_STREETS})\b{after}",
            rf"(?<![\w/.-])\d{{1,4}}[a-z]?(?:[-–]\d{{1,4}})?{_J}The{_J}\p{{Lu}}\p{{L}}+s\b{after}",
            rf"(?:Alte[rsn]?{_J})?\p{{Lu}}[\p{{L}}-]*{suffix}{_J}\d{{1,4}}[a-z]?\b",
            rf"\b(?:{'|'.join(before).format(_J, _J)}){_J}\p{{Lu}}[\p{{L}}-]+{_J}\d{{1,4}}[a-z]?\b",
            rf"(?<![\w/.-])\d{{1,4}}(?:{_J}(?:bis|ter))?,?{_J}(?:rue|avenue|av\.|bd\.|boulevard|chemin|place|quai|impasse|allée|route|cours|square){_J}{art}{_CAP}(?:-{_CAP})*",
            rf"\b(?:{'|'.join(ways).replace('{}', _J)}){art}{_CAP}(?:{_J}{_CAP})?,?{_J}\d{{1,4}}[a-z]?\b",
        ]
    )
    edge, end = r"(?<![\w@/.,\-+])", r"(?![\w@/]|[-.,]\d)"
    token = rf"(?:\p{{Lu}}\.|{_CAP}(?:-{_CAP})*)"
    return {
        "at": re.compile(r"@|[\[({<]at[\])}>]|\bAT\b|\barroba\b|\bat\b(?=\s+\S+\s+(?:dot|DOT|[\[({<]dot[\])}>])\s)"),
        "local": regex.compile(rf"{local}(?P<j>{_J})?$"),
        "domain": regex.compile(rf"{label}(?:\.{label})*\.[^\W\d_]{{2,}}"),
        # After a spelled at: each separator a dot or a spelled dot; a last label after a dot is a plain one.
        "spelled": regex.compile(rf"{_J}{label}(?:(?:\.|{_J}{dot}{_J}){label})*(?:\.[^\W\d_]{{2,}}|{_J}{dot}{_J}{label})(?![\w@])"),
        # Where a number can be at all: six digits with no more than separators between them, or a code of capitals and digits.
        "digits": re.compile(r"\d(?:[-./()\s]*\d){5}"),
        "code": re.compile(r"[A-Z](?=[A-Z0-9]{7})[A-Z0-9]*\d[A-Z0-9]*\d"),
        "digit": re.compile(r"\d"),
        "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
        # Where an address can be at all: a number before a capital or a street word, or a street word of the other order.
        "street": re.compile(rf"\d[a-z]?\s+(?:[^\W\d_a-z][\w'’.]*\s+){{1,4}}(?:{_STREETS})\b|\d[a-z]?\s+The\s+[^\W\d_a-z]|\d(?:\s+(?:bis|ter))?,?\s+(?:rue|avenue|av\.|bd\.|boulevard|chemin|place|quai|impasse|allée|route|cours|square)\s"),
        "street_first": re.compile(rf"(?=[swgpaudAIZCPR])(?:{suffix}\s+\d|(?:{'|'.join(before).format(*[chr(92) + 's+'] * 2)})\s+[^\W\d_]|{'|'.join(ways).replace('{}?', '').replace('{}', chr(92) + 's+')})"),
        "address": regex.compile(address),
        "phone": regex.compile(rf"{edge}(?:{phone}){end}"),
        "sure_id": re.compile(rf"{edge}(?:{sure_id}){end}"),
        "cued_id": re.compile(rf"{edge}(?:{cued_id}){end}"),
        "cue": regex.compile(cue),
        "run": regex.compile(rf"(?<![\w'’.-]){token}(?:,?{_J}{token})+(?![\w’'-])"),
        "space": regex.compile(r"\s+"),
    }


#: Without one of these a text has no email, and no address with the number behind the street.
AT_SIGNS = ("@", "at]", "at)", "at}", "at>", "AT", "arroba", "dot", "DOT")
STREET_SIGNS = ("straße", "strasse", "str.", "weg", "gasse", "platz", "allee", "ufer", "damm", "Am", "Im", "Zum", "Zur", "An", "Auf", "Calle", "C/", "Avda.", "Avenida", "Plaza", "Paseo", "Camino", "Ronda")
PUNCTUATION = ".,;:!?\"“”„»«()¿¡…"


def contacts(text: str, gated: bool = True) -> tuple[list[tuple[str, str]], str]:
    """Emails, addresses, identity numbers and phones of a text, and the text with them blanked out.

    ``gated``: the grammars run only where a cheap pattern that everything they match contains is found; the result is the same without."""
    p, found = patterns(), []

    def take(kind: str):
        def sub(m) -> str:
            found.append((kind, m.group(0)))
            return "\0" * len(m.group(0))

        return sub

    def take_cued(m) -> str:
        before = p["space"].sub(" ", m.string[max(0, m.start() - 70) : m.start()])
        return take("id_number")(m) if p["cue"].search(before) else m.group(0)

    def take_phone(m) -> str:
        n = sum(c.isdigit() for c in m.group(0))
        return take("phone")(m) if 9 <= n <= 15 else m.group(0)

    spans = []
    for m in p["at"].finditer(text) if not gated or any(x in text for x in AT_SIGNS) else ():
        low = max(0, m.start() - 80)
        left = p["local"].search(text, low, m.start())
        right = left and p["domain" if m.group(0) == "@" else "spelled"].match(text, m.end())
        if right and (m.group(0) == "@") == (left.group("j") is None):
            spans.append((left.start(), right.end()))
    for a, b in reversed(spans):
        found.append(("email", text[a:b]))
        text = text[:a] + "\0" * (b - a) + text[b:]
    if not gated or (p["digit"].search(text) and ((any(x in text for x in STREET_SIGNS) and p["street_first"].search(text)) or p["street"].search(text))):
        text = p["address"].sub(take("address"), text)
    if not gated or p["digits"].search(text) or p["code"].search(text):
        text = p["iban"].sub(lambda m: "\0" * len(m.group(0)), text)  # account numbers are no phones
        text = p["cued_id"].sub(take_cued, text)
        text = p["sure_id"].sub(take("id_number"), text)
        text = p["phone"].sub(take_phone, text)
    return found, text


def tidy(value: str) -> str:
    """The value with inner line breaks as one space and no surrounding punctuation."""
    value = patterns()["space"].sub(lambda m: " " if "\n" in m.group(0) or "\r" in m.group(0) else m.group(0), value)
    value = value.strip(" \t,.;:!?\"'’")
    return value[:-1] if value.endswith(")") and "(" not in value else value


#: Words kept in a task before they are handed on: a bound on memory.
FLUSH_WORDS = 100_000


def scan_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """One pass: rows (kind, ``key``, value) of contacts, runs of capitalised words, and (kind ``word``) lower-case words of the task."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, words, seen = patterns(), set(), set()
        for batch in batches:
            kinds, keys, values = [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not t:
                    continue
                found, rest = contacts(t)
                for what, value in dict.fromkeys((w, tidy(v)) for w, v in found):
                    kinds.append(what), keys.append(k), values.append(value)
                runs = dict.fromkeys(p["space"].sub(" ", m.group(0)) for m in p["run"].finditer(rest))
                for value in runs:
                    kinds.append("run"), keys.append(k), values.append(value)
                fresh = set(rest.split()) - seen
                seen |= fresh
                words.update(x for w in fresh if len(x := w.strip(PUNCTUATION)) > 1 and x.islower() and x.isalpha())
            if len(seen) > FLUSH_WORDS:
                kinds += ["word"] * len(words)
                keys += [None] * len(words)
                values += words
                words, seen = set(), set()
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(keys, batch.column(0).type), pa.array(values, pa.string())], names=["kind", key, "value"])
        if words:
            n = len(words)
            yield pa.RecordBatch.from_arrays([pa.array(["word"] * n), pa.array([None] * n, batch.column(0).type), pa.array(list(words))], names=["kind", key, "value"])

    return df.select(key, text).mapInArrow(run, f"kind string, {key} {kind}, value string")


def decide(run: str, lower: set[str], learnt: set[str], known: frozenset[str] = GIVEN) -> list[str]:
    """The full names in a run of capitalised words. ``lower``: its words that the corpus writes in lower case; ``learnt``: its learnt given names; ``known``: listed ones."""
    tokens = run.split(" ")
    comma = [t.endswith(",") for t in tokens]
    bare = [t.rstrip(",") for t in tokens]
    low = [t.lower() for t in bare]
    titles = {t.lower() for t in TITLES}
    initial = [len(t) == 2 and t[1] == "." for t in bare]
    given = [(x in known or x in learnt) and len(x) > 1 for x in low]
    streets = set(_STREETS.lower().split("|"))
    family = [
        not initial[i] and len(x) > 2 and x not in titles and x not in streets and (x not in lower and not all(y in lower for y in x.split("-"))) and not given[i]
        for i, x in enumerate(low)
    ]
    n, i, out = len(tokens), 0, []
    while i < n:
        j = i
        while j < n and (given[j] or initial[j]) and not comma[j]:
            j += 1
        if j > i and j < n and family[j] and (any(given[i:j]) or _looks_like_name(bare[j])):
            out.append(" ".join([*tokens[i:j], bare[j]]))
            i = j + 1
            continue
        if family[i] and comma[i] and i + 1 < n:
            j = i + 1
            while j < n and (given[j] or initial[j]):
                j += 1
                if comma[j - 1]:
                    break
            alone = not (j < n and family[j] and not comma[j - 1] and not (j + 1 < n and comma[j] and given[j + 1]))
            if j > i + 1 and (given[i + 1] or initial[i + 1]) and alone:
                out.append(" ".join([*tokens[i : j - 1], bare[j - 1]]))
                i = j
                continue
        i += 1
    return out


def _looks_like_name(word: str) -> bool:
    """After initials alone, where codes also stand: a capitalised word of letters, of some length and with vowels."""
    vowels = sum(c in "aeiouyäöüáéíóúàèâêîôû" for c in word.lower())
    return len(word) >= 4 and (word.isupper() and len(word) >= 5 or not word[1:2].isupper()) and 5 * vowels >= len(word)


def names(scan: DataFrame, key: str, known: frozenset[str] = GIVEN) -> DataFrame:
    """(``key``, value) of the full names, from the runs and words of :func:`scan_text`; ``known``: listed given names."""
    runs = scan.where("kind = 'run'").select(key, F.col("value").alias("run"))
    lower = scan.where("kind = 'word'").select(F.col("value").alias("token")).distinct().withColumn("lower", F.lit(True))
    kinds = cut(runs.groupBy("run").agg(F.count("*").alias("n")))
    parts = kinds.withColumn("t", F.split("run", " "))
    titles = F.array(*[F.lit(x) for t in TITLES for x in (t, t + ".")])
    # Evidence for a given name: "G X. Family" and "Title G Family". ("G Family" alone is none: towns stand before names in letters.)
    ev = parts.select(F.posexplode("t").alias("i", "b"), "t")
    ev = ev.select(
        F.lower("b").alias("token"),
        F.when(F.expr("try_element_at(t, i + 2) rlike '^\\\\p{Lu}\\\\.$' and try_element_at(t, i + 3) rlike '^[^.,]{3,}$' and not t[i] rlike '[.,]'"), F.lower(F.expr("try_element_at(t, i + 3)")))
        .when(F.expr("i > 0 and not t[i] rlike '[.,]' and try_element_at(t, i + 2) rlike '^[^.,]{3,}$'") & F.array_contains(titles, F.expr("t[greatest(i - 1, 0)]")), F.lower(F.expr("try_element_at(t, i + 2)")))
        .alias("family"),
    ).where("family is not null and length(token) > 2")
    learnt = ev.distinct().groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= LEARN_SURNAMES)
    learnt = learnt.join(lower, "token", "left_anti").select("token", F.lit(True).alias("learnt"))
    tokens = parts.select("run", F.explode(F.expr("array_distinct(flatten(transform(t, x -> array_append(split(rtrim(',', lower(x)), '-'), rtrim(',', lower(x))))))")).alias("token"))
    marked = tokens.join(lower, "token", "left").join(learnt, "token", "left").where("lower or learnt")
    marked = marked.groupBy("run").agg(
        F.collect_list(F.when(F.col("lower"), F.col("token"))).alias("lower"), F.collect_list(F.when(F.col("learnt"), F.col("token"))).alias("learnt")
    )
    full = kinds.join(marked, "run", "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r, a, b in zip(f["run"], f["lower"], f["learnt"], strict=True):
                rows += [(r, x) for x in decide(r, set() if a is None else set(a), set() if b is None else set(b), known)]
            yield pd.DataFrame(rows, columns=["run", "value"], dtype=object)

    decided = full.select("run", "lower", "learnt").mapInPandas(run, "run string, value string")
    # A run that many documents hold meets its names by broadcast.
    return hot_join(runs, cut(decided), ["run"], kinds).select(key, "value").distinct()


def title_genders(scan: DataFrame) -> DataFrame:
    """(part, gender) of given names that are not listed, by the majority of the forms of address before them in the runs of :func:`scan_text`."""
    t = F.split(F.lower("value"), "[ .,]+")
    titles = scan.where("kind = 'run'").select(t.alias("t")).where("size(t) > 2")
    pairs = titles.select(F.explode(F.expr("transform(sequence(1, size(t) - 2), i -> struct(t[i - 1] as title, t[i] as part))")).alias("x")).select("x.*")
    of = F.when(F.col("title").isin(*sg.FEMALE_TITLES), 1).when(F.col("title").isin(*sg.MALE_TITLES), -1)
    votes = pairs.select("part", of.alias("v")).where("v is not null and length(part) > 1").groupBy("part").agg(F.sum("v").alias("v"))
    return votes.where(~F.col("part").isin(*GIVEN) & (F.col("v") != 0)).select("part", F.when(F.col("v") > 0, "f").otherwise("m").alias("gender"))


def find(df: DataFrame, key: str, text: str) -> DataFrame:
    """(``key``, kind, value): every different entity of every text."""
    return _found(cut(scan_text(df, key, text)), key)


def entities(df: DataFrame, key: str, text: str, secret: bytes) -> DataFrame:
    """(``key``, kind, value, surrogate): every different entity of every text with its replacement."""
    scan = cut(scan_text(df, key, text))
    found = cut(_found(scan, key))
    return hot_join(found, cut(sg.surrogates(found, secret, title_genders(scan))), ["kind", "value"]).select(key, "kind", "value", "surrogate")


def _found(scan: DataFrame, key: str) -> DataFrame:
    plain = scan.where("kind in ('email', 'phone', 'id_number', 'address')").select(key, "kind", "value")
    return plain.unionByName(names(scan, key).select(key, F.lit("name").alias("kind"), "value"))


def replace(df: DataFrame, key: str, text: str, found: DataFrame) -> DataFrame:
    """(``key``, placeholder_text, surrogate_text); the :func:`entities` of a document travel to it by its key."""
    per = found.groupBy(key).agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("e"))

    @F.pandas_udf("struct<p:string,s:string>")
    def swap(texts: pd.Series, entities: pd.Series) -> pd.DataFrame:
        import regex

        rows = []
        for t, es in zip(texts, entities, strict=True):
            if t is None or es is None or len(es) == 0:
                rows.append((t, t))
                continue
            table = {e["value"]: (e["kind"], e["surrogate"]) for e in es}
            order = sorted(table, key=len, reverse=True)
            pat = regex.compile(r"(?<!\w)(?:" + "|".join(r"\s+".join(regex.escape(w) for w in v.split()) for v in order) + r")(?!\w)")
            find_ = {" ".join(v.split()): x for v, x in table.items()}
            rows.append((pat.sub(lambda m: f"[{find_[' '.join(m.group(0).split())][0].upper()}]", t), pat.sub(lambda m: find_[" ".join(m.group(0).split())][1], t)))
        return pd.DataFrame(rows, columns=["p", "s"])

    with_ = df.select(key, text).join(per, key, "left").withColumn("r", swap(text, "e"))
    return with_.select(key, F.col("r.p").alias("placeholder_text"), F.col("r.s").alias("surrogate_text"))
