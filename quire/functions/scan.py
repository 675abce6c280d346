"""Column functions on lines and tokens of scanned pages: number candidates, phrase repair, forms, fragments, spelling. Built-in expressions only.

Null text gives null or an empty array; a null or empty array of lines gives the values of a page without text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a sign in a misread number can stand for; an empty text means that it drops out.
SIGN_READINGS = {
    "o": ["0"], "O": ["0"], "l": ["1", "8"], "I": ["1"], "i": ["1"], "b": ["6", "8"], "B": ["8"], "g": ["9"], "q": ["9"], "s": ["5", "8"], "S": ["5", "8"], "z": ["2"],
    ":": ["", "1", "2"], ".": [""], "'": [""], "`": [""], '"': [""], "-": [""], "–": [""], "—": [""], "%": ["", "2"],
}
# Patterns of a number beside scanning errors, and the group that holds it.
NUMBER_BESIDE = (r"(?i)\bin\s+(\d+)", r"(?i)\bm\s+(\d+)", r"(?i)\b[a-zA-Z]+\s*(\d{1,3})\b", r"(?i)\b(\d{1,3})\s*[a-zA-Z]+\b")
# Words of a form, short words that are no fragments, digits read for letters.
FORM_WORDS = "SKILL STAMINA LUCK EQUIPMENT ITEMS GOLD PROVISIONS JEWELS POTIONS ADVENTURE SHEET MONSTER ENCOUNTER BOXES CARRIED".split()
SHORT_WORDS = "a i to of in it is be as at he we so do if my me up go no us am an or by on".split()
DIGITS_FOR_LETTERS = ("0134579", "oleastg")

STRINGS = "array<string>"


def number_candidates(token: Column, most: int = 32) -> Column:
    """Numbers of one to three digits that a token can stand for, in order; none if a sign stands for nothing or there are more than ``most`` ways."""
    digits = {str(i): [str(i)] for i in range(10)}
    table = F.create_map(*[x for k, v in (SIGN_READINGS | digits).items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
    signs = F.filter(F.split(token, ""), lambda c: ~c.rlike("^\\s*$"))
    ways = F.transform(signs, lambda c: F.element_at(table, c))
    count = F.aggregate(ways, F.lit(1.0), lambda n, w: n * F.coalesce(F.size(w), F.lit(0)))
    texts = F.aggregate(ways, F.array(F.lit("")), lambda acc, w: F.flatten(F.transform(acc, lambda a: F.transform(w, lambda x: F.concat(a, x)))))
    fits = F.filter(texts, lambda x: x.rlike("^[1-9][0-9]{0,2}$"))
    found = F.array_sort(F.array_distinct(F.transform(fits, lambda x: x.cast("int"))))
    usable = (F.size(signs) > 0) & count.between(1, most) & ~F.exists(ways, lambda w: w.isNull())
    return F.when(usable, found).otherwise(F.array().cast("array<int>"))


def numbers_beside_errors(text: Column) -> Column:
    """The text itself, then what is left of it when a number takes the place of the signs it was scanned with; each once."""
    cut = [F.trim(F.regexp_replace(text, p, "$1")) for p in NUMBER_BESIDE]
    return F.array_distinct(F.array_compact(F.array(text, *[F.when(text.rlike(p) & (c != ""), c) for p, c in zip(NUMBER_BESIDE, cut, strict=True)])))


def needs_number_rescue(line: Column) -> Column:
    """A line of at most six signs, a digit among them, and no more than two letters."""
    t = F.trim(line)
    return F.length(t).between(1, 6) & (F.regexp_count(t, F.lit("[0-9]")) >= 1) & (F.regexp_count(t, F.lit("\\p{L}")) <= 2)


TURN_PHRASE = r"(?i)^(.*?)\b(turn|tum)\b\s+\b(to|t0)\b\s+(\d{1,4})\b"


def repaired_phrase(line: Column) -> Column:
    """The first "turn to <number>" of a line with its misread words put right, in the case they had; other lines stay."""
    part = lambda i: F.regexp_extract(line, TURN_PHRASE, i)
    verb, to = part(2), part(3)
    wrong = (F.lower(verb) == "tum") | F.contains(to, F.lit("0")) | (F.contains(to, F.lit("O")) & (to != F.upper(to)))
    verb = F.when(verb == F.upper(verb), "TURN").when(verb.rlike("^[A-Z]"), "Turn").otherwise("turn")
    to = F.when((to == F.upper(to)) & to.rlike("[A-Z]"), "TO").otherwise("to")
    fixed = F.concat(part(1), verb, F.lit(" "), to, F.lit(" "), part(4), F.substring(line, F.length(F.regexp_extract(line, TURN_PHRASE, 0)) + 1, F.length(line)))
    return F.when((part(2) != "") & wrong, fixed).otherwise(line)


def key_values(text: Column) -> Column:
    """(entity, pairs) of a fight's stat line or of a field with or without a value; null for other text."""
    t, u = F.trim(text), F.upper(F.trim(text))
    pair = lambda k, v: F.struct(k.alias("key"), v.try_cast("int").alias("value"))
    stats = [F.regexp_extract(u, rf"\b{k}\s+([0-9]{{1,3}})\b", 1) for k in ("SKILL", "STAMINA", "LUCK")]
    pairs = F.array_compact(F.array(*[F.when(v != "", pair(F.lit(k), v)) for k, v in zip(("SKILL", "STAMINA", "LUCK"), stats, strict=True)]))
    name = F.nullif(F.regexp_replace(F.trim(F.regexp_extract(u, r"\b([A-Z][A-Z' -]{2,30})\s+SKILL\s+[0-9]{1,3}\b", 1)), " +", " "), F.lit(""))
    field, value = F.regexp_extract(t, r"^([A-Za-z][A-Za-z ]{1,24}?)\s*[:=]\s*([0-9]{0,4})$", 1), F.regexp_extract(t, r"^([A-Za-z][A-Za-z ]{1,24}?)\s*[:=]\s*([0-9]{0,4})$", 2)
    fight = F.contains(u, F.lit("SKILL")) & F.contains(u, F.lit("STAMINA")) & (F.size(pairs) > 0)
    one = F.array(pair(F.upper(F.regexp_replace(F.trim(field), " +", " ")), F.nullif(value, F.lit(""))))
    return F.when(fight, F.struct(name.alias("entity"), pairs.alias("pairs"))).when(field != "", F.struct(F.lit(None).cast("string").alias("entity"), one.alias("pairs")))


def filled(lines: Column) -> Column:
    """Lines that are not blank, trimmed."""
    return F.filter(F.transform(F.coalesce(lines, F.array().cast(STRINGS)), lambda x: F.trim(x)), lambda x: x != "")


def share(lines: Column, test) -> Column:
    return F.size(F.filter(lines, test)) / F.greatest(F.size(lines), F.lit(1))


def form_confidence(lines: Column) -> Column:
    """How much a page looks like a form to fill in, 0 to 1; a form from 0.5 on."""
    x = filled(lines)
    mean = F.aggregate(x, F.lit(0), lambda n, s: n + F.length(s)) / F.greatest(F.size(x), F.lit(1))
    text = F.upper(F.array_join(x, " "))
    words = sum((F.contains(text, F.lit(w)).cast("int") for w in FORM_WORDS), F.lit(0))
    score = (
        F.when(mean < 8, 0.4).when(mean < 12, 0.2).otherwise(0.0)
        + F.when(share(x, lambda s: F.contains(s, F.lit("="))) > 0.3, 0.3).otherwise(0.0)
        + F.when(share(x, lambda s: (s == F.upper(s)) & (s != F.lower(s)) & (F.length(s) < 20)) > 0.2, 0.2).otherwise(0.0)
        + F.when(words >= 3, 0.3).when(words >= 1, 0.1).otherwise(0.0)
        + F.when(share(x, lambda s: (F.length(s) < 5) & ~s.rlike("^[0-9]+$")) > 0.4, 0.2).otherwise(0.0)
    )
    return F.when(F.size(x) == 0, 0.0).otherwise(F.round(F.least(score, F.lit(1.0)), 3))


def is_fragment(line: Column, least: int = 4) -> Column:
    """A very short line that is neither a number, capitals of one or two letters, nor a common short word."""
    t = F.trim(line)
    return F.length(t).between(1, least - 1) & ~t.rlike("^[0-9]+$") & ~t.rlike("^[A-Z]{1,2}$") & ~F.lower(t).isin(SHORT_WORDS)


def trailing_fragments(lines: Column, least_lines: int = 5, least: int = 3, clustered: float = 0.5) -> Column:
    """Number of fragments at the end of a page that are no part of its text: three at least and half of all its fragments; else 0."""
    flags = F.transform(F.coalesce(lines, F.array().cast(STRINGS)), lambda x: is_fragment(x))
    all_, last_whole = F.size(F.filter(flags, lambda f: f)), F.array_position(F.reverse(flags), False)
    tail = F.when(last_whole > 0, last_whole - 1).otherwise(F.size(flags))
    return F.when((F.size(flags) >= least_lines) & (tail >= least) & (tail >= clustered * all_), tail).otherwise(0).cast("int")


def duplicate_share(lines: Column) -> Column:
    """Share of the lines that repeat another one."""
    x = filled(lines)
    return F.when(F.size(x) == 0, 0.0).otherwise(1 - F.size(F.array_distinct(x)) / F.size(x))


def spell_columns(df: DataFrame, text: Column, known: str, out: str) -> DataFrame:
    """Adds ``out`` (words, dictionary, confusion) of a text against the array column ``known`` of lower-case words: number of ASCII words, share
    of unknown ones (a half at least where one is without vowel), and signs of digits read for letters. Higher is worse.

    In steps, so that each array is made once; only words that are unknown as they stand are looked at one by one.
    """
    has = lambda w: F.array_contains(F.col(known), w)
    # Plurals count by their singular.
    plural = lambda w: w.endswith("s") & (
        ((F.length(w) > 3) & has(F.regexp_replace(w, "s$", ""))) | (w.endswith("es") & (F.length(w) > 3) & has(F.regexp_replace(w, "es$", ""))) | (w.endswith("ies") & (F.length(w) > 4) & has(F.regexp_replace(w, "ies$", "y")))
    )
    punctuation = "^[.,;:!?()\\[\\]{}<>\"']+|[.,;:!?()\\[\\]{}<>\"']+$"
    d = df.withColumn("__w", F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"), F.lit(1))).withColumn("__t", F.filter(F.split(text, "\\s+"), lambda t: t != ""))
    d = d.withColumn("__u", F.filter(F.array_except("__w", F.col(known)), lambda w: ~plural(w)))
    d = d.withColumn("__n", F.size(F.filter("__w", lambda w: F.array_contains(F.col("__u"), w))))
    mixed = F.filter("__t", lambda t: t.rlike("[A-Za-z]") & t.rlike("[0-9]"))
    d = d.withColumn("__m", F.filter(F.transform(mixed, lambda t: F.regexp_replace(t, punctuation, "")), lambda t: ~t.rlike("(?i)^[0-9]+(st|nd|rd|th)$")))
    voiceless = F.exists("__u", lambda w: (F.length(w) >= 4) & ~w.rlike("[aeiouy]"))
    dictionary = F.least(F.lit(1.0), F.greatest(F.col("__n") / F.greatest(F.size("__w"), F.lit(1)), F.when(voiceless, 0.5).otherwise(0.0)))
    suspect = F.exists("__m", lambda t: (F.length(t) >= 4) & t.rlike("[0134579]"))
    meant = F.exists("__m", lambda t: (F.length(t) >= 2) & has(F.translate(F.lower(t), *DIGITS_FOR_LETTERS)))
    share_ = F.size(F.filter("__m", lambda t: F.length(t) >= 3)) / F.greatest(F.size("__t"), F.lit(1))
    confusion = F.least(F.lit(1.0), F.greatest(share_ * 2, F.when(suspect, 0.6).when(meant, 0.5).otherwise(0.0)))
    spell = F.struct(F.size("__w").alias("words"), F.round(dictionary, 4).alias("dictionary"), F.round(confusion, 4).alias("confusion"))
    # A generator, so that a filter on the result is not moved below it, where every step would be worked out again.
    return d.withColumn(out, F.explode(F.array(spell))).drop("__w", "__t", "__u", "__n", "__m")


def engine_score(lines: Column, spell: Column, short: int = 40) -> Column:
    """How bad a reading of a page is: unknown words, confusions, repeated lines, and little text at all."""
    chars = F.length(F.trim(F.array_join(F.coalesce(lines, F.array().cast(STRINGS)), "\n")))
    return F.round(F.least(F.lit(1.5), 0.55 * spell.dictionary + 0.25 * spell.confusion + 0.35 * duplicate_share(lines) + F.when(chars < short, 0.25).otherwise(0.0)), 4)
