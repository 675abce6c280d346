"""Keyed surrogates of personal information.

Every value becomes an entity in one canonical form (an email spelled out, a phone with
other separators, "LEE, Ann" for "Ann Lee" are the same entity), the entity falls into
parts, and every part gets a keyed replacement of its own kind:

* family names, street words, the two sides of an email: invented words of the script;
* given names: names of the same gender and script. The first letter is a keyed
  permutation of the original's, one per family, so that "J. Lee" stays the initials of
  "John Lee" without any look-up;
* phones and identity numbers: a keyed bijection on the characters of each class (an
  alternating Feistel network), country code, leading zeros and separators kept.

Collision check. A part whose replacement is that of another part of its scope, or is
itself an original of the corpus, is drawn again under the next salt until none is left
(:func:`salted`); only these exceptions are stored, all others need no table at all.
Scopes are the kind of part, for given names the family: two given names of a family
differ, two families differ, so two persons differ.

Defined results: null values have no surrogate; values of no known kind stay as they
are; accents on bare initials are dropped; letters of scripts without own pools
(neither Latin, Greek nor Cyrillic) are replaced by Latin names.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import cut

# Frequent given names by gender and script.
FEMALE = (
    "Agnes Alice Amelia Andrea Anna Anne Annelies Anita Bärbel Barbara Beatrix Brigitte Carmen Caroline Catherine Charlotte Chloé Claire Clara Claudia Colette "
    "Consuelo Daisy Diana Dolores Dorothy Edith Eleanor Elena Elisabeth Elizabeth Ella Emily Emma Esther Eva Faith Florence Françoise Geneviève Gerda Gertrud Grace "
    "Greta Hannah Harriet Heather Helen Helga Hope Inés Ingrid Irene Isabel Jane Joan Josefina Julia Karin Kate Laura Liesel Lucía Lucy Mabel Margaret Margarita "
    "María Marie Martha Mary Mathilde Mercedes Monika Nora Odile Olive Olivia Ottilie Petra Pilar Rachel Renate Rocío Rosa Rose Ruth Sabine Sarah Simone Solange "
    "Sofía Sophie Susan Teresa Thérèse Ursula Victoria Violet Winifred Yvonne"
).split()
MALE = (
    "Albert Alexander Alfred Amos Andreas Andrés André Anthony Antonio Arthur Basil Benoît Bernard Bruno Carlos Charles Christian Cyril Daniel David Dieter Edgar "
    "Edmund Edward Émile Ernst Étienne Felix Fernando François Frank Franz Frederick Friedrich George Georg Gérard Hans Harold Heinrich Henri Henry Herbert Horst "
    "Hugh Hugo Ignacio Íñigo Jack Jacques Jaime James Javier Jean Joaquín John José Joseph Juan Julián Jürgen Karl Klaus Kurt Lucien Ludwig Luis Manuel Marc Marcel Mark "
    "Martin Matthias Matthew Michael Michel Miguel Miles Oscar Otto Pablo Patrick Paul Pedro Peter Philip Pierre Rafael Ralph Ramón René Richard Robert Rudolf "
    "Rupert Samuel Sebastián Simon Stanley Stefan Thomas Victor Walter Werner Wilhelm Will William Wolfgang Yves"
).split()
CYRILLIC_FEMALE = "Анна Вера Галина Дарья Елена Зоя Ирина Ксения Лариса Мария Надежда Ольга Полина Светлана Татьяна".split()
CYRILLIC_MALE = "Андрей Борис Виктор Григорий Дмитрий Егор Иван Кирилл Леонид Михаил Николай Олег Павел Сергей Фёдор".split()
GREEK_FEMALE = "Αγγελική Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία".split()
GREEK_MALE = "Αλέξανδρος Βασίλης Γιώργος Δημήτρης Ηλίας Θανάσης Κώστας Μιχάλης Νίκος Πέτρος".split()
# Forms of address by gender.
MALE_TITLES = frozenset("mr sir herr monsieur señor don sr".split())
FEMALE_TITLES = frozenset("mrs ms miss frau madame mademoiselle mme señora señorita doña sra".split())
# Country calling codes of one and of two digits; all others have three.
SHORT_CODES = frozenset("1 7".split())
PAIR_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
# Words of an address that say what it is, and endings that do.
STREET_TYPES = frozenset(
    "street st road rd lane avenue ave close gardens drive way place court crescent terrace square hill row grove walk park mews green rise the n s e w bis ter rue av bd boulevard "
    "chemin quai impasse allée route cours calle c avda avenida plaza paseo camino ronda am im zum zur an auf der alte alter altes alten de la los las del des du l d".split()
)
STREET_ENDINGS = ("straße", "strasse", "str", "weg", "gasse", "platz", "allee", "ufer", "damm")
AT = re.compile(r"\s*(?:@|[\[({<]\s*[aA][tT]\s*[\])}>]|\bAT\b|\barroba\b|\bat\b)\s*")
DOT = re.compile(r"(\s*(?:[\[({<]dot[\])}>]|\.)\s*|\s+(?:dot|DOT|punkt|punto|point)\s+)")

SYLLABLES = {  # heads, middles, tails of invented words; endings of given names by gender; consonants and vowels
    "latin": (
        "al bar cal den el fal gar hal ing jar kel lan mor nor or pen quil ros sel tor ul ver wen yar zan".split(),
        "a be da e ga i ka la ma ne o pa ra sa ti u va we".split(),
        "bert born by dal der ford gard ham hard kin land ley low man mark more ner ridge son stone ton wald win wood worth".split(),
        {"f": "a ina etta ella ia".split(), "m": "o us in ert or".split()},
        ("b d f g k l m n p r s t v".split(), "a e i o u".split()),
    ),
    "cyrillic": (
        "бел вол гор дом зар кар лес мор нор пол рос сав тар".split(), "а бе да е га и ка ла ма не о па ра са ти у ва".split(), "ин ов ев ский енко ник чук".split(),
        {"f": "а ина ия".split(), "m": "ор ий ан".split()}, ("б в г д к л м н п р с т".split(), "а е и о у".split()),
    ),
    "greek": (
        "αλ βαρ γαλ δεν καλ λαμ μορ νικ παλ ροδ σαβ ταρ".split(), "α βε δα ε γα ι κα λα μα νε ο πα ρα σα τι".split(), "ακης ιδης πουλος ος ας".split(),
        {"f": "α ινα ια".split(), "m": "ος ης ας".split()}, ("β γ δ κ λ μ ν π ρ σ τ".split(), "α ε ι ο".split()),
    ),
}
ALPHABETS = {"latin": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ØŁÆŒÞÐ"), "cyrillic": ("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ", "ЙЁЄІЇ"), "greek": ("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "")}
POOLS = {
    "latin": {"f": FEMALE, "m": MALE},
    "cyrillic": {"f": CYRILLIC_FEMALE, "m": CYRILLIC_MALE},
    "greek": {"f": GREEK_FEMALE, "m": GREEK_MALE},
}


def secret_of(spark: SparkSession) -> bytes:
    """The key of ``spark.quire.surrogateKey``; where it is unset a random one is drawn and set, so it lasts as long as the session."""
    key = spark.conf.get("spark.quire.surrogateKey", None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set("spark.quire.surrogateKey", key)
    return key.encode()


def folded(word: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


@lru_cache(maxsize=1_000)
def pool_of(script: str, gender: str, first: str) -> list[str]:
    """Listed given names, in lower case, that begin with a letter, accents aside."""
    return [n.lower() for n in POOLS[script][gender] if folded(n)[0] == first]


@lru_cache(maxsize=1)
def genders() -> dict[str, str]:
    """Gender by folded listed name."""
    return {folded(n): g for pools in POOLS.values() for g in ("f", "m") for n in pools[g]}


def script_of(word: str) -> str:
    for c in word:
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
        if "Ѐ" <= c <= "ԯ":
            return "cyrillic"
    return "latin"


@lru_cache(maxsize=50_000)
def gender_of(given: str) -> str:
    """Of a given name without other evidence: as listed, as all listed names that begin with it, or by its ending."""
    word = folded(given.split("-")[0])
    known = genders()
    if word in known:
        return known[word]
    longer = {g for n, g in known.items() if len(word) >= 3 and n.startswith(word)}
    if len(longer) == 1:
        return longer.pop()
    return "f" if word.endswith(("a", "ie", "elle", "ette", "ine", "а", "я", "α", "η")) else "m"


class Keyed:
    """Everything drawn under one secret."""

    def __init__(self, secret: bytes):
        self.secret = secret
        self.orders: dict[tuple[str, str], str] = {}

    def draw(self, *what) -> Iterator[int]:
        k = 0
        while True:
            yield from hmac.new(self.secret, "\x1f".join(map(str, (*what, k))).encode(), hashlib.sha256).digest()
            k += 1

    def number(self, *what) -> int:
        return int.from_bytes(hmac.new(self.secret, "\x1f".join(map(str, what)).encode(), hashlib.sha256).digest(), "big")

    def permuted(self, text: str, alphabet: str, *tweak) -> str:
        """A keyed bijection on the strings of one length over an alphabet."""
        base, half = len(alphabet), len(text) // 2

        def value(s: str) -> int:
            v = 0
            for c in s:
                v = v * base + alphabet.index(c)
            return v

        def word(v: int, n: int) -> str:
            out = []
            for _ in range(n):
                v, r = divmod(v, base)
                out.append(alphabet[r])
            return "".join(reversed(out))

        a, b = value(text[:half]), value(text[half:])
        for i in range(8):
            a, b = b, (a + self.number("feistel", len(text), i, b, *tweak)) % base ** (len(text) - half if i % 2 else half)
        return word(a, half) + word(b, len(text) - half)

    def digits(self, text: str, *tweak) -> str:
        """The same on numbers without leading zeros (walked on until the first digit is none)."""
        if not text or text[0] == "0":
            return text[:1] + self.digits(text[1:], *tweak) if text else ""
        made = self.permuted(text, "0123456789", *tweak)
        while made[0] == "0":
            made = self.permuted(made, "0123456789", *tweak)
        return made

    def letter(self, family: str, letter: str) -> str:
        """The initial that stands for ``letter`` among the given names of a family."""
        letter = folded(letter).upper()[:1] or letter
        for main, more in ALPHABETS.values():
            for letters in (main, more):
                if letter in letters:
                    order = self.orders.get((family, letters))
                    if order is None:
                        if len(self.orders) > 50_000:  # a bound on memory
                            self.orders.clear()
                        order = self.orders[family, letters] = "".join(sorted(letters, key=lambda c: self.number("letter", family, c)))
                    return order[(order.index(letter) + 1) % len(order)]
        return letter

    def invented(self, kind: str, scope: str, part: str, salt: int) -> str:
        """A lower-case word of the script of ``part``."""
        heads, middles, tails, _, _ = SYLLABLES[script_of(part)]
        d = self.draw(kind, scope, part, salt)
        return heads[next(d) % len(heads)] + "".join(middles[next(d) % len(middles)] for _ in range(2 + min(salt, 6))) + tails[next(d) % len(tails)]

    def given(self, family: str, part: str, gender: str, salt: int) -> str:
        """A lower-case given name that begins with the family's letter for it; hyphenated like the original."""
        script = script_of(part)
        _, middles, _, endings, (consonants, vowels) = SYLLABLES[script]
        first = self.letter(family, part[0]).lower()
        d = self.draw("given", family, part, salt)
        pool = pool_of(script, gender, folded(first))
        if salt < len(pool):
            made = pool[(self.number("given", family, part) + salt) % len(pool)]
        else:
            steps = [consonants, vowels] if folded(first)[0] in vowels else [vowels, consonants]
            size = 2 + 2 * min((salt - len(pool)) // 4, 4)
            made = first + "".join((s := steps[i % 2])[next(d) % len(s)] for i in range(size)) + (consonants[next(d) % len(consonants)] if steps[(size - 1) % 2] is vowels else "")
            made += endings[gender][next(d) % len(endings[gender])]
        for piece in part.split("-")[1:]:
            more = POOLS[script][gender]
            made += "-" + more[self.number("given", family, piece, salt) % len(more)].lower()
        return made

    def replacement(self, kind: str, scope: str, part: str, gender: str | None, salt: int) -> str:
        """The replacement of one part; :func:`parts_of` says which kinds there are."""
        if kind == "given":
            return self.given(scope, part, gender or gender_of(part), salt)
        if kind in ("family", "street"):
            return self.invented(kind, scope, part, salt)
        if kind in ("local", "domain"):
            return ".".join(self.invented(kind, scope + str(i), part, salt) for i in range(max(1, part.count(".") + (kind == "local"))))
        if kind == "phone":
            keep = country_code(part)
            return part[:keep] + self.digits(part[keep:], "phone", part[:keep], salt)
        if kind == "id_number":
            shape = re.sub("[0-9]", "0", re.sub("[A-Z]", "A", part))
            numbers = iter(self.permuted("".join(c for c in part if "0" <= c <= "9"), "0123456789", "id", shape, salt))
            capitals = iter(self.permuted("".join(c for c in part if "A" <= c <= "Z"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "id", shape, salt))
            return "".join(next(numbers) if s == "0" else next(capitals) if s == "A" else c for c, s in zip(part, shape, strict=True))
        return part


def country_code(phone: str) -> int:
    """Length of ``+`` and the country code of a canonical phone; 0 without."""
    if not phone.startswith("+"):
        return 0
    return 2 if phone[1:2] in SHORT_CODES else 3 if phone[1:3] in PAIR_CODES else 4


TRUNK = re.compile(r"(?<=\d)([^\d+]*)\(0\)")


def plain_digits(text: str) -> str:
    """Digits of any script as ASCII ones."""
    return text if text.isascii() else "".join(str(unicodedata.digit(c)) if c.isdigit() and unicodedata.digit(c, -1) >= 0 else c for c in text)


def name_words(value: str) -> tuple[list[str], int]:
    """Words of a name in its order, commas off, and the place of the family name."""
    words = value.split(" ")
    return [w.rstrip(",") for w in words], 0 if "," in value else len(words) - 1


def is_initial(word: str) -> bool:
    return len(word) == 2 and word[1] == "."


def street_words(value: str) -> list[tuple[str, str]]:
    """(kind, text) of the stretches of an address: number, kept, or street with its stem; texts joined give the address."""
    out = []
    for m in re.finditer(r"\d+|[^\W\d_]+|[\W_]+", value):
        s = m.group(0)
        low = s.lower()
        if s[0].isdigit():
            out.append(("number", s))
        elif not s[0].isalpha() or low in STREET_TYPES or len(s) == 1:
            out.append(("kept", s))
        else:
            ending = next((e for e in STREET_ENDINGS if low.endswith(e) and len(low) > len(e) + 1), "")
            out.append(("street", s[: len(s) - len(ending)]))
            if ending:
                out.append(("kept", s[len(s) - len(ending) :]))
    return out


def email_sides(value: str) -> tuple[str, str, str] | None:
    """(local part, the at as it stands, domain)."""
    m = AT.search(value)
    return (value[: m.start()], m.group(0), value[m.end() :]) if m else None


def parts_of(kind: str, value: str) -> list[tuple[str, str, str]]:
    """(kind of part, scope, part) of a value, in canonical form."""
    if kind == "name":
        words, place = name_words(value)
        family = words[place].lower()
        out = [("family", "", p) for p in family.split("-") if p]
        return out + [("given", family, w.lower()) for i, w in enumerate(words) if i != place and not is_initial(w)]
    if kind == "phone":
        return [("phone", "", "".join(c for c in TRUNK.sub(r"\1", plain_digits(value)) if c.isdigit() or c == "+"))]
    if kind == "id_number":
        return [("id_number", "", "".join(c for c in plain_digits(value).upper() if c.isalnum()))]
    if kind == "address":
        return [("street", "", s.lower()) for k, s in street_words(value) if k == "street"]
    if kind == "email" and (sides := email_sides(value)):
        return [("local", "", sides[0].lower()), ("domain", "", "".join("." if i % 2 else x for i, x in enumerate(DOT.split(sides[2]))).lower())]
    return []


def as_written(made: str, like: str) -> str:
    """With the capitals of ``like``: all, each word's first, or none."""
    if like.isupper() and len(like) > 1:
        return made.upper()
    return "-".join(p[:1].upper() + p[1:] for p in made.split("-")) if like[:1].isupper() else made


def refitted(made: str, value: str) -> str:
    """The letters and digits of ``made`` in the places of those of ``value``, in its case."""
    left, out = iter(made), []
    for c in value:
        n = next(left) if c.isalnum() else c
        out.append(n.lower() if c.islower() else n)
    return "".join(out)


def rebuild(keyed: Keyed, kind: str, value: str, exceptions: dict[tuple[str, str, str], tuple[int, str | None]]) -> str:
    """The surrogate of a value in its own format (order, initials, capitals, separators). ``exceptions``: (salt, gender) of parts that need other than 0 and the default."""

    def new(part_kind: str, scope: str, part: str) -> str:
        salt, gender = exceptions.get((part_kind, scope, part), (0, None))
        return keyed.replacement(part_kind, scope, part, gender, salt)

    if kind == "name":
        words, place = name_words(value)
        family, out = words[place].lower(), []
        for i, (w, stored) in enumerate(zip(words, value.split(" "), strict=True)):
            if i == place:
                made = as_written("-".join(new("family", "", p) if p else "" for p in family.split("-")), w)
            elif is_initial(w):
                made = keyed.letter(family, w[0]) + "."
            else:
                made = as_written(new("given", family, w.lower()), w)
            out.append(made + stored[len(w) :])
        return " ".join(out)
    if kind == "phone":
        ascii_value = plain_digits(value)
        trunk = [m.end() - 2 for m in TRUNK.finditer(ascii_value)]
        hidden = "".join("\0" if i in trunk else c for i, c in enumerate(ascii_value))
        return refitted(new(*parts_of(kind, value)[0]).lstrip("+"), hidden).replace("\0", "0")
    if kind == "id_number":
        return refitted(new(*parts_of(kind, value)[0]), plain_digits(value))
    if kind == "address":
        pieces = street_words(value)
        street = " ".join(s.lower() for k, s in pieces if k == "street")
        return "".join(keyed.digits(plain_digits(s), "house", street) if k == "number" else as_written(new("street", "", s.lower()), s) if k == "street" else s for k, s in pieces)
    if kind == "email" and (sides := email_sides(value)):
        (_, _, local), (_, _, domain) = parts_of(kind, value)
        words = iter([*new("domain", "", domain).split("."), "example"])
        right = "".join(x if i % 2 else next(words, "example") for i, x in enumerate(DOT.split(sides[2])))
        left = new("local", "", local)
        return (left.upper() if sides[0].isupper() else left) + sides[1] + (right.upper() if sides[2].isupper() else right)
    return value


#: Least characters of a phone or identity number that is checked for collisions, and rounds in which originals are kept off.
LEAST_CHARS = 8
ROUNDS = 50


def salted(units: DataFrame, secret: bytes) -> DataFrame:
    """``units`` (kind, scope, part, gender), distinct by the first three, with the ``salt`` at which the replacement is no other part's of
    kind and scope and no original of the kind. Each round draws only what clashed before; the groups compared hold equal replacements, so none is large."""
    keyed = Keyed(secret)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [keyed.replacement(*row) for row in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], names=[*b.schema.names, "made"])

    fields = "kind string, scope string, part string, gender string, salt int"
    # Too short to have a different replacement for each: these are drawn without a check.
    units = units.where(f"kind not in ('phone', 'id_number') or length(part) >= {LEAST_CHARS}")
    originals = units.where("kind <> 'given'").select("kind", "scope", F.col("part").alias("made")).withColumn("taken", F.lit(True))
    todo, done, last = units.withColumn("salt", F.lit(0)), None, 0
    while True:
        drawn = todo.select("kind", "scope", "part", "gender", "salt").mapInArrow(run, f"{fields}, made string")
        # Where the values nearly fill their space (identity numbers of a whole people), only each other's replacements are kept off at last.
        barred = originals if last < ROUNDS else originals.limit(0)
        taken = barred if done is None else barred.unionByName(done.select("kind", "scope", "made", F.lit(True).alias("taken")))
        first = Window.partitionBy("kind", "scope", "made").orderBy("part")
        judged = drawn.join(taken.distinct(), ["kind", "scope", "made"], "left").withColumn("free", F.col("taken").isNull() & (F.row_number().over(first) == 1) & ((F.col("made") != F.col("part")) | F.lit(last >= ROUNDS)))
        judged = cut(judged.drop("taken"))
        fresh, todo = judged.where("free"), judged.where("not free").withColumn("salt", F.col("salt") + 1)
        done, last = fresh if done is None else done.unionByName(fresh), last + 1
        if todo.isEmpty():
            return done.select("kind", "scope", "part", "gender", "salt")


def surrogates(found: DataFrame, secret: bytes, evidence: DataFrame | None = None) -> DataFrame:
    """(kind, value, surrogate) of every distinct found value. ``evidence``: (part, gender) of given names by forms of address."""
    keyed = Keyed(secret)
    values = cut(found.select("kind", "value").dropna().distinct())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "value", "part_kind", "scope", "part"]
        for b in batches:
            rows = [(k, v, *p) for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for p in dict.fromkeys(parts_of(k, v))]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=names)

    links = values.mapInArrow(split, "kind string, value string, part_kind string, scope string, part string")
    units = links.select(F.col("part_kind").alias("kind"), "scope", "part").distinct()
    if evidence is None:
        units = units.withColumn("gender", F.lit(None).cast("string"))
    else:
        known = evidence.select(F.lit("given").alias("kind"), "part", "gender")
        units = units.join(known, ["kind", "part"], "left")
    exceptions = salted(cut(units), secret).where("salt > 0 or gender is not null").withColumnRenamed("kind", "part_kind")
    other = links.join(exceptions, ["part_kind", "scope", "part"]).groupBy("kind", "value").agg(F.collect_list(F.struct("part_kind", "scope", "part", "salt", "gender")).alias("other"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for kind, value, rows in zip(*(c.to_pylist() for c in b.columns), strict=True):
                made.append(rebuild(keyed, kind, value, {(r["part_kind"], r["scope"], r["part"]): (r["salt"], r["gender"]) for r in rows or ()}))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.string())], names=["kind", "value", "surrogate"])

    return values.join(other, ["kind", "value"], "left").select("kind", "value", "other").mapInArrow(build, "kind string, value string, surrogate string")
