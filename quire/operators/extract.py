"""Typed records out of running text: fights, checks, stat changes, items, and the event list of a section.

Everything is built-in expressions; a text without matches gives no rows, nulls count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numbers as words.
NUMBER_WORDS = "one two three four five six seven eight nine ten eleven twelve".split()
STAT_BLOCK = "([A-Z][A-Z' -]{2,30}?)[ ]+SKILL:?[ ]*([0-9]{1,2})[ ]+STAMINA:?[ ]*([0-9]{1,2})"
STAT_CHANGE = "(?i)(lose|gain|deduct|restores?|add)[ ]+([a-z]+|[0-9]+)[ ]+points?[ ]+of[ ]+(stamina|skill|luck)"
ITEM_USE = "(?i)if[ ]+you[ ]+have[ ]+an?[ ]+([a-z-]+),"
ITEM_START = "(?i)begin[ ]+the[ ]+adventure[ ]+with[ ]+an?[ ]+([a-z-]+),[ ]+an?[ ]+([a-z-]+)"


def flat(c: Column) -> Column:
    """White space as single spaces, so that patterns run over line ends."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[ \\t\\r\\n]+", " ")


def word_number(c: Column) -> Column:
    """A number written as digits or as a word; null otherwise."""
    low = F.lower(c)
    table = F.create_map(*[x for i, w in enumerate(NUMBER_WORDS) for x in (F.lit(w), F.lit(i + 1))])
    return F.coalesce(F.when(low.rlike("^[0-9]+$"), low.try_cast("int")), table[low])


def matches(df: DataFrame, text: Column, pattern: str, groups: list[str]) -> DataFrame:
    """One row per match of a pattern with its groups as columns and its place."""
    per = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i + 1)) for i in range(len(groups))]
    zipped = F.arrays_zip(*[p.alias(g) for p, g in zip(per, groups, strict=True)])
    d = df.select(*df.columns, F.posexplode(zipped).alias("place", "m"))
    return d.select(*df.columns, "place", *[F.col(f"m.{g}") for g in groups])


def stat_blocks(df: DataFrame, text: str) -> DataFrame:
    """Enemies with skill and stamina."""
    m = matches(df, flat(F.col(text)), STAT_BLOCK, ["enemy", "skill", "stamina"])
    return m.withColumn("enemy", F.trim("enemy")).withColumn("skill", F.col("skill").cast("int")).withColumn("stamina", F.col("stamina").cast("int"))


def stat_changes(df: DataFrame, text: str) -> DataFrame:
    """Signed changes of a stat; unknown amounts are left out."""
    m = matches(df, flat(F.col(text)), STAT_CHANGE, ["verb", "amount", "stat"])
    sign = F.when(F.lower("verb").isin("lose", "deduct"), -1).otherwise(1)
    return m.withColumn("amount", sign * word_number(F.col("amount"))).where("amount is not null").withColumn("stat", F.lower("stat")).drop("verb")


def item_checks(df: DataFrame, text: str) -> DataFrame:
    """Items that a text asks for."""
    return matches(df, flat(F.col(text)), ITEM_USE, ["item"]).withColumn("item", F.lower("item"))


def fight_style(text: Column) -> Column:
    """Kind of fight by cue words, the first that applies."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return (
        F.when(low.rlike("vehicle|chariot|carriage"), "vehicle").when(low.rlike("robot|golem|automaton"), "machine").when(low.rlike("shoot|arrow|crossbow|blaster"), "shooting").when(low.rlike("fist|wrestle|bare hands"), "hand").otherwise("standard")
    )


def event_list(df: DataFrame, key: str, sequence: str) -> DataFrame:
    """All targets of an event list with their path: choices, then both outcomes of fights and checks."""
    e = df.select(key, F.posexplode(sequence).alias("pos", "e"))
    parts = F.array(
        F.struct(F.lit("target").alias("path"), F.col("e.targetSection").alias("target")),
        F.struct(F.lit("outcomes.win").alias("path"), F.col("e.outcomes.win.targetSection").alias("target")),
        F.struct(F.lit("outcomes.lose").alias("path"), F.col("e.outcomes.lose.targetSection").alias("target")),
    )
    return e.select(key, "pos", F.col("e.kind").alias("kind"), F.explode(parts).alias("p")).select(key, "pos", "kind", "p.path", "p.target").where("target is not null and trim(target) <> ''")


def ordered_union(existing: Column, added: Column) -> Column:
    """Distinct entries of both arrays in order, the first of equal ones stays; blanks go."""
    both = F.concat(F.coalesce(existing, F.array().cast("array<string>")), F.coalesce(added, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(F.transform(both, lambda x: F.trim(x)), lambda x: x != ""))


def longer_lines(a: Column, b: Column) -> Column:
    """Line by line the longer of two readings, the first on ties."""
    return F.zip_with(a, b, lambda x, y: F.when(y.isNull(), x).when(x.isNull(), y).when(F.length(F.trim(y)) > F.length(F.trim(x)), y).otherwise(x))
