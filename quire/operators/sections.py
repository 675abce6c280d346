"""Sections as typed records: kinds, phases, event lists and checks made from their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.extract import flat, word_number
from quire.operators.references import section_key

DICE = "(?i)roll[ ]+([0-9]+|[a-z]+)(?:d6|[ ]+dice)([+-][0-9]+)?"


def section_kind(section: Column, given: Column, text: Column) -> Column:
    """Kind of a section: the given one, else by id, else by its text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(
        F.when(F.trim(given) != "", F.lower(F.trim(given))),
        F.when(section == "background", "background"),
        F.when(section.rlike("^[0-9]+$"), "section"),
        F.when(low.rlike("^(rules|how to|equipment|hints)"), "rules"),
        F.when(low.rlike("(publish|copyright|isbn)"), "front_matter"),
        F.lit("text"),
    )


def phases(df: DataFrame, keys: list[str], order: str, background: Column, choice: Column) -> DataFrame:
    """Phase of each row by the entity's pivots: from its background row on, else from its first row with a choice, the game; before, the front matter.

    The pivots are two map-side minima per entity and no state is carried from row to row.
    """
    pivots = df.groupBy(*keys).agg(F.min(F.when(background, F.col(order))).alias("__b"), F.min(F.when(choice, F.col(order))).alias("__c"))
    start = F.coalesce("__b", "__c")
    return df.join(pivots, keys).withColumn("phase", F.when(start.isNull(), "unknown").when(F.col(order) >= start, "game").otherwise("front")).drop("__b", "__c")


def dice_checks(df: DataFrame, text: str) -> DataFrame:
    """Dice rolls of a text: place, number of dice, what is added."""
    t = flat(F.col(text))
    zipped = F.arrays_zip(F.regexp_extract_all(t, F.lit(DICE), F.lit(1)).alias("n"), F.regexp_extract_all(t, F.lit(DICE), F.lit(2)).alias("plus"))
    d = df.select(*df.columns, F.posexplode(zipped).alias("place", "m"))
    dice = F.when(F.col("m.n").rlike("^[0-9]+$"), F.col("m.n").try_cast("int")).otherwise(word_number(F.col("m.n")))
    return d.select(*df.columns, "place", dice.alias("dice"), F.coalesce(F.when(F.col("m.plus") != "", F.col("m.plus").cast("int")), F.lit(0)).alias("plus"))


def event_list(df: DataFrame, key: str) -> DataFrame:
    """One ordered event list per portion: choices, stat checks, items gained and lost, fights; key, pos, kind, detail."""
    parts = [
        F.transform(F.filter(F.coalesce("choices", F.array().cast("array<struct<target:string,text:string>>")), lambda c: c.isNotNull() & c.target.isNotNull()), lambda c: F.struct(F.lit("choice").alias("kind"), section_key(c.target).alias("detail"))),
        F.transform(F.filter(F.coalesce("stat_checks", F.array().cast("array<struct<stat:string,pass_section:string,fail_section:string>>")), lambda c: c.isNotNull()), lambda c: F.struct(F.lit("stat_check").alias("kind"), c.stat.alias("detail"))),
        F.transform(F.filter(F.coalesce("inventory.items_gained", F.array().cast("array<string>")), lambda c: c.isNotNull()), lambda c: F.struct(F.lit("gain").alias("kind"), c.alias("detail"))),
        F.transform(F.filter(F.coalesce("inventory.items_lost", F.array().cast("array<string>")), lambda c: c.isNotNull()), lambda c: F.struct(F.lit("loss").alias("kind"), c.alias("detail"))),
        F.transform(F.filter(F.coalesce("combat.enemies", F.array().cast("array<array<struct<enemy:string,skill:int,stamina:int,armour:int,firepower:int,speed:string>>>")), lambda c: F.size(c) > 0), lambda c: F.struct(F.lit("combat").alias("kind"), F.array_join(F.transform(c, lambda e: F.coalesce(e.enemy, F.lit("?"))), ",").alias("detail"))),
    ]
    return df.select(key, F.posexplode(F.concat(*parts)).alias("pos", "e")).select(key, "pos", "e.kind", "e.detail")


def longest_names(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Names that are not the tail of a longer name of the same key ("key" goes where "brass key" is). Candidates meet on their last word only."""
    d = df.select(*keys, F.lower(F.trim(name)).alias(name)).distinct().withColumn("__tail", F.regexp_extract(name, "([^ ]+)$", 1))
    longest = d.groupBy(*keys, "__tail").agg(F.max(F.length(name)).alias("__n"))
    one_word = ~F.col(name).contains(" ")
    return d.join(longest, [*keys, "__tail"]).where(~(one_word & (F.col("__n") > F.length(name)))).select(*keys, name)


def expected_range(count: Column, provenance: Column, default: int = 400) -> tuple[Column, Column]:
    """(low, high) of section numbers: from a count, else from text such as 1-350, else 1 to ``default``; bad ranges fall back."""
    low = F.regexp_extract(provenance, "([0-9]+)[ ]*[-–][ ]*([0-9]+)", 1).try_cast("int")
    high = F.regexp_extract(provenance, "([0-9]+)[ ]*[-–][ ]*([0-9]+)", 2).try_cast("int")
    good = (low >= 1) & (high >= low)
    return F.when(count > 0, F.lit(1)).when(good, low).otherwise(F.lit(1)), F.when(count > 0, count).when(good, high).otherwise(F.lit(default))


def flushed_lines(df: DataFrame, keys: list[str], order: str, text: str, least: int = 30) -> DataFrame:
    """Lines grouped to paragraphs: a new one after a short or closed line and at a number line."""
    w = Window.partitionBy(*keys).orderBy(order)
    prev = F.lag(text).over(w)
    number = F.col(text).rlike("^[ ]*[0-9]{1,3}[ ]*$")
    fresh = prev.isNull() | number | prev.rlike("^[ ]*[0-9]{1,3}[ ]*$") | ((F.length(prev) < least) & prev.rlike("[.!?\"]$"))
    d = df.withColumn("__f", fresh.cast("int")).withColumn("paragraph", F.sum("__f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text])
    return d.groupBy(*keys, "paragraph").agg(F.count("*").alias("lines"), F.array_join(lines, " ").alias(text))
