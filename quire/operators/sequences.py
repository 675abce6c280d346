"""Window and sequence operators over pages, sections and events, partitioned by run or entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(keys: Sequence[str], *order: str | Column):
    return Window.partitionBy(*keys).orderBy(*order)


def next_value(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, out: str) -> DataFrame:
    """The following row's value in document order."""
    return df.withColumn(out, F.lead(value).over(ordered(keys, *order)))


def lag_in_slices(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, width: int = 65_536) -> DataFrame:
    """The previous row's value by a whole number ``order`` (unique per key), where a key may hold a large share of all rows.

    A key is cut into slices of ``width`` numbers; inside a slice it is a plain window, and the first row of a slice gets the
    last value of the slice before it that has any, from one row per slice.
    """
    keys = list(keys)
    d = df.withColumn("__slice", F.floor(F.col(order) / width))
    last = d.groupBy(*keys, "__slice").agg(F.max_by(F.struct(F.col(value).alias("v")), order).alias("__last"))
    carried = last.select(*keys, "__slice", F.lag("__last").over(ordered(keys, "__slice")).alias("__carried"))
    w = ordered([*keys, "__slice"], order)
    inside = d.withColumn("__own", F.lag(F.struct(F.col(value).alias("v"))).over(w))
    first = inside.where("__own is null").join(carried, [*keys, "__slice"]).withColumn("__own", F.col("__carried")).drop("__carried")
    both = inside.where("__own is not null").unionByName(first)
    return both.withColumn(out, F.col("__own.v")).drop("__own", "__slice")


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], starts: Column, out: str) -> DataFrame:
    """Numbers runs of rows: a new run begins where ``starts`` is true (or null, as at the first row)."""
    w = ordered(keys, *order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("__new", F.coalesce(starts.cast("int"), F.lit(1))).withColumn(out, F.sum("__new").over(w)).drop("__new")


def header_scores(df: DataFrame, keys: Sequence[str], order: Sequence[str], is_header: Column, length: Column, cap: int = 200) -> DataFrame:
    """Per header the body text up to the next one: sum of ``least(cap, length)``, and its number of body rows."""
    w = ordered(keys, *order).rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("__h", is_header).withColumn("header_no", F.sum(F.col("__h").cast("int")).over(w))
    body = F.when(~F.col("__h"), F.least(F.lit(cap), length))
    return d.where("header_no > 0").groupBy(*keys, "header_no").agg(F.coalesce(F.sum(body), F.lit(0)).cast("long").alias("score"), F.count(body).alias("body_rows"))


def earliest_near_best(df: DataFrame, keys: Sequence[str], score: str, order: Sequence[str], slack: float = 50) -> DataFrame:
    """The earliest row of each key whose score is within ``slack`` of the key's best (not the best itself)."""
    top = df.groupBy(*keys).agg(F.max(score).alias("__top"))
    near = df.join(top, list(keys)).where(F.col(score) >= F.col("__top") - slack).drop("__top")
    rest = F.struct(*[c for c in near.columns if c not in keys])
    return near.groupBy(*keys).agg(F.min_by(rest, F.struct(*order)).alias("r")).select(*keys, "r.*")


def fill_page_numbers(df: DataFrame, keys: Sequence[str], page: str, number: str, out: str) -> DataFrame:
    """Missing printed numbers: interior gaps only if perfectly sequential, backfill down to 1, forward fill.

    Positions in page order count, not page numbers.
    """
    w = ordered(keys, page)
    d = df.withColumn("__i", F.row_number().over(w))
    known = F.when(F.col(number).isNotNull(), F.struct(F.col("__i").alias("i"), F.col(number).alias("n")))
    before = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    d = d.withColumn("__b", before).withColumn("__a", after)
    forward = F.col("__b.n") + F.col("__i") - F.col("__b.i")
    backward = F.col("__a.n") - (F.col("__a.i") - F.col("__i"))
    even = (F.col("__a.n") - F.col("__b.n")) == (F.col("__a.i") - F.col("__b.i"))
    value = (
        F.when(F.col(number).isNotNull(), F.col(number))
        .when(F.col("__b").isNotNull() & F.col("__a").isNotNull(), F.when(even, forward))
        .when(F.col("__b").isNotNull(), forward)
        .when(F.col("__a").isNotNull() & (backward >= 1), backward)
    )
    return d.withColumn(out, value.cast("int")).drop("__i", "__b", "__a")


def decreases(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str) -> DataFrame:
    """Rows whose value is below the previous one in document order, with that value as ``previous``."""
    return df.withColumn("previous", F.lag(value).over(ordered(keys, *order))).where(F.col(value) < F.col("previous"))


def run_lengths(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Distinct numbers per key with the length of their run of consecutive neighbours."""
    d = df.select(*keys, number).distinct().withColumn("__g", F.col(number) - F.row_number().over(ordered(keys, number)))
    return d.withColumn("run_length", F.count("*").over(Window.partitionBy(*keys, "__g"))).drop("__g")


def sliding_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, stride: int) -> DataFrame:
    """Windows of ``size`` rows every ``stride`` rows; short tail windows stay. Each row is sent to its own windows only."""
    d = df.withColumn("__i", F.row_number().over(ordered(keys, *order)) - 1)
    first = F.greatest(F.lit(0), F.ceil((F.col("__i") - F.lit(size - 1)) / F.lit(stride))).cast("int")
    last = F.floor(F.col("__i") / F.lit(stride)).cast("int")
    return d.where(first <= last).withColumn("window_no", F.explode(F.sequence(first, last))).drop("__i")


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key, with their ``rank``."""
    return df.withColumn("rank", F.row_number().over(ordered(keys, *order))).where(F.col("rank") <= n)


def round_robin(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Place in an order that takes one row of each key in turn."""
    d = df.withColumn("__rn", F.row_number().over(ordered(keys, *order)))
    return d.withColumn(out, F.col("__rn")).drop("__rn")


def token_set(c: Column) -> Column:
    """Distinct lower-case alphanumeric tokens."""
    return F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two token arrays, 0 where either is empty."""
    n = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / n)


def continuation_links(df: DataFrame, keys: Sequence[str], order: Sequence[str], title: str, start: str, end: str, confidence: str, gap: int = 1, least: float = 0.55) -> DataFrame:
    """Links of adjacent spans: 0.5 for title likeness, 0.3 for touching pages, 0.2 for mean confidence."""
    w = ordered(keys, *order)
    prev = F.lag(F.struct(title, F.col(end).alias("e"), F.col(confidence).alias("c"), *[c for c in df.columns if c.endswith("_key")])).over(w)
    d = df.withColumn("__p", prev).where("__p is not null")
    score = 0.5 * jaccard(token_set(F.col(title)), token_set(F.col(f"__p.{title}"))) + F.when(F.col(start) - F.col("__p.e") <= gap, 0.3).otherwise(0.0)
    score = F.round(score + 0.2 * (F.col(confidence) + F.col("__p.c")) / 2, 6)
    return d.withColumn("score", score).where(F.col("score") >= least)
