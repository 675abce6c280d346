"""Row selection, merges, anti-joins and range joins with exact tie rules.

Every ranking takes an explicit order that ends in a unique key, so results do not
depend on partitioning. Nulls never match a join key; missing rows give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under ``order``. A map-side ``min_by`` on the order tuple, so a hot key is pre-aggregated and never sorted in one task."""
    rank = F.struct(*[_sortable(c, i) for i, c in enumerate(order)])
    rest = F.struct(*[c for c in df.columns if c not in keys])
    return df.groupBy(*keys).agg(F.min_by(rest, rank).alias("r")).select(*keys, "r.*")


def _sortable(c: Column, i: int) -> Column:
    return c.alias(f"o{i}")


def first_per_key(parts: Sequence[DataFrame], key: Column, order: str, out: str = "source_no") -> DataFrame:
    """Ordered union of inputs in which the first row of a key wins; a blank key falls back to the whole row."""
    numbered = [p.withColumn(out, F.lit(i)) for i, p in enumerate(parts)]
    both = numbered[0]
    for p in numbered[1:]:
        both = both.unionByName(p)
    cols = [c for c in both.columns if c != out]
    whole = F.sha2(F.to_json(F.struct(*cols)), 256)
    both = both.withColumn("__k", F.coalesce(F.when(key != "", key), whole))
    return best_row(both, ["__k"], [F.col(out), F.col(order)]).drop("__k")


def overlay(base: DataFrame, patch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Full outer merge in which the patch's non-null values win."""
    right = patch.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = base.select(*keys, *columns).join(right, list(keys), "full_outer")
    return joined.select(*keys, *[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) for c in columns])


def unclaimed(links: DataFrame, claims: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct links without a claim of the same key."""
    return links.select(*keys).dropna().distinct().join(claims.select(*keys).distinct(), list(keys), "left_anti")


def missing_in_range(present: DataFrame, group: Sequence[str], number: str, low: int = 1) -> DataFrame:
    """Numbers from ``low`` to each group's maximum that do not occur. The range is bounded by the group's own numbers."""
    top = present.groupBy(*group).agg(F.max(number).alias("__top")).where(f"__top >= {low}")
    full = top.select(*group, F.explode(F.sequence(F.lit(low), F.col("__top").cast("int"))).alias(number))
    return full.join(present.select(*group, F.col(number).cast("int").alias(number)).distinct(), [*group, number], "left_anti")


def bracket(asked: DataFrame, known: DataFrame, group: Sequence[str], number: str, value: str) -> DataFrame:
    """Nearest known value below and above each asked number (as-of on both sides), by one sorted pass over the union."""
    both = asked.select(*group, number, F.lit(None).cast("int").alias(value), F.lit(1).alias("__asked"))
    both = both.unionByName(known.select(*group, F.col(number), F.col(value).cast("int").alias(value), F.lit(0).alias("__asked")))
    w = Window.partitionBy(*group).orderBy(number)
    below = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    above = F.first(value, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return both.select(*group, number, "__asked", below.alias("below"), above.alias("above")).where("__asked = 1").drop("__asked")


def pages_of_spans(spans: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """One row per page of a span; a span that ends before it starts has none. Turns a range join into an equi-join."""
    return spans.where(F.col(start) <= F.col(end)).withColumn(out, F.explode(F.sequence(start, end)))


def uncovered_share(coarse: DataFrame, fine: DataFrame, group: Sequence[str], key: str, start: str, end: str) -> DataFrame:
    """Share of each coarse span's pages that no fine span covers: group, key, ``uncovered``."""
    pages = pages_of_spans(coarse.select(*group, key, start, end), start, end, "__p")
    taken = pages_of_spans(fine.select(*group, start, end), start, end, "__p").select(*group, "__p").distinct().withColumn("__t", F.lit(1))
    joined = pages.join(taken, [*group, "__p"], "left")
    return joined.groupBy(*group, key).agg(F.round(F.avg(F.when(F.col("__t").isNull(), 1.0).otherwise(0.0)), 4).alias("uncovered"))


def merge_fine_coarse(fine: DataFrame, coarse: DataFrame, group: Sequence[str], key: str, start: str, end: str, threshold: float = 0.5) -> DataFrame:
    """All fine spans and those coarse spans of which enough pages are uncovered."""
    keep = uncovered_share(coarse, fine, group, key, start, end).where(F.col("uncovered") >= threshold).select(*group, key)
    cols = [*group, key, start, end]
    return fine.select(*cols, F.lit("fine").alias("origin")).unionByName(coarse.select(*cols, F.lit("coarse").alias("origin")).join(keep, [*group, key], "left_semi"))


def split_targets(refs: DataFrame, known: DataFrame, keys: Sequence[str], owner: Sequence[str]) -> DataFrame:
    """Hits and misses of each owner's references against the known keys."""
    marked = refs.join(known.select(*keys).distinct().withColumn("__hit", F.lit(1)), list(keys), "left")
    return marked.groupBy(*owner).agg(F.count("__hit").alias("hits"), (F.count("*") - F.count("__hit")).alias("misses"))


#: A key that holds this share of all rows is hot: there are at most as many such keys as its inverse.
HOT_SHARE = 0.001


def hot_join(many: DataFrame, one: DataFrame, on: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """Inner join of ``many`` with ``one`` (a few rows a key) in which no task gets all rows of a frequent key.

    The rows of a key with at least HOT_SHARE of all are cut into slices of that share by a hash of the whole row, and
    the key's rows of ``one`` are repeated for each slice; all other keys have one slice. Broadcast is only the list of hot
    keys, at most 1 / HOT_SHARE rows by arithmetic. ``counts``: keys and their number ``n`` in ``many``, where known.
    ``many`` is read twice, so it should be a table or checkpoint. Null keys meet nothing.
    """
    on = list(on)
    counts = many.groupBy(*on).agg(F.count("*").alias("n")) if counts is None else counts
    share = F.col("n") / F.col("__all")
    hot = counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("__all")))).where(share >= HOT_SHARE).select(*on, F.ceil(share / HOT_SHARE).cast("int").alias("__slices"))
    slices = F.coalesce("__slices", F.lit(1))
    left = many.join(F.broadcast(hot), on, "left").withColumn("__slice", F.pmod(F.xxhash64(*many.columns), slices).cast("int")).drop("__slices")
    right = one.join(F.broadcast(hot), on, "left").withColumn("__slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("__slices")
    return left.join(right, [*on, "__slice"]).drop("__slice")
