"""Checks of section graphs and artifacts, and the repairs that patches make."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def condition(kind: Column, operator: Column, left: Column, right: Column) -> Column:
    """Run-time predicate of an event: items are held or missing, metrics compare; anything malformed is false."""
    return F.coalesce(
        F.when(kind == "item", F.when(operator == "has", F.array_contains(F.transform(left, lambda x: F.lower(x)), F.lower(right))).when(operator == "missing", ~F.array_contains(F.transform(left, lambda x: F.lower(x)), F.lower(right)))),
        F.lit(False),
    )


def compare(operator: Column, left: Column, right: Column) -> Column:
    """Numeric comparison by the operator's name; null or unknown gives false."""
    return F.coalesce(F.when(operator == "gt", left > right).when(operator == "gte", left >= right).when(operator == "lt", left < right).when(operator == "lte", left <= right).when(operator == "eq", left == right), F.lit(False))


def template_targets(df: DataFrame, template: str, states: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Targets with ``{state}`` in them, for every value that the state can take."""
    d = df.withColumn("__s", F.regexp_extract(template, "\\{([a-z_]+)\\}", 1)).where("__s <> ''")
    d = d.join(states.select(*keys, F.col("state").alias("__s"), F.col("value").alias("__v")), [*keys, "__s"])
    return d.withColumn(out, F.regexp_replace(F.col(template), F.lit("\\{[a-z_]+\\}"), F.col("__v").cast("string"))).drop("__s", "__v")


def apply_patches(sections: DataFrame, patches: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Patches of one column by key: ``replace`` and ``add`` set the value, ``remove`` drops the row; keys without row are added by ``add`` only. The latest patch of a key counts."""
    last = patches.groupBy(*keys).agg(F.max_by(F.struct("op", "value"), F.col("patch_no")).alias("p")).select(*keys, "p.*")
    j = sections.select(*keys, column).withColumn("__there", F.lit(True)).join(last, list(keys), "full_outer")
    j = j.where((F.coalesce("__there", F.lit(False)) & F.coalesce(F.col("op") != "remove", F.lit(True))) | (F.col("__there").isNull() & (F.col("op") == "add")))
    return j.select(*keys, F.when(F.col("op").isin("add", "replace"), F.col("value")).otherwise(F.col(column)).alias(column))


def suppress(warnings: DataFrame, patterns: DataFrame, text: str, pattern: str) -> DataFrame:
    """Warnings that no suppressed message equals."""
    return warnings.join(patterns.select(F.col(pattern).alias(text)).distinct(), text, "left_anti")


def status_band(share: Column) -> Column:
    return F.when(share == 0, "clean").when(share < 0.1, "minor").when(share < 0.3, "major").otherwise("critical")
