"""Section graphs: references, orphans, broken links, reachability, digit confusions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut

# Digits that scanners take for each other.
DIGIT_CONFUSIONS = {"0": "9", "9": "0", "6": "8", "8": "63", "3": "8", "1": "7", "7": "1", "5": "6", "2": "7"}


def incoming(edges: DataFrame, group: Sequence[str], src: str, dst: str) -> DataFrame:
    """In-degree and number of distinct sources of each target."""
    per = edges.groupBy(*group, dst, src).agg(F.count("*").alias("__n"))
    return per.groupBy(*group, dst).agg(F.sum("__n").alias("references"), F.count("*").alias("sources"))


def orphans(nodes: DataFrame, edges: DataFrame, group: Sequence[str], node: str, dst: str, exempt: Sequence[str]) -> DataFrame:
    """Nodes that nothing refers to, except the exempt ones."""
    targets = edges.select(*group, F.col(dst).alias(node)).distinct()
    return nodes.select(*group, node).distinct().join(targets, [*group, node], "left_anti").where(~F.col(node).isin(list(exempt)))


def broken(nodes: DataFrame, edges: DataFrame, group: Sequence[str], node: str, dst: str) -> DataFrame:
    """Targets that are no node, numbers only."""
    targets = edges.select(*group, F.col(dst).alias(node)).distinct().where(F.col(node).rlike("^[0-9]+$"))
    return targets.join(nodes.select(*group, node).distinct(), [*group, node], "left_anti")


def reachable(edges: DataFrame, starts: DataFrame, group: Sequence[str], src: str, dst: str, node: str, depth: int | None = 20) -> DataFrame:
    """Breadth-first search: group, ``node`` and its ``depth``, up to ``depth`` steps (None: as far as it goes).

    One equi-join per level against the frontier only; each level is a checkpoint, so
    plans stay short, and the loop ends at the first empty frontier.
    """
    edges = cut(edges.select(*group, src, dst).dropna().distinct())
    frontier = starts.select(*group, node).distinct().withColumn("depth", F.lit(0))
    seen = cut(frontier)
    frontier = seen
    for level in count(1) if depth is None else range(1, depth + 1):
        step = frontier.join(edges.withColumnRenamed(src, node), [*group, node]).select(*group, F.col(dst).alias(node)).distinct()
        frontier = cut(step.join(seen.select(*group, node), [*group, node], "left_anti").withColumn("depth", F.lit(level)))
        if frontier.isEmpty():
            break
        seen = cut(seen.unionByName(frontier))
    return seen


def digit_confusions(df: DataFrame, number: str, out: str) -> DataFrame:
    """Numbers that differ from ``number`` (text) by one confusable digit; no leading zero."""
    table = F.create_map(*[x for k, v in DIGIT_CONFUSIONS.items() for x in (F.lit(k), F.split(F.lit(v), ""))])
    d = df.withColumn("__i", F.explode(F.sequence(F.lit(1), F.length(number))))
    d = d.withColumn("__c", F.explode(table[F.expr(f"substring({number}, __i, 1)")]))
    made = F.expr(f"concat(substring({number}, 1, __i - 1), __c, substring({number}, __i + 1))")
    return d.withColumn(out, made).where(~F.col(out).startswith("0")).drop("__i", "__c").distinct()
