"""Choices out of text and markup, with a confidence per kind of evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as tx

# Evidence for a choice, its pattern with the target as group 1, and its confidence.
EVIDENCE = (
    ("anchor", "<a[^>]*href=[\"']#([0-9]+)[\"']", 1.0),
    ("turn_to", "(?i)turn[ ]+to[ ]+(?:section[ ]+|page[ ]+)?([0-9]{1,4})", 0.95),
    ("go_to", "(?i)go[ ]+to[ ]+(?:section[ ]+)?([0-9]{1,4})", 0.9),
    ("refer_to", "(?i)refer[ ]+to[ ]+([0-9]{1,4})", 0.85),
    ("lies_weiter", "(?i)lies[ ]+weiter[ ]+bei[ ]+([0-9]{1,4})", 0.95),
    ("rendez_vous", "(?i)rendez-vous[ ]+au[ ]+([0-9]{1,4})", 0.95),
    ("pasa_al", "(?i)pasa[ ]+al[ ]+([0-9]{1,4})", 0.95),
)


def candidates(df: DataFrame, key: str, markup: str, low: int = 1, high: int = 400) -> DataFrame:
    """key, target, evidence, confidence: every match; patterns read the text between the tags, anchors are not bounded."""
    flat = tx.strip_tags(F.col(markup))
    parts = [_found(markup, flat, name, p, c) for name, p, c in EVIDENCE]
    d = df.select(key, F.explode(F.flatten(F.array(*parts))).alias("x")).select(key, "x.*")
    return d.where((F.col("evidence") == "anchor") | F.col("target").between(low, high))


def _found(markup: str, flat, name: str, pattern: str, confidence: float):
    source = F.col(markup) if name == "anchor" else flat
    hits = F.regexp_extract_all(source, F.lit(pattern), F.lit(1))
    return F.transform(hits, lambda x: F.struct(x.cast("int").alias("target"), F.lit(name).alias("evidence"), F.lit(confidence).alias("confidence")))


def best(df: DataFrame, key: str) -> DataFrame:
    """Most confident evidence of each target of a text, the first kind on ties."""
    order = F.array_position(F.array(*[F.lit(e[0]) for e in EVIDENCE]), F.col("evidence"))
    return df.groupBy(key, "target").agg(F.min_by("evidence", F.struct(-F.col("confidence"), order)).alias("evidence"), F.max("confidence").alias("confidence"))


def near_anchor(df: DataFrame, group: list[str], target: str, anchor: str) -> DataFrame:
    """Targets one digit away from an anchor of the same text: substituted, missing or extra."""
    return df.where((F.col(target) != F.col(anchor)) & (F.levenshtein(F.col(target).cast("string"), F.col(anchor).cast("string")) <= 1)).select(*group, target, anchor).distinct()
