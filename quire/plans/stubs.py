"""Stub stages: the columns and shapes of a pipeline without its models, for dry runs of a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean(pages: DataFrame) -> DataFrame:
    """Pages whose clean text is their text; null text is empty."""
    text = F.coalesce("text", F.lit(""))
    return pages.withColumn("raw_text", text).withColumn("clean_text", text).withColumn("confidence", F.lit(1.0)).drop("text")


def _id(page: str):
    # Three digits at least; longer numbers keep all of theirs.
    return F.concat(F.lit("P"), F.lpad(F.col(page).cast("string"), F.greatest(F.lit(3), F.length(F.col(page).cast("string"))), "0"))


def portions(pages: DataFrame) -> DataFrame:
    """One portion per page."""
    return pages.select("run_id", _id("page").alias("portion_id"), F.col("page").alias("page_start"), F.col("page").alias("page_end"), F.lit("page").alias("type"), F.lit(1.0).alias("confidence"))


def locked(portions_: DataFrame) -> DataFrame:
    """Portions as agreed on: a missing id is made from the first page, a missing confidence is 1."""
    return portions_.withColumn("portion_id", F.coalesce("portion_id", _id("page_start"))).withColumn("confidence", F.coalesce("confidence", F.lit(1.0)))
