"""Parquet table access shared by all queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table of a data directory; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def distinct_rows(df: DataFrame, *key: str) -> DataFrame:
    """Delivered copies of a row (same key) collapse to one row.

    Copies are exact, so any of them may stay. Rows with a null key are kept
    once per distinct null key.
    """
    return df.dropDuplicates(list(key))
