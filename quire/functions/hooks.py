"""Model hook: a pluggable callable on batches of rows, kept out of the plan's optimiser.

The hook is called once per Arrow batch; its result is written before it is used again,
because a retry or a re-plan would call the model twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from quire.session import cut

Hook = Callable[[pd.DataFrame], pd.DataFrame]


def call_model(df: DataFrame, hook: Hook, schema: str, retries: int = 1) -> DataFrame:
    """Rows through a hook, with a number of retries per batch where the hook returns no rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = hook(frame)
            for _ in range(retries):
                if len(out) or not len(frame):
                    break
                out = hook(frame)
            yield out

    return cut(df.mapInPandas(run, schema))


def audit(rows: DataFrame, verdicts: DataFrame, key: str, column: str) -> DataFrame:
    """A model's verdicts on rows: ``remove`` drops, ``correct`` replaces ``column``, anything else keeps."""
    from pyspark.sql import functions as F

    d = rows.join(verdicts.select(key, "verdict", "corrected"), key, "left")
    d = d.where(F.col("verdict").isNull() | (F.col("verdict") != "remove"))
    return d.withColumn(column, F.when(F.col("verdict") == "correct", F.col("corrected")).otherwise(F.col(column))).drop("verdict", "corrected")
