"""Cost roll-ups, rankings, similarity of boxes and tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usage_cost(usage: DataFrame, prices: DataFrame, model: str, default_in: float, default_out: float) -> DataFrame:
    """Cost of each usage row: tokens by the model's rates per 1,000, default rates for unknown models."""
    d = usage.join(prices, model, "left")
    rate_in, rate_out = F.coalesce("rate_in", F.lit(default_in)), F.coalesce("rate_out", F.lit(default_out))
    return d.withColumn("cost", F.round((F.col("tokens_in") * rate_in + F.col("tokens_out") * rate_out) / 1000, 6)).drop("rate_in", "rate_out")


def _skyline(high: str, low: Sequence[str]):
    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values([high, *low], ascending=[False, *[True] * len(low)])
        points = np.column_stack([-f[high].to_numpy(float), *[f[c].to_numpy(float) for c in low]])
        front: list[np.ndarray] = []
        keep = []
        for p in points:  # only a row that sorts before can dominate
            block = np.array(front) if front else np.empty((0, points.shape[1]))
            beaten = bool(len(block)) and bool(((block <= p).all(axis=1) & (block < p).any(axis=1)).any())
            keep.append(not beaten)
            if not beaten:
                front.append(p)
        return f[np.array(keep, dtype=bool)] if len(f) else f

    return run


def pareto_front(df: DataFrame, key: str, high: str, low: Sequence[str], buckets: int = 64) -> DataFrame:
    """Rows that no other row dominates: at least as good everywhere and better somewhere.

    Rows without positive ``low`` values neither dominate nor are dominated. Skylines of hashed
    buckets are merged eight by eight, so only rows of the front come to the last task.
    """
    positive = F.lit(True)
    for c in low:
        positive = positive & F.coalesce(F.col(c) > 0, F.lit(False))
    run = _skyline(high, low)
    slim = df.where(positive).select(key, high, *low)
    local = slim.withColumn("__b", F.pmod(F.xxhash64(key), F.lit(buckets)))
    while True:
        local = local.groupBy("__b").applyInPandas(run, local.schema)
        if buckets == 1:
            break
        buckets = -(-buckets // 8)
        local = local.withColumn("__b", F.pmod("__b", F.lit(buckets)))
    front = local.select(key)
    return df.join(front.unionByName(df.where(~positive).select(key)), key, "left_semi")


def three_part_score(quality: Column, latency: Column, cost: Column, fastest: Column, cheapest: Column) -> Column:
    return F.round(0.60 * quality + 0.25 * fastest / latency + 0.15 * cheapest / cost, 4)


def iou(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Intersection over union of boxes (x0, y0, x1, y1); 0 if both are empty."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    area = lambda x: F.greatest(F.lit(0.0), x[2] - x[0]) * F.greatest(F.lit(0.0), x[3] - x[1])
    union = area(a) + area(b) - w * h
    return F.when(union > 0, F.round(w * h / union, 6)).otherwise(0.0)


def drift_score(residual: Column, external: Column, tables: Column, pages: Column, subgroups: Column) -> Column:
    """Chapter drift: weighted rule score."""
    return (
        F.when(residual >= 3, 35).when(residual >= 1, 25).otherwise(0)
        + F.when(external > 0, 25).otherwise(0)
        + F.when((tables >= 5) & (tables >= 1.25 * F.greatest(pages, F.lit(1))), 20).otherwise(0)
        + F.when((tables >= 3) & (subgroups == 0), 20).otherwise(0)
    )
