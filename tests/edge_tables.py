"""Copies of the smallest data folder: emptied, or with clashing extra columns, null rows and repeated rows."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

SOURCE = Path("/root/testdata/sf0.001")
CLASH = "kind value n lo hi d sh isle fresh c v e p raw form base word a b stored noise edges place count size piece container votes units chars l r alive refs at delta pos1 pos2 child".split()


def emptied(spark, folder: Path) -> str:
    for f in SOURCE.glob("*.parquet"):
        spark.read.parquet(str(f)).limit(0).write.parquet(str(folder / f.name))
    return str(folder)


def messy(spark, folder: Path) -> str:
    """Every table with extra columns, a row of nulls and every row of it twice."""
    for f in SOURCE.glob("*.parquet"):
        t = spark.read.parquet(str(f))
        nothing = spark.createDataFrame([tuple(None for _ in t.columns)], t.schema)
        if f.stem not in ("word_list", "books"):
            t = t.unionByName(t).unionByName(nothing)
        for c in CLASH:
            if c not in t.columns:
                t = t.withColumn(c, F.lit(f"x-{c}"))
        t.write.parquet(str(folder / f.name))
    return str(folder)
