"""Artifact sources and sinks: JSON lines, single documents, text files, image folders, index files.

A blank line of a JSON-lines file is no row; a broken line is a row whose ``_corrupt``
column holds it when the schema has that column. Writing is by Spark, in parallel.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = ("schema_version", "module_id", "run_id", "source", "created_at")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Lines of JSON; with a schema no inference pass runs."""
    r = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    return (r.schema(schema) if schema else r).json(path)


def read_artifact(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """``.json`` holds one document or an array of rows, anything else is JSON lines."""
    if path.endswith(".json"):
        r = spark.read.option("multiLine", True)
        return (r.schema(schema) if schema else r).json(path)
    return read_jsonl(spark, path, schema)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_document(doc: dict, path: str) -> None:
    """A single JSON document of the driver, indented."""
    Path(path).write_text(json.dumps(doc, indent=2, ensure_ascii=False), encoding="utf-8")


def stamp(df: DataFrame, schema_version: str, module_id: str | None = None, run_id: str | None = None) -> DataFrame:
    """Envelope columns filled where missing; rows with an ``error`` are dropped."""
    if "error" in df.columns:
        df = df.where(F.col("error").isNull()).drop("error")
    fill = {"schema_version": schema_version, "module_id": module_id, "run_id": run_id}
    for name, value in fill.items():
        have = F.col(name) if name in df.columns else F.lit(None).cast("string")
        df = df.withColumn(name, F.coalesce(have, F.lit(value)))
    return df


def conform(df: DataFrame, schema: T.StructType, checks: dict[str, Column] | None = None) -> DataFrame:
    """Projection to a schema: unknown columns go, missing ones are null, rows that break a check go."""
    out = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    for check in (checks or {}).values():
        out = out.where(F.coalesce(check, F.lit(False)))
    return out


def read_texts(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """One row per text file: path, text."""
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def by_key(keys: Sequence[str], order: Sequence[Column]):
    """Window over ``keys`` in an order."""
    from pyspark.sql import Window

    return Window.partitionBy(*keys).orderBy(*order)


def natural_key(name: Column) -> Column:
    """Sort key by the numbers in a name."""
    return F.transform(F.regexp_extract_all(name, F.lit("([0-9]+)"), F.lit(1)), lambda x: x.cast("long"))


def image_manifest(spark: SparkSession, folder: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Images of a folder in natural order: page, image. File contents are not read."""
    from pyspark.sql import Window

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    files = files.where(F.lower("path").rlike("\\.(png|jpe?g|tiff?|webp)$"))
    # The listing of one folder: the order is one book's pages.
    rows = files.withColumn("page", F.row_number().over(Window.partitionBy(F.regexp_extract("path", "^(.*)/", 1)).orderBy(natural_key(F.regexp_extract("path", "([^/]+)$", 1)), "path")))
    if start is not None:
        rows = rows.where(F.col("page") >= start)
    if end is not None:
        rows = rows.where(F.col("page") <= end)
    return rows.select("page", F.col("path").alias("image"), "length")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of page key to file path as rows: page, path."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return doc.select(F.explode("m").alias("page", "path"))


def batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """Fixed-size batches in order: ``batch`` number per key."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("batch", F.floor(n / F.lit(size)).cast("int"))


def upsert_latest(log: DataFrame, key: str, at: str) -> DataFrame:
    """Latest entry per key of an append-only manifest."""
    rest = F.struct(*[c for c in log.columns if c != key])
    return log.groupBy(key).agg(F.max_by(rest, F.col(at)).alias("r")).select(key, "r.*")
