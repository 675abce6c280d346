"""Engine sources: files of a folder through a pluggable reader (OCR, PDF, layout), as typed rows.

Readers are plain callables on a batch of (path, content); none is bundled. File bytes
stay in the reader's batches and never enter query tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.functions.hooks import Hook, call_model

PAGE_LINES = "path string, page int, line_no int, text string, confidence double"


def read_with_engine(spark: SparkSession, folder: str, reader: Hook, schema: str = PAGE_LINES, glob: str = "*") -> DataFrame:
    """Rows that a reader makes of the files of a folder; a retry on no rows, the result is kept by checkpoint."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder).select("path", "content")
    return call_model(files, reader, schema)
