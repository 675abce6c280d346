"""Bundle sink: HTML pages as files with a manifest and the provenance of their blocks."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bundle(entries: DataFrame, provenance: DataFrame, folder: str, title: str) -> DataFrame:
    """Writes ``entries`` (entry_id, order, title, html) as ``pages/<entry_id>.html`` from the executors to a shared folder, provenance as JSON lines, and the manifest; gives the manifest rows.

    Entry ids must be plain names and orders 1, 2, ... without repeats.
    """
    bad = entries.where(~F.col("entry_id").rlike("^[A-Za-z0-9_-]+$") | (F.col("order") < 1)).limit(1).count()
    repeated = entries.groupBy("order").count().where("count > 1").limit(1).count()
    if bad or repeated:
        raise ValueError("entry ids must be plain names, orders positive and distinct")
    pages = Path(folder, "pages")
    pages.mkdir(parents=True, exist_ok=True)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                Path(folder, "pages", f"{r.entry_id}.html").write_text(r.html or "", encoding="utf-8")
            yield f[["entry_id", "order", "title"]].assign(path="pages/" + f["entry_id"] + ".html")

    written = entries.mapInPandas(write, "entry_id string, order int, title string, path string")
    written.write.mode("overwrite").json(f"{folder}/entries")
    provenance.write.mode("overwrite").json(f"{folder}/provenance")
    Path(folder, "manifest.json").write_text(json.dumps({"title": title, "entries": "entries", "provenance": "provenance"}, indent=2), encoding="utf-8")
    return entries.sparkSession.read.schema("entry_id string, order int, title string, path string").json(f"{folder}/entries")
