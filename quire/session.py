"""Session helpers: checkpoints in the shared folder that the cluster names."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses ``spark.checkpoint.dir`` of the session. Only a local session, as in tests, may leave it unset and gets a temporary folder:
    on a cluster the executors could not read the driver's."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="quire-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """The frame as files in the checkpoint folder: computed once, its lineage cut, safe against lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
