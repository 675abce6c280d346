"""Event log: streaming source, keyed state, usage totals, incremental cache.

The folded state of a key is its latest event; a warning does not replace a finished
status. The batch fold and the stream give the same rows for the same events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import cut

EVENT = "timestamp timestamp, run_id string, stage string, status string, current int, total int, message string, module_id string"
STATUSES = ("queued", "running", "done", "failed", "skipped", "warning")
FINISHED = ("done", "failed", "skipped")


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """New event files of a folder as a stream."""
    return spark.readStream.schema(EVENT).json(folder)


def valid(events: DataFrame) -> DataFrame:
    """Events with a known status and a stage."""
    return events.where(F.col("status").isin(*STATUSES) & F.col("stage").isNotNull() & F.col("run_id").isNotNull())


def fold(events: DataFrame) -> DataFrame:
    """State per run and stage: status, counts and message of the latest event.

    A warning alone means running; after a finished status it leaves that status.
    Works on batches and, in complete or update mode, on streams: it is one
    aggregation with map-side combine, so state is one row per run and stage.
    """
    at = F.struct("timestamp", F.coalesce("message", F.lit("")))
    not_warning = F.when(F.col("status") != "warning", F.struct("timestamp", "status"))
    return (
        valid(events)
        .groupBy("run_id", "stage")
        .agg(F.max(not_warning).alias("s"), F.max(F.struct(at.alias("at"), "current", "total", "message")).alias("l"), F.count("*").alias("events"))
        .select("run_id", "stage", F.coalesce("s.status", F.lit("running")).alias("status"), "l.current", "l.total", "l.message", "events")
    )


def usage_totals(usage: DataFrame, window: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Running token totals per model and time window; ``usage`` has timestamp, model, prompt_tokens, completion_tokens."""
    w = usage.withWatermark("timestamp", late) if usage.isStreaming else usage
    return (
        w.groupBy(F.window("timestamp", window).alias("w"), "model")
        .agg(F.count("*").alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"))
        .select(F.col("w.start").alias("window_start"), "model", "calls", "prompt_tokens", "completion_tokens")
    )


def write_state(stream: DataFrame, folder: str, checkpoint: str, keys: tuple[str, ...] = ("run_id", "stage"), buckets: int = 64):
    """The folded state of a stream to a Parquet folder of hash buckets of the keys (column ``bucket``).

    Update mode: a batch holds the keys that changed, and only their buckets are written anew, so a batch costs what it
    changes and not what there has been. A batch that is repeated after a failure gives the same files.
    """

    def put(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = cut(batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            old = spark.read.schema(new.schema).parquet(folder).where(F.col("bucket").isin(touched))
            new = cut(old.join(new.select(*keys), list(keys), "left_anti").unionByName(new))
        new.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(folder)

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put)


def cached(asked: DataFrame, cache: DataFrame, key: str, compute) -> tuple[DataFrame, DataFrame]:
    """(all results, new results): only keys that the cache lacks are computed."""
    new = compute(asked.join(cache.select(key).distinct(), key, "left_anti"))
    return cache.join(asked.select(key).distinct(), key, "left_semi").unionByName(new), new


def reuse_advice(health: DataFrame, assessments: DataFrame, key: str) -> DataFrame:
    """Whether to reuse a run: by its health and its latest assessment."""
    d = health.join(assessments, key, "left")
    return d.withColumn(
        "advice",
        F.when(F.col("assessment") == "bad", "rebuild").when(F.col("status") == "broken", "rebuild").when(F.col("assessment").isNull(), "review").when(F.col("status") == "healthy", "reuse").otherwise("patch"),
    )
