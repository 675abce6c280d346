"""Document queries: sources and sinks, plan runs, boxes."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import stateful as st
from quire.plans import runner, stubs
from quire.plans.reference import _latest_pages, _portions
from quire.session import ensure_checkpoint_dir
from quire.sources import io
from quire.sources.tables import table

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def scratch(spark) -> str:
    """A new folder beside the checkpoints, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid4()}"


@query
def json_lines_round_trip(spark, d):
    """Raw records written as JSON lines, in two parts, and read again by a schema."""
    rows = table(spark, d, "raw_portions").select("raw_key", "run_id", "record").dropDuplicates(["raw_key"])
    at = scratch(spark)
    io.write_jsonl(rows.where("raw_key % 2 = 0"), at)
    io.write_jsonl(rows.where("raw_key % 2 = 1"), at, append=True)
    return io.read_jsonl(spark, at, rows.schema)


@query
def image_order(spark, d):
    """Images of a run in natural order of the numbers in their names."""
    p = table(spark, d, "pages_html").where("image is not null").select("run_id", "image").distinct()
    w = io.natural_key(F.col("image"))
    return p.withColumn("place", F.row_number().over(io.by_key(["run_id"], [w, F.col("image")]))).select("run_id", "image", "place")


@query
def element_batches(spark, d):
    """Elements of a run in batches of 25, in reading order."""
    e = table(spark, d, "elements_core_content_types_rubric_v1").select("element_key", "run_id", "seq").dropDuplicates(["element_key"])
    b = io.batches(e, ["run_id"], ["seq", "element_key"], 25)
    return b.groupBy("run_id", "batch").agg(F.count("*").alias("elements"), F.min("seq").alias("first"), F.max("seq").alias("last"))


@query
def latest_reports(spark, d):
    """The latest report of every run."""
    r = table(spark, d, "pipeline_issues").select("run_id", "report_key", "module_id", "schema_version").distinct()
    return io.upsert_latest(r, "run_id", "report_key")


@query
def conformed_portions(spark, d):
    """Portions brought to a schema: other columns go, missing ones are null, rows that fail a check go."""
    schema = T.StructType([T.StructField("portion_key", T.LongType()), T.StructField("section_id", T.StringType()), T.StructField("page_start", T.LongType()), T.StructField("confidence", T.DoubleType()), T.StructField("title", T.StringType())])
    return io.conform(_portions(spark, d), schema, {"confidence": F.col("confidence") >= 0.5, "page": F.col("page_start") > 0})


@query
def stamped_portions(spark, d):
    """Portions with their envelope filled where it is missing."""
    p = table(spark, d, "enriched_portions").select("portion_key", "schema_version", "module_id", "run_id").dropDuplicates(["portion_key"])
    return io.stamp(p, "enriched_portion_v1", "portionize_v1", "run-unknown")


REGISTRY = {
    "filter": runner.Module(lambda x, p: next(iter(x.values())).where(F.col(p["column"]) >= p["least"]), {"column": {"type": "string", "required": True}, "least": {"type": "number", "default": 0}}),
    "count": runner.Module(lambda x, p: x[p["input"]].groupBy(p["by"]).agg(F.count("*").alias("n")), {"by": {"type": "string", "required": True}, "input": {"type": "string", "required": True}}),
    "join": runner.Module(lambda x, p: x[p["left"]].join(x[p["right"]], p["on"], "left"), {k: {"type": "string", "required": True} for k in ("left", "right", "on")}),
}


@query
def plan_run(spark, d):
    """A recipe of three stages, given out of order: regions and the number of their nations from a key on."""
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    regions = table(spark, d, "region").select(F.col("r_regionkey").alias("region"), F.col("r_name").alias("name"))
    stages = [
        {"id": "joined", "module": "join", "needs": ["counted"], "params": {"left": "regions", "right": "counted", "on": "region"}},
        {"id": "counted", "module": "count", "needs": ["kept"], "params": {"by": "region", "input": "kept"}},
        {"id": "kept", "module": "filter", "params": {"column": "nation", "least": 5}},
    ]
    return runner.run(spark, stages, REGISTRY, {"nations": nations, "regions": regions})["joined"]


@query
def stub_portions(spark, d):
    """Pages through the stub stages: text as it is, a portion per page, locked."""
    pages = _latest_pages(spark, d).select("run_id", "page", F.col("html").alias("text"))
    return stubs.locked(stubs.portions(stubs.clean(pages))).select("run_id", "portion_id", "page_start", "page_end", "type", "confidence")


@query
def run_snapshots(spark, d):
    """Configuration of every run as one JSON text: modules and schema versions of its portions, in order of name."""
    p = table(spark, d, "enriched_portions").where("module_id is not null").groupBy("run_id", "module_id").agg(F.max("schema_version").alias("schema"))
    m = p.groupBy("run_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("module_id", "schema")))).alias("m"))
    return m.select("run_id", F.to_json("m").alias("snapshot"))


def _boxes(spark, d):
    v = lambda i: F.abs(F.col("embedding")[i].cast("double"))
    return table(spark, d, "embeddings").select("vec_id", "label", v(0).alias("x0"), v(1).alias("y0"), (v(0) + v(2)).alias("x1"), (v(1) + v(3)).alias("y1"))


@query
def selected_boxes(spark, d):
    """Up to five boxes of a label that do not overlap, the largest first; embedding components stand for places and sizes."""
    return st.select_boxes(_boxes(spark, d), "label", "vec_id", 5)


@query
def box_sizes(spark, d):
    """Share of its label's extent that a box covers, and whether that is nearly all."""
    b = _boxes(spark, d)
    page = b.groupBy("label").agg(F.max("x1").alias("w"), F.max("y1").alias("h"))
    share = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / (F.col("w") * F.col("h"))
    return b.join(page, "label").select("vec_id", F.round(share, 6).alias("share")).withColumn("full_page", F.col("share") >= 0.95)
