"""Document queries: kinds and filters of elements, portions to repair, pages to look at again, boxes matched."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quire.functions import alignment as al
from quire.functions import scan as fs
from quire.functions import text as tx
from quire.operators import elements as em
from quire.operators import relational as rl
from quire.operators import sequences as sq
from quire.plans.reference import _boundaries, _elements, missing_in_range
from quire.plans.reference2 import chapter_drift
from quire.plans.reference7 import _boxes
from quire.sources.tables import table

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# --- elements ------------------------------------------------------------------------


@query
def element_kinds(spark, d):
    """Elements by the kind that their content type stands for."""
    e = _elements(spark, d, "content_type")
    return e.groupBy(em.kind_of(F.regexp_replace("content_type", "-", "")).alias("kind")).agg(F.count("*").alias("elements"))


@query
def section_header_elements(spark, d):
    """Numeric section headers on the pages between the first and last choice of their run."""
    bounds = em.page_bounds(table(spark, d, "enriched_portions").where("size(choices) > 0"), ["run_id"], "page_start")
    e = _elements(spark, d, "run_id", "page", "text", "content_type").where("content_type = 'Section-header'").withColumn("n", F.trim("text").try_cast("int"))
    return e.where("n between 1 and 400").join(bounds, "run_id").where("page between first_page and last_page").select("element_key", "run_id", "n")


@query
def frontmatter_elements(spark, d):
    """Elements before the first page with a choice, per run."""
    bounds = em.page_bounds(table(spark, d, "enriched_portions").where("size(choices) > 0"), ["run_id"], "page_start")
    e = _elements(spark, d, "run_id", "page", "text").join(bounds, "run_id").where("page < first_page")
    return e.groupBy("run_id").agg(F.count("*").alias("elements"), F.sum(F.length("text")).alias("chars"))


@query
def title_heads(spark, d):
    """Short elements that are the title of their book, in whatever case, per run."""
    books = table(spark, d, "books").select("book_id", F.lower(tx.squash(F.col("title"))).alias("line"))
    e = _elements(spark, d, "run_id", "book_id", "page", "text").where("length(text) <= 80").withColumn("line", F.lower(tx.squash(F.col("text"))))
    return e.join(F.broadcast(books), ["book_id", "line"]).groupBy("run_id").agg(F.count("*").alias("heads"), F.count_distinct("page").alias("pages"))  # a fixed table


@query
def prefix_dropped(spark, d):
    """Texts of elements and their successors joined, without a number alone on the first line."""
    e = _elements(spark, d, "run_id", "seq", "text")
    j = e.withColumn("two", F.concat_ws("\n", "text", F.lead("text").over(sq.ordered(["run_id"], "seq", "element_key"))))
    return j.select("element_key", "two", em.without_prefix(F.col("two")).alias("rest")).where("two <> rest").select("element_key", F.length("rest").alias("chars"))


# --- repair and search ---------------------------------------------------------------


@query
def portions_to_repair(spark, d):
    """Portions of some length whose spelling is bad enough for a repair."""
    known = table(spark, d, "word_list").agg(F.collect_set(F.lower("word")).alias("known"))
    p = table(spark, d, "enriched_portions").where("length(trim(raw_text)) >= 60").select("portion_key", "raw_text").dropDuplicates(["portion_key"]).crossJoin(F.broadcast(known))
    s = fs.spell_columns(p, F.col("raw_text"), "known", "s")
    return s.where("s.dictionary >= 0.5 or s.confusion >= 0.5").select("portion_key", "s.words", "s.dictionary", "s.confusion")


@query
def suspected_pages(spark, d):
    """Pages where a missing section can stand: those from the nearest found section before it to the nearest after it, at most 20 pages apart."""
    found = _boundaries(spark, d).where("section_id rlike '^[0-9]+$' and start_page is not null").select("run_id", F.col("section_id").cast("int").alias("n"), F.col("start_page").alias("page"))
    missing = missing_in_range(spark, d)
    # A number that the sections lack may have a boundary; only its neighbours count.
    found = found.groupBy("run_id", "n").agg(F.min("page").alias("page")).join(missing, ["run_id", "n"], "left_anti")
    b = rl.bracket(missing, found, ["run_id"], "n", "page").where("below is not null and above is not null and above >= below and above - below <= 20")
    return rl.pages_of_spans(b, "below", "above", "page").groupBy("run_id", "page").agg(F.count("*").alias("missing"))


@query
def drift_groups(spark, d):
    """Pages with tables by the shape of their markup: how many, the least drift as baseline, and how many drift."""
    h = F.col("html")
    n = lambda p: F.regexp_count(h, F.lit(p))
    shape = F.concat_ws("/", F.when(n("<thead") > 0, "head").otherwise("plain"), F.when(n("<th[ >]") > 0, "th").otherwise("td"))
    p = table(spark, d, "pages_html").select("page_key", "html").dropDuplicates(["page_key"]).select("page_key", shape.alias("signature"))
    j = p.join(chapter_drift(spark, d), "page_key")
    return j.groupBy("signature").agg(F.count("*").alias("pages"), F.min_by("page_key", F.struct("drift", "page_key")).alias("baseline"), F.min("drift").alias("baseline_drift"), F.sum((F.col("drift") >= 20).cast("int")).alias("flagged"))


# --- boxes ---------------------------------------------------------------------------


def _grouped_boxes(spark, d):
    b = _boxes(spark, d).select("label", "vec_id", F.array("x0", "y0", "x1", "y1").alias("box"))
    side = lambda k: F.transform(F.filter(F.array_sort(F.collect_list(F.struct("vec_id", "box"))), lambda x: F.pmod(x.vec_id, F.lit(2)) == k), lambda x: x.box)
    return b.where("vec_id % 10 = 0 or vec_id % 10 = 1").groupBy("label").agg(side(0).alias("predicted"), side(1).alias("golden"))


@query
def matched_boxes(spark, d):
    """Boxes of a label paired one to one by falling overlap: number of pairs and mean overlap."""

    @F.pandas_udf("array<double>")
    def pairs(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[p[2] for p in al.match_boxes([list(x) for x in m], [list(x) for x in g])] for m, g in zip(a, b, strict=True)], dtype=object)

    x = _grouped_boxes(spark, d).select("label", F.size("golden").alias("golden"), pairs("predicted", "golden").alias("p"))
    mean = F.aggregate("p", F.lit(0.0), lambda s, v: s + v) / F.greatest(F.size("p"), F.lit(1))
    return x.select("label", "golden", F.size("p").alias("pairs"), F.round(mean, 6).alias("overlap"))


@query
def inner_boxes(spark, d):
    """Boxes of a label left when those go that contain a smaller one."""

    @F.pandas_udf("array<int>")
    def inner(boxes: pd.Series) -> pd.Series:
        return pd.Series([al.inner_boxes([list(x) for x in b]) for b in boxes], dtype=object)

    return _grouped_boxes(spark, d).select("label", F.size("predicted").alias("boxes"), F.size(inner("predicted")).alias("kept"))


@query
def assigned_boxes(spark, d):
    """Boxes of a label assigned to each other with the highest total overlap: number of boxes and the total."""

    @F.pandas_udf("double")
    def total(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for m, g in zip(a, b, strict=True):
            score = [[al.iou(x, y) for y in g] for x in m]
            out.append(round(sum(score[i][j] for i, j in enumerate(al.best_assignment(score)) if j >= 0), 6))
        return pd.Series(out)

    return _grouped_boxes(spark, d).select("label", F.size("predicted").alias("boxes"), total("predicted", "golden").alias("overlap"))
