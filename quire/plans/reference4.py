"""Document queries: choices by evidence, readings compared, priorities and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import alignment as al
from quire.functions import text as tx
from quire.operators import choices as ch
from quire.operators import nested as ne
from quire.operators import sequences as sq
from quire.plans.reference import _elements, _latest_pages, _portions
from quire.sources.tables import table

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _pages(spark, d):
    return table(spark, d, "pages_html").dropDuplicates(["page_key"])


@query
def page_choices(spark, d):
    """Choices of pages by their best evidence."""
    return ch.best(ch.candidates(_pages(spark, d), "page_key", "html"), "page_key").select("page_key", "target", "evidence", "confidence")


@query
def choice_evidence(spark, d):
    """Matches per kind of evidence."""
    return ch.candidates(_pages(spark, d), "page_key", "html").groupBy("evidence").agg(F.count("*").alias("matches"), F.count_distinct("page_key").alias("pages"))


@query
def anchor_variants(spark, d):
    """Targets in a page's text one digit away from one of its anchors."""
    c = ch.candidates(_pages(spark, d), "page_key", "html")
    a = c.where("evidence = 'anchor'").select("page_key", F.col("target").alias("anchor")).distinct()
    t = c.where("evidence <> 'anchor'").select("page_key", "target").distinct().join(a.select("page_key", F.col("anchor").alias("target")), ["page_key", "target"], "left_anti")
    return ch.near_anchor(t.join(a, "page_key"), ["page_key"], "target", "anchor")


@query
def escalation_budget(spark, d):
    """The twenty pages of least overlap of readings: what a budget would read again."""
    from quire.plans.reference import page_elements_vs_html

    return page_elements_vs_html(spark, d).orderBy("overlap", "run_id", "page").limit(20)


@query
def sampled_pages(spark, d):
    """Five evenly spaced pages of each run."""
    p = table(spark, d, "pages_html").select("run_id", "page").distinct()
    n = p.groupBy("run_id").agg(F.count("*").alias("n"))
    i = p.withColumn("i", F.row_number().over(sq.ordered(["run_id"], "page")) - 1).join(n, "run_id")
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 5))
    return i.where((F.col("i") % step == 0) & (F.floor(F.col("i") / step) < 5)).select("run_id", "page")


@query
def engine_disagreement(spark, d):
    """Unlikeness of both readings of a page, whole texts but for the white space."""
    e = _elements(spark, d, "run_id", "page", "seq", "text").groupBy("run_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x.text), " ").alias("a"))
    p = _latest_pages(spark, d).select("run_id", "page", tx.strip_tags(F.col("html")).alias("b"))
    whole = lambda c: F.trim(F.regexp_replace(c, "\\s+", " "))
    return e.join(p, ["run_id", "page"]).select("run_id", "page", al.disagreement_column(whole("a"), whole("b")).alias("disagreement"))


@query
def portion_page_windows(spark, d):
    """Portions that start in each window of ten pages, five apart."""
    p = _portions(spark, d).select("run_id", "portion_key", "page_start")
    w = p.withColumn("w", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("page_start") - 10) / 5) + 1).cast("int"), F.floor(F.col("page_start") / 5).cast("int"))))
    return w.groupBy("run_id", "w").agg(F.count("*").alias("portions"), F.min("page_start").alias("first_page"), F.max("page_start").alias("last_page"))


@query
def weighted_reasons(spark, d):
    """The twenty most frequent reasons of flagged chapters in whatever shape, over all reports, by number of chapters and name."""
    i = ne.unwrap_json(table(spark, d, "pipeline_issues").select("report_key", "summary").dropDuplicates(["report_key"]), "summary", "j")
    c = ne.explode_shaped(i.select("report_key", F.expr("try_variant_get(j, '$.flagged_genealogy_chapters', 'variant')").alias("c")), "c", "report_key", "chapter_pos", "v")
    r = c.select("report_key", F.expr("try_variant_get(try_parse_json(v), '$.reasons', 'variant')").alias("r"))
    r = ne.explode_shaped(r, "r", "report_key", "pos", "v").select(F.expr("try_variant_get(try_parse_json(v), '$', 'string')").alias("reason"))
    return r.where("reason is not null").groupBy("reason").agg(F.count("*").alias("chapters")).orderBy(F.desc("chapters"), "reason").limit(20)
