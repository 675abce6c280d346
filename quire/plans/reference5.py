"""Document queries: section records, phases, tables of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import html as ht
from quire.functions import text as tx
from quire.operators import sections as se
from quire.plans.reference import _elements
from quire.sources.tables import table

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def section_kinds(spark, d):
    """Sections by kind, as their id and text tell."""
    p = table(spark, d, "enriched_portions").select("portion_key", "section_id", "raw_text").dropDuplicates(["portion_key"])
    return p.groupBy(se.section_kind(F.col("section_id"), F.lit(None).cast("string"), F.col("raw_text")).alias("kind")).agg(F.count("*").alias("portions"))


@query
def page_phases(spark, d):
    """Pages of a run by phase: front matter, game, unknown."""
    p = table(spark, d, "pages_html").groupBy("run_id", "page").agg(F.max("html").alias("html"))
    out = se.phases(p, ["run_id"], "page", F.lower("html").contains("background"), F.col("html").rlike("(?i)turn to [0-9<]"))
    return out.groupBy("run_id", "phase").agg(F.count("*").alias("pages"), F.min("page").alias("first_page"))


@query
def dice_checks(spark, d):
    """Dice rolls in documents."""
    return se.dice_checks(table(spark, d, "documents").select("doc_id", "text"), "text").where("dice is not null").select("doc_id", "place", "dice", "plus")


@query
def portion_events(spark, d):
    """The ordered event list of every portion."""
    return se.event_list(table(spark, d, "enriched_portions").dropDuplicates(["portion_key"]), "portion_key")


@query
def longest_item_names(spark, d):
    """Items of a run, bare words left out where a longer name ends in them."""
    p = table(spark, d, "enriched_portions")
    items = p.select("run_id", F.explode("inventory.items_gained").alias("item")).unionByName(p.select("run_id", F.explode("inventory.items_lost").alias("item"))).where("trim(item) <> ''")
    return se.longest_names(items, ["run_id"], "item")


@query
def paragraphs_of_lines(spark, d):
    """Lines of the elements of every page as paragraphs."""
    e = _elements(spark, d, "run_id", "page", "seq", "text")
    x = e.select("run_id", "page", "seq", F.posexplode(F.split("text", "\\n")).alias("i", "line")).withColumn("at", F.col("seq") * 1_000_000 + F.col("i")).where("trim(line) <> ''")
    out = se.flushed_lines(x, ["run_id", "page"], "at", "line")
    return out.select("run_id", "page", "paragraph", "lines", F.length("line").alias("chars"))


@query
def page_tables(spark, d):
    """Tables of pages: rows and columns, adjacent ones merged, continued rows joined."""
    p = table(spark, d, "pages_html").where("html like '%<table%'").dropDuplicates(["page_key"])
    t = p.select("page_key", F.posexplode(ht.parse_tables(F.col("html"))).alias("table_no", "rows"))
    return t.select("page_key", "table_no", F.size("rows").alias("rows"), F.array_max(F.transform("rows", lambda r: F.size(r))).alias("columns"))


@query
def cleaned_pages(spark, d):
    """Pages with kept elements only."""
    p = table(spark, d, "pages_html").dropDuplicates(["page_key"]).select("page_key", ht.sanitize(F.col("html")).alias("html"))
    return p.select("page_key", F.length("html").alias("chars"), F.md5(tx.strip_tags(F.col("html"))).alias("digest"))


@query
def printed_numbers(spark, d):
    """Printed page number of a page: its page-number paragraph, else its last block of a number alone."""
    h = F.col("html")
    last = F.nullif(F.regexp_extract(h, "<p[^>]*>[^0-9<]{0,4}([0-9]+)[^0-9<]{0,4}</p>[ \\n]*$", 1), F.lit(""))
    p = table(spark, d, "pages_html").select("page_key", "html").dropDuplicates(["page_key"])
    arr = lambda c: F.when(F.size(c) > 0, F.element_at(c, -1))
    classed = arr(F.regexp_extract_all(h, F.lit("class=\"page-number\">[^0-9<]*([0-9]+)"), F.lit(1)))
    foot = arr(F.regexp_extract_all(h, F.lit("<footer>[^0-9<]*([0-9]+)"), F.lit(1)))
    return p.select("page_key", F.coalesce(classed, foot, last).cast("int").alias("printed")).where("printed is not null")
