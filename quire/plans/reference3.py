"""Document queries: projections, predicates, votes, checks, patches."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import elements as em
from quire.operators import extract as ex
from quire.operators import references as rf
from quire.operators import relational as rl
from quire.operators import sequences as sq
from quire.operators import validate as va
from quire.plans.reference import _boundaries, _edges, _elements, _nodes, _portions
from quire.sources.tables import table

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def reduced_elements(spark, d):
    """Elements with text in one form, counted by page."""
    e = em.reduced(_elements(spark, d, "run_id", "page", "text"), "text")
    return e.groupBy("run_id", "page").agg(F.count("*").alias("elements"), F.sum(F.length("text")).alias("chars"))


@query
def gameplay_elements(spark, d):
    """Elements on the pages between the first and last choice of their run."""
    bounds = em.page_bounds(table(spark, d, "enriched_portions").where("size(choices) > 0"), ["run_id"], "page_start")
    e = _elements(spark, d, "run_id", "page").join(bounds, "run_id").where("page between first_page and last_page")
    return e.groupBy("run_id").agg(F.count("*").alias("elements"), F.count_distinct("page").alias("pages"))


@query
def skipped_blocks(spark, d):
    """Elements that carry no running text."""
    return _elements(spark, d, "text", "kind").where(em.skipped(F.col("kind"), F.col("text"))).select("element_key")


@query
def truncated_lines(spark, d):
    """Lines that break off, per element."""
    e = _elements(spark, d, "text").select("element_key", F.explode(F.split("text", "\\n")).alias("line"))
    return e.where(em.truncated_line(F.col("line"))).groupBy("element_key").agg(F.count("*").alias("lines"))


@query
def wrong_section_numbers(spark, d):
    """Portions whose text starts with another number than their section's."""
    p = table(spark, d, "enriched_portions").select("portion_key", "section_id", "raw_text").dropDuplicates(["portion_key"])
    return p.where(em.wrong_number(F.col("section_id"), F.col("raw_text"))).select("portion_key")


@query
def gibberish_lines(spark, d):
    """Documents with lines of garbage."""
    x = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\\n")).alias("line"))
    return x.where(em.gibberish(F.col("line"))).groupBy("doc_id").agg(F.count("*").alias("lines"))


@query
def number_lines_stripped(spark, d):
    """Documents that lines of a number alone were taken from."""
    x = table(spark, d, "documents").where("text is not null").select("doc_id", "text", em.without_number_lines(F.col("text")).alias("t"))
    return x.where("text <> t").select("doc_id", F.length("t").alias("chars"))


@query
def collapsed_blanks(spark, d):
    """Documents with runs of blank lines, collapsed."""
    x = table(spark, d, "documents").where("text is not null").select("doc_id", "text", tx.collapse_blank_lines(F.col("text")).alias("t"))
    return x.where("text <> t").select("doc_id", F.length("t").alias("chars"))


@query
def title_candidates(spark, d):
    """Best title line of every run."""
    e = _elements(spark, d, "run_id", "page", "seq", "text").where("page <= 5 and length(text) <= 80")
    e = e.withColumn("place", F.row_number().over(sq.ordered(["run_id", "page"], "seq", "element_key")) - 1)
    e = e.withColumn("score", em.heading_score(F.col("text"), F.col("page"), F.col("place")))
    return rl.best_row(e, ["run_id"], [-F.col("score"), F.col("seq"), F.col("element_key")]).select("run_id", "element_key", "score")


@query
def section_order(spark, d):
    """Sections of a run in their order: background, numbers by value, the rest by text."""
    w = sq.ordered(["run_id"], *em.section_sort_key(F.col("section")))
    return _nodes(spark, d).withColumn("place", F.row_number().over(w)).select("run_id", "section", "place")


@query
def boundary_checks(spark, d):
    """Boundaries with duplicate section, unknown element or shared start."""
    el = table(spark, d, "elements_core_content_types_rubric_v1").groupBy("run_id", F.col("id").alias("start_element_id")).agg(F.min("seq").alias("seq"))
    b = _boundaries(spark, d).join(el, ["run_id", "start_element_id"], "left")
    sec = b.groupBy("run_id", "section_id").agg(F.count("*").alias("n_sec"))
    start = b.where("seq is not null").groupBy("run_id", "seq").agg(F.count("*").alias("n_start"))
    j = b.join(sec, ["run_id", "section_id"]).join(start, ["run_id", "seq"], "left")
    e = F.array_join(F.array_compact(F.array(F.when(F.col("n_sec") > 1, F.lit("duplicate")), F.when(F.col("seq").isNull(), F.lit("unknown")), F.when(F.col("n_start") > 1, F.lit("shared")))), ",")
    return j.select("boundary_key", e.alias("errors")).where("errors <> ''")


@query
def inverted_spans(spark, d):
    """Boundaries that end before they start."""
    el = table(spark, d, "elements_core_content_types_rubric_v1").groupBy("run_id", "id").agg(F.min("seq").alias("seq"))
    b = _boundaries(spark, d).where("end_element_id is not null")
    s = el.select("run_id", F.col("id").alias("start_element_id"), F.col("seq").alias("s"))
    t = el.select("run_id", F.col("id").alias("end_element_id"), F.col("seq").alias("t"))
    return b.join(s, ["run_id", "start_element_id"]).join(t, ["run_id", "end_element_id"]).where("t < s").select("boundary_key", "s", "t")


@query
def duplicate_report(spark, d):
    """Sections with several boundaries: number, best score, spread of scores."""
    b = _boundaries(spark, d).groupBy("run_id", "section_id").agg(F.count("*").alias("candidates"), F.max("confidence").alias("best"), F.round(F.max("confidence") - F.min("confidence"), 4).alias("spread"))
    return b.where("candidates > 1")


@query
def coverage_by_run(spark, d):
    """Share of a run's sections that boundaries, portions and graph hold."""
    n = _nodes(spark, d).select("run_id", "section")
    b = table(spark, d, "section_boundaries_scan").select("run_id", rf.section_key(F.col("section_id")).alias("section")).distinct().withColumn("b", F.lit(1))
    p = table(spark, d, "enriched_portions").select("run_id", rf.section_key(F.col("section_id")).alias("section")).distinct().withColumn("p", F.lit(1))
    j = n.join(b, ["run_id", "section"], "left").join(p, ["run_id", "section"], "left")
    return j.groupBy("run_id").agg(F.count("*").alias("sections"), F.round(F.count("b") / F.count("*"), 4).alias("boundaries"), F.round(F.count("p") / F.count("*"), 4).alias("portions"))


@query
def status_bands(spark, d):
    """Runs by share of broken targets."""
    e = _edges(spark, d)
    known = _nodes(spark, d).select("run_id", F.col("section").alias("dst"), F.lit(1).alias("k"))
    s = e.join(known, ["run_id", "dst"], "left").groupBy("run_id").agg(F.round(1 - F.count("k") / F.count("*"), 4).alias("broken_share"))
    return s.withColumn("band", va.status_band(F.col("broken_share")))


@query
def patched_titles(spark, d):
    """Books after patches: every tenth removed, every seventh renamed, one added."""
    books = table(spark, d, "books").select("book_id", "title")
    n = F.regexp_extract("book_id", "([0-9]+)", 1).cast("int")
    op = F.when(n % 10 == 0, "remove").when(n % 7 == 0, "replace")
    p = books.select("book_id", op.alias("op"), F.concat(F.lit("New "), "title").alias("value"), n.alias("patch_no")).where("op is not null")
    added = spark.createDataFrame([("bk-new", "add", "An added book", 1)], "book_id string, op string, value string, patch_no int")
    return va.apply_patches(books, p.unionByName(added), ["book_id"], "title")


@query
def metric_conditions(spark, d):
    """Orders by a named comparison of price and a limit by priority."""
    o = table(spark, d, "orders")
    names = F.array(*[F.lit(x) for x in ("gt", "gte", "lt", "lte", "eq", "bad")])
    op = F.element_at(names, (F.col("o_orderkey") % 6 + 1).cast("int"))
    return o.select("o_orderpriority", va.compare(op, F.col("o_totalprice"), F.lit(100000.0)).alias("holds")).groupBy("o_orderpriority", "holds").agg(F.count("*").alias("orders"))


@query
def number_tokens(spark, d):
    """Short texts that become a number when letters are put right."""
    e = _elements(spark, d, "text").where("length(text) <= 6")
    return e.select("element_key", tx.number_token(F.col("text")).alias("n")).where("n is not null and n <> ''")


@query
def page_readings(spark, d):
    """Words per page in both readings, and their ratio."""
    words = lambda c: F.size(F.filter(F.split(tx.squash(c), " "), lambda x: x != ""))
    e = _elements(spark, d, "run_id", "page", "text").groupBy("run_id", "page").agg(F.sum(words(F.col("text"))).alias("element_words"))
    p = table(spark, d, "pages_html").groupBy("run_id", "page").agg(F.max(words(tx.strip_tags(F.col("html")))).alias("page_words"))
    return e.join(p, ["run_id", "page"], "full_outer").select("run_id", "page", "element_words", "page_words", F.round(F.col("element_words") / F.greatest("page_words", F.lit(1)), 4).alias("ratio"))


@query
def missing_pages(spark, d):
    """Pages that only one reading has."""
    e = table(spark, d, "elements_core_content_types_rubric_v1").select("run_id", "page").distinct().withColumn("e", F.lit(1))
    p = table(spark, d, "pages_html").select("run_id", "page").distinct().withColumn("p", F.lit(1))
    return e.join(p, ["run_id", "page"], "full_outer").where("e is null or p is null").select("run_id", "page", F.when(F.col("e").isNull(), "elements").otherwise("pages").alias("missing_in"))


@query
def content_type_votes(spark, d):
    """Most frequent content type per kind and text shape, with its share."""
    e = _elements(spark, d, "kind", "text", "content_type").where("content_type is not null").select("kind", tx.element_label(F.col("text"), F.col("kind")).alias("shape"), "content_type")
    c = e.groupBy("kind", "shape", "content_type").agg(F.count("*").alias("n"))
    t = c.groupBy("kind", "shape").agg(F.min_by("content_type", F.struct(-F.col("n"), "content_type")).alias("content_type"), F.max("n").alias("votes"), F.sum("n").alias("total"))
    return t.withColumn("share", F.round(F.col("votes") / F.col("total"), 4))


@query
def confidence_histogram(spark, d):
    """Elements by tenth of confidence."""
    e = _elements(spark, d, "content_type_confidence").where("content_type_confidence is not null")
    return e.groupBy(F.least(F.floor(F.col("content_type_confidence") * 10), F.lit(9)).cast("int").alias("tenth")).agg(F.count("*").alias("elements"))


@query
def late_rows(spark, d):
    """Rows of each artifact that arrived over a day after the first of their run."""
    parts = []
    for name in ("enriched_portions", "gamebook_sections", "section_boundaries_scan"):
        t = table(spark, d, name).groupBy("run_id", "loaded_at").agg(F.count("*").alias("n"))
        first = t.groupBy("run_id").agg(F.min("loaded_at").alias("first"))
        late = t.join(first, "run_id").where("loaded_at > first + interval 1 day")
        parts.append(late.groupBy("run_id").agg(F.sum("n").alias("late_rows")).withColumn("artifact", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def delivered_copies(spark, d):
    """Rows delivered more than once, per artifact."""
    parts = []
    for name, key in (("enriched_portions", "portion_key"), ("gamebook_sections", "section_key"), ("section_boundaries_scan", "boundary_key"), ("pages_html", "page_key"), ("elements_core_content_types_rubric_v1", "element_key")):
        c = table(spark, d, name).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(c.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).withColumn("artifact", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def portion_chains(spark, d):
    """Portions that continue another of their run, with its section."""
    p = _portions(spark, d)
    of = p.select("run_id", F.col("portion_id").alias("continuation_of"), F.col("section_id").alias("of_section")).dropDuplicates(["run_id", "continuation_of"])
    return p.where("continuation_of is not null").join(of, ["run_id", "continuation_of"], "left").groupBy("run_id").agg(F.count("*").alias("continuations"), F.count("of_section").alias("resolved"))


@query
def raw_record_fields(spark, d):
    """Top-level fields of the raw records, broken ones apart."""
    r = table(spark, d, "raw_portions").select("raw_key", "record").dropDuplicates(["raw_key"])
    keys = F.coalesce(F.json_object_keys("record"), F.array(F.lit("(none)")))
    return r.select(F.explode(keys).alias("field")).groupBy("field").agg(F.count("*").alias("records"))


@query
def choice_order(spark, d):
    """Choices of a portion in the order in which its text names their sections."""
    p = table(spark, d, "enriched_portions").select("portion_key", "raw_text", "choices").dropDuplicates(["portion_key"])
    c = p.select("portion_key", F.coalesce("raw_text", F.lit("")).alias("t"), F.posexplode("choices.target").alias("pos", "target")).withColumn("section", rf.section_key(F.col("target"))).where("section is not null")
    at = F.regexp_instr("t", F.concat(F.lit("(^|[^0-9])"), F.col("section"), F.lit("([^0-9]|$)")))
    w = sq.ordered(["portion_key"], F.when(F.col("at") > 0, F.col("at")).otherwise(F.lit(10**9)), "pos")
    return c.withColumn("at", at).withColumn("place", F.row_number().over(w)).select("portion_key", "pos", "section", "place")


@query
def items_by_section(spark, d):
    """Sections whose text asks for an item that no section of the run gives."""
    e = ex.item_checks(_elements(spark, d, "run_id", "text"), "text").select("run_id", "item").distinct()
    g = table(spark, d, "enriched_portions").select("run_id", F.explode("inventory.items_gained").alias("i")).select("run_id", F.regexp_extract(F.lower("i"), "([a-z-]+)$", 1).alias("item")).distinct()
    return e.join(g, ["run_id", "item"], "left_anti")
