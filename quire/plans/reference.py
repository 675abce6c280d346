"""Queries of the document operators over the paged-book tables and the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import graph as gr
from quire.operators import references as rf
from quire.operators import relational as rl
from quire.operators import scoring as sc
from quire.operators import sequences as sq
from quire.sources.tables import table

ELEMENTS = "elements_core_content_types_rubric_v1"
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _portions(spark: SparkSession, d: str) -> DataFrame:
    cols = ["portion_key", "run_id", "portion_id", "section_id", "module_id", "page_start", "page_end", "confidence", "continuation_of", "continuation_confidence"]
    return table(spark, d, "enriched_portions").select(*cols).dropDuplicates(["portion_key"])


def _boundaries(spark: SparkSession, d: str) -> DataFrame:
    cols = ["boundary_key", "run_id", "section_id", "start_element_id", "end_element_id", "start_page", "start_line_idx", "confidence", "method"]
    return table(spark, d, "section_boundaries_scan").select(*cols).dropDuplicates(["boundary_key"])


#: Place in document order of what names no element of its run: after all others.
NOWHERE = 2**31 - 1


def _boundaries_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Boundaries with ``start_seq``, the reading order of their start element; ids of a page need not follow it."""
    el = table(spark, d, ELEMENTS).groupBy("run_id", F.col("id").alias("start_element_id")).agg(F.min("seq").alias("start_seq"))
    return _boundaries(spark, d).join(el, ["run_id", "start_element_id"], "left").withColumn("start_seq", F.coalesce("start_seq", F.lit(NOWHERE)))


def _latest_pages(spark: SparkSession, d: str) -> DataFrame:
    """run_id, page and the ``html`` of the latest reading of each page."""
    return table(spark, d, "pages_html").where("html is not null").groupBy("run_id", "page").agg(F.max_by("html", "page_key").alias("html"))


def _elements(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return table(spark, d, ELEMENTS).select("element_key", *cols).dropDuplicates(["element_key"])


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """run_id, src, dst: choices of the section graph, sections named in one form."""
    e = table(spark, d, "gamebook_sections").where("deleted_at is null").select("run_id", rf.section_key(F.col("section_id")).alias("src"), F.explode("sequence").alias("e"))
    return e.where("e.kind = 'choice'").select("run_id", "src", rf.section_key(F.col("e.targetSection")).alias("dst")).dropna().distinct()


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "gamebook_sections").where("deleted_at is null")
    return n.select("run_id", rf.section_key(F.col("section_id")).alias("section"), "is_gameplay_section", "end_game").dropDuplicates(["run_id", "section"])


# --- selection, merges, joins ----------------------------------------------------


@query
def best_occurrence_per_key(spark, d):
    """Best portion of each section: confidence, later page, shorter span, first delivered."""
    span = F.col("page_end") - F.col("page_start")
    order = [-F.col("confidence"), -F.col("page_start"), span, F.col("portion_key")]
    return rl.best_row(_portions(spark, d), ["run_id", "section_id"], order).select("run_id", "section_id", "portion_key", "page_start", "page_end", "confidence")


@query
def resolve_best_occurrence(spark, d):
    """The other ranking: confidence, longer span, earlier page."""
    span = F.col("page_end") - F.col("page_start")
    order = [-F.col("confidence"), -span, F.col("page_start"), F.col("portion_key")]
    return rl.best_row(_portions(spark, d), ["run_id", "section_id"], order).select("run_id", "section_id", "portion_key")


@query
def dedupe_portions_union_sources(spark, d):
    """Equal spans of a section collapse to the most confident one, with the modules of all."""
    p = _portions(spark, d)
    keys = ["run_id", "section_id", "page_start", "page_end"]
    agg = p.groupBy(*keys).agg(F.min_by("portion_key", F.struct(-F.col("confidence"), "portion_key")).alias("portion_key"), F.max("confidence").alias("confidence"), F.array_join(F.array_sort(F.collect_set("module_id")), ",").alias("modules"), F.count("*").alias("rows"))
    return agg


@query
def collapse_duplicate_spans(spark, d):
    """Equal spans of a run collapse, with the best continuation link among them."""
    p = _portions(spark, d)
    cont = F.when(F.col("continuation_of").isNotNull(), F.struct(F.col("continuation_confidence").alias("c"), -F.col("portion_key"), F.col("continuation_of").alias("of")))
    out = p.groupBy("run_id", "page_start", "page_end").agg(F.max("confidence").alias("confidence"), F.count("*").alias("rows"), F.max(cont).alias("k"))
    return out.select("run_id", "page_start", "page_end", "confidence", "rows", F.col("k.of").alias("continuation_of"))


@query
def concat_dedupe_first_wins(spark, d):
    """Boundaries before portions: one row per section of a run, the first input wins."""
    b = _boundaries(spark, d).select("run_id", "section_id", F.col("boundary_key").alias("row_key"), F.col("start_page").alias("page"))
    p = _portions(spark, d).select("run_id", "section_id", F.col("portion_key").alias("row_key"), F.col("page_start").alias("page"))
    return rl.first_per_key([b, p], F.concat_ws("/", "run_id", "section_id"), "row_key").select("run_id", "section_id", "row_key", "page", "source_no")


@query
def overlay_page_numbers(spark, d):
    """Printed page numbers of the pages, overlaid with those of the elements."""
    pages = table(spark, d, "pages_html").groupBy("run_id", "page").agg(F.max("page_number").alias("page_number"))
    el = table(spark, d, ELEMENTS).groupBy("run_id", "page").agg(F.min("page_number").alias("page_number"))
    return rl.overlay(pages, el, ["run_id", "page"], ["page_number"])


@query
def unclaimed_links(spark, d):
    """Choices of the portions that the section graph does not hold."""
    links = table(spark, d, "enriched_portions").select("run_id", rf.section_key(F.col("section_id")).alias("src"), F.explode("choices.target").alias("t"))
    links = links.select("run_id", "src", rf.section_key(F.col("t")).alias("dst"))
    return rl.unclaimed(links, _edges(spark, d), ["run_id", "src", "dst"])


@query
def target_hits_misses(spark, d):
    """Per portion: choices whose section the run has, and others."""
    refs = table(spark, d, "enriched_portions").select("portion_key", "run_id", "choices").dropDuplicates(["portion_key"])
    refs = refs.select("portion_key", "run_id", F.explode("choices.target").alias("t")).select("portion_key", "run_id", rf.section_key(F.col("t")).alias("section")).where("section is not null")
    return rl.split_targets(refs, _nodes(spark, d), ["run_id", "section"], ["portion_key"])


@query
def target_coverage(spark, d):
    """Share of distinct choice targets of a run that exist."""
    e = _edges(spark, d).select("run_id", F.col("dst").alias("section")).distinct()
    known = _nodes(spark, d).select("run_id", "section", F.lit(1).alias("hit"))
    return e.join(known, ["run_id", "section"], "left").groupBy("run_id").agg(F.count("*").alias("targets"), F.count("hit").alias("found"), F.round(F.count("hit") / F.count("*"), 4).alias("coverage"))


@query
def missing_in_range(spark, d):
    """Section numbers from 1 to the run's highest that are absent."""
    n = _nodes(spark, d).where("section rlike '^[0-9]+$'").select("run_id", F.col("section").cast("int").alias("n"))
    return rl.missing_in_range(n, ["run_id"], "n")


@query
def bracket_pages_for_missing(spark, d):
    """Pages of the nearest found sections below and above each missing one."""
    n = table(spark, d, "gamebook_sections").where("deleted_at is null and section_id rlike '^[0-9]+$'").groupBy("run_id", F.col("section_id").cast("int").alias("n")).agg(F.min("provenance.page").alias("page"))
    return rl.bracket(rl.missing_in_range(n, ["run_id"], "n"), n.where("page is not null"), ["run_id"], "n", "page")


@query
def span_flagged_pages(spark, d):
    """Portions over pages whose HTML has little text: flagged pages and least text."""
    flagged = table(spark, d, "pages_html").select("run_id", "page", F.length(tx.strip_tags(F.col("html"))).alias("chars")).distinct().where("chars < 400")
    spans = rl.pages_of_spans(_portions(spark, d).select("portion_key", "run_id", "page_start", "page_end"), "page_start", "page_end", "page")
    return spans.join(flagged, ["run_id", "page"]).groupBy("portion_key").agg(F.count_distinct("page").alias("flagged_pages"), F.min("chars").alias("least_chars"))


@query
def macro_section_of_boundary(spark, d):
    """Macro section at each boundary's start: the narrowest interval that holds its seq, then by name."""
    el = table(spark, d, ELEMENTS).groupBy("run_id", F.col("id").alias("start_element_id")).agg(F.min("seq").alias("seq"))
    b = _boundaries(spark, d).select("boundary_key", "run_id", "start_element_id").join(el, ["run_id", "start_element_id"])
    m = table(spark, d, "sections_structured_stub").select("run_id", F.explode("macro_sections").alias("m")).select("run_id", "m.id", "m.start_seq", "m.end_seq").distinct()
    hit = b.join(m, "run_id").where("seq between start_seq and end_seq")
    return hit.groupBy("boundary_key").agg(F.min(F.struct(F.col("end_seq") - F.col("start_seq"), "id")).alias("m")).select("boundary_key", F.col("m.id").alias("macro_id"))


@query
def merge_fine_coarse_spans(spark, d):
    """Confident portions as fine spans; of the others those at least half uncovered."""
    p = _portions(spark, d).select("portion_key", "run_id", "page_start", "page_end", "confidence")
    return rl.merge_fine_coarse(p.where("confidence >= 0.8"), p.where("confidence < 0.8"), ["run_id"], "portion_key", "page_start", "page_end")


@query
def preference_merge_boundaries(spark, d):
    """Boundaries by method preference: one per section, only those whose start element exists."""
    el = table(spark, d, ELEMENTS).select("run_id", F.col("id").alias("start_element_id")).distinct()
    b = _boundaries(spark, d).join(el, ["run_id", "start_element_id"], "left_semi")
    rank = F.when(F.col("method").isNull(), 1).otherwise(0)
    return rl.best_row(b, ["run_id", "section_id"], [rank, -F.col("confidence"), F.col("boundary_key")]).select("run_id", "section_id", "boundary_key")


@query
def page_elements_vs_html(spark, d):
    """Per page: token overlap of both engines' readings, below nine tenths only."""
    el = _elements(spark, d, "run_id", "page", "text").groupBy("run_id", "page").agg(F.collect_set(F.lower("text")).alias("t"))
    el = el.select("run_id", "page", sq.token_set(F.array_join("t", " ")).alias("a"))
    pg = _latest_pages(spark, d).select("run_id", "page", sq.token_set(tx.strip_tags(F.col("html"))).alias("b"))
    return el.join(pg, ["run_id", "page"]).select("run_id", "page", F.round(sq.jaccard(F.col("a"), F.col("b")), 4).alias("overlap")).where("overlap < 0.9")


# --- sequences -------------------------------------------------------------------


@query
def boundary_spans_next_start(spark, d):
    """Each boundary with the start of the next one in document order."""
    b = _boundaries_in_order(spark, d)
    return sq.next_value(b, ["run_id"], ["start_seq", "boundary_key"], "start_element_id", "next_start").select("boundary_key", "run_id", "section_id", "start_element_id", "next_start")


@query
def header_body_score(spark, d):
    """Numeric headers of a run with the text that follows each."""
    e = _elements(spark, d, "run_id", "seq", "text").where("text is not null")
    return sq.header_scores(e, ["run_id"], ["seq"], F.trim("text").rlike("^[0-9]{1,3}$"), F.length("text"))


@query
def keep_earliest_within_50(spark, d):
    """Per section the earliest boundary whose score is near the best."""
    b = _boundaries_in_order(spark, d).withColumn("score", (F.col("confidence") * 1000).cast("int"))
    return sq.earliest_near_best(b, ["run_id", "section_id"], "score", ["start_seq", "boundary_key"]).select("run_id", "section_id", "boundary_key", "score")


@query
def pattern_regions(spark, d):
    """Runs of pages with or without a header or footer element."""
    e = table(spark, d, ELEMENTS).groupBy("run_id", "page").agg(F.max(F.coalesce(F.col("content_type").isin("Page-header", "Page-footer"), F.lit(False)).cast("int")).alias("marked"))
    w = sq.ordered(["run_id"], "page")
    isle = sq.islands(e, ["run_id"], ["page"], F.col("marked") != F.lag("marked").over(w), "region")
    return isle.groupBy("run_id", "region", "marked").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count("*").alias("pages"))


@query
def page_number_inference(spark, d):
    """Missing printed page numbers of a run."""
    p = table(spark, d, "pages_html").groupBy("run_id", "page").agg(F.max("page_number").alias("page_number"))
    return sq.fill_page_numbers(p, ["run_id"], "page", "page_number", "inferred")


@query
def ordering_conflicts(spark, d):
    """Boundaries whose section number is below the previous one in document order."""
    b = _boundaries_in_order(spark, d).where("section_id rlike '^[0-9]+$'").withColumn("n", F.col("section_id").cast("int"))
    return sq.decreases(b, ["run_id"], ["start_seq", "boundary_key"], "n").select("boundary_key", "n", "previous")


@query
def section_run_lengths(spark, d):
    """Section numbers found on a page and the length of their run of neighbours."""
    b = _boundaries(spark, d).where("section_id rlike '^[0-9]+$' and start_page is not null").withColumn("n", F.col("section_id").cast("int"))
    return sq.run_lengths(b, ["run_id", "start_page"], "n")


@query
def sliding_page_windows(spark, d):
    """Windows of eight pages every five pages, short tails kept."""
    p = table(spark, d, "pages_html").select("run_id", "page").distinct()
    return sq.sliding_windows(p, ["run_id"], ["page"], 8, 5).groupBy("run_id", "window_no").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count("*").alias("pages"))


@query
def top_portions_per_page(spark, d):
    """The two most confident portions that start on a page."""
    return sq.top_n(_portions(spark, d), ["run_id", "page_start"], [-F.col("confidence"), F.col("portion_key")], 2).select("run_id", "page_start", "rank", "portion_key")


@query
def page_clusters(spark, d):
    """Consecutive pages that hold fights."""
    p = table(spark, d, "enriched_portions").where("size(combat) > 0").select("run_id", F.col("page_start").alias("page")).distinct()
    w = sq.ordered(["run_id"], "page")
    isle = sq.islands(p, ["run_id"], ["page"], F.col("page") > F.lag("page").over(w) + 1, "cluster")
    return isle.groupBy("run_id", "cluster").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))


@query
def interleave_by_run(spark, d):
    """Portions in an order that takes one of each run in turn."""
    return sq.round_robin(_portions(spark, d).select("portion_key", "run_id", "page_start"), ["run_id"], ["page_start", "portion_key"], "turn").select("portion_key", "run_id", "turn")


@query
def continuation_links(spark, d):
    """Adjacent portions of a run that likely belong together."""
    p = table(spark, d, "enriched_portions").select("portion_key", "run_id", F.coalesce("raw_text", F.lit("")).alias("title"), "page_start", "page_end", "confidence").dropDuplicates(["portion_key"])
    out = sq.continuation_links(p, ["run_id"], ["page_start", "portion_key"], "title", "page_start", "page_end", "confidence")
    return out.select("portion_key", F.col("__p.portion_key").alias("previous_key"), "score")


@query
def boundary_gap_check(spark, d):
    """Gaps of more than twenty elements between boundary starts."""
    el = table(spark, d, ELEMENTS).groupBy("run_id", F.col("id").alias("start_element_id")).agg(F.min("seq").alias("seq"))
    b = _boundaries(spark, d).join(el, ["run_id", "start_element_id"]).select("run_id", "seq").distinct()
    return b.withColumn("previous", F.lag("seq").over(sq.ordered(["run_id"], "seq"))).where("seq - previous > 20")


# --- graph -----------------------------------------------------------------------


@query
def incoming_references(spark, d):
    """In-degree of every target."""
    return gr.incoming(_edges(spark, d), ["run_id"], "src", "dst")


@query
def orphan_sections(spark, d):
    """Sections that no choice leads to."""
    return gr.orphans(_nodes(spark, d), _edges(spark, d), ["run_id"], "section", "dst", ["1", "background", "intro", "rules"])


@query
def broken_links(spark, d):
    """Numeric targets without a section."""
    return gr.broken(_nodes(spark, d), _edges(spark, d), ["run_id"], "section", "dst")


@query
def reachable_sections(spark, d):
    """Sections that choices lead to from the start, with the fewest choices."""
    starts = _nodes(spark, d).where("section in ('1', 'background')").select("run_id", F.col("section").alias("node"))
    return gr.reachable(_edges(spark, d), starts, ["run_id"], "src", "dst", "node", depth=None)


@query
def reachable_by_events(spark, d):
    """Gameplay sections that events of any kind lead to from the start, with the fewest steps."""
    s = table(spark, d, "gamebook_sections").where("deleted_at is null").withColumn("section", rf.section_key(F.col("section_id")))
    game = s.groupBy("run_id", "section").agg(F.max("is_gameplay_section").alias("game")).where("game").select("run_id", "section")
    e = s.select("run_id", F.col("section").alias("src"), F.explode("sequence").alias("e"))
    e = e.withColumn("t", F.explode(F.array("e.targetSection", "e.outcomes.win.targetSection", "e.outcomes.lose.targetSection")))
    edges = e.select("run_id", "src", rf.section_key(F.col("t")).alias("dst")).dropna().distinct().join(game.withColumnRenamed("section", "dst"), ["run_id", "dst"], "left_semi")
    starts = game.where("section in ('1', 'background')").select("run_id", F.col("section").alias("node"))
    return gr.reachable(edges, starts, ["run_id"], "src", "dst", "node", depth=None)


@query
def reverse_paths_to_end(spark, d):
    """Sections from which an ending can be reached, with the fewest choices to it."""
    ends = _nodes(spark, d).where("end_game").select("run_id", F.col("section").alias("node"))
    return gr.reachable(_edges(spark, d), ends, ["run_id"], "dst", "src", "node")


@query
def orphan_confusions(spark, d):
    """Existing targets that differ from an orphan by one confusable digit."""
    o = gr.orphans(_nodes(spark, d), _edges(spark, d), ["run_id"], "section", "dst", ["1", "background"]).where("section rlike '^[0-9]+$'")
    c = gr.digit_confusions(o, "section", "dst")
    return c.join(_edges(spark, d).select("run_id", "dst").distinct(), ["run_id", "dst"], "left_semi").select("run_id", "section", "dst")


@query
def no_choice_sections(spark, d):
    """Gameplay sections, not endings, without any navigation."""
    g = table(spark, d, "gamebook_sections").where("is_gameplay_section and not end_game and deleted_at is null")
    nav = F.exists("sequence", lambda e: (e.kind == "choice") & e.targetSection.isNotNull() & (F.trim(e.targetSection) != ""))
    won = F.exists("sequence", lambda e: e.outcomes.win.targetSection.isNotNull() | e.outcomes.lose.targetSection.isNotNull())
    return g.where(~F.coalesce(nav, F.lit(False)) & ~F.coalesce(won, F.lit(False))).select("section_key", "run_id", "section_id").distinct()


@query
def duplicate_sections(spark, d):
    """Sections that a run holds under several keys, deleted ones included."""
    g = table(spark, d, "gamebook_sections").select("run_id", "section_id", "section_key").distinct()
    return g.groupBy("run_id", "section_id").agg(F.count("*").alias("keys")).where("keys > 1")


@query
def empty_sections(spark, d):
    """Sections whose markup has no text."""
    g = table(spark, d, "gamebook_sections").select("section_key", "html").dropDuplicates(["section_key"])
    return g.where(tx.strip_tags(F.col("html")) == "").select("section_key")


@query
def outcome_targets(spark, d):
    """Fight outcomes that lead nowhere in their run."""
    g = table(spark, d, "gamebook_sections").where("deleted_at is null").select("run_id", "section_key", F.explode("sequence").alias("e")).where("e.kind = 'combat'")
    t = g.select("run_id", "section_key", F.explode(F.array("e.outcomes.win.targetSection", "e.outcomes.lose.targetSection")).alias("t")).select("run_id", "section_key", rf.section_key(F.col("t")).alias("section")).dropna().distinct()
    return t.join(_nodes(spark, d), ["run_id", "section"], "left_anti")


@query
def section_range(spark, d):
    """Range, count and completeness of a run's numbered sections."""
    n = _nodes(spark, d).where("section rlike '^[0-9]+$'").select("run_id", F.col("section").cast("int").alias("n"))
    out = n.groupBy("run_id").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("sections"))
    return out.withColumn("completeness", F.round(F.col("sections") / (F.col("high") - F.col("low") + 1), 4))


# --- text ------------------------------------------------------------------------


@query
def quality_vector(spark, d):
    """Quality metrics of every document."""
    t = F.col("text")
    return table(spark, d, "documents").where("text is not null").select(
        "doc_id", F.length(t).alias("chars"), tx.ratio(t, "[A-Za-z]").alias("alpha"), tx.ratio(t, "[0-9]").alias("digits"), tx.mean_word_length(t).alias("mean_word"), tx.duplicate_line_share(t).alias("dup_lines")
    )


@query
def garble_reasons(spark, d):
    """Garbled documents with their reasons."""
    r = tx.garble_reasons(F.coalesce(F.col("text"), F.lit("")))
    return table(spark, d, "documents").select("doc_id", F.array_join(r, ",").alias("reasons")).where("reasons <> ''")


@query
def corruption_scores(spark, d):
    """Documents with signs of damage."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", tx.corruption_score(F.col("text")).alias("score")).where("score > 0")


@query
def fragmented_pages(spark, d):
    """Elements in fragments."""
    return _elements(spark, d, "text").where(tx.fragmented(F.col("text"))).select("element_key")


@query
def turn_to_refs(spark, d):
    """Section numbers that texts refer to."""
    return table(spark, d, "documents").select("doc_id", F.explode(tx.references(F.col("text"), tx.TURN_TO)).alias("target"))


@query
def html_anchor_edges(spark, d):
    """Anchors of pages: page and target."""
    return table(spark, d, "pages_html").select("page_key", F.explode(tx.references(F.col("html"), tx.ANCHOR, 1, 9999)).alias("target")).distinct()


@query
def html_stats(spark, d):
    """Tag counts of pages."""
    h = F.col("html")
    n = lambda tag: F.regexp_count(h, F.lit(f"<{tag}[ >]")).alias(tag)
    return table(spark, d, "pages_html").select("page_key", h.alias("html")).dropDuplicates(["page_key"]).select("page_key", n("table"), n("tr"), n("td"), n("h2"), n("p"), n("li"), n("img"))


@query
def header_numbers(spark, d):
    """Numeric second-level headings of pages."""
    x = F.regexp_extract_all("html", F.lit("<h2>[ ]*([0-9]{1,4})[ ]*</h2>"), F.lit(1))
    return table(spark, d, "pages_html").select("page_key", F.explode(x).alias("n")).select("page_key", F.col("n").cast("int").alias("n")).distinct()


@query
def choice_patterns_vs_anchors(spark, d):
    """Portions whose text refers to sections that their choices lack."""
    p = table(spark, d, "enriched_portions").select("portion_key", "raw_text", "choices").dropDuplicates(["portion_key"])
    refs = tx.references(F.coalesce("raw_text", F.lit("")), tx.TURN_TO)
    held = F.transform(F.coalesce(F.col("choices.target"), F.array().cast("array<string>")), lambda c: rf.section_key(c).try_cast("int"))
    return p.select("portion_key", F.explode(F.array_except(refs, held)).alias("target"))


@query
def normalized_targets(spark, d):
    """Every way a choice target is written, and the number it stands for."""
    return table(spark, d, "enriched_portions").select(F.explode("choices.target").alias("written")).where("written is not null").distinct().select("written", rf.section_key(F.col("written")).alias("section"), tx.number_token(F.col("written")).alias("digits_only"))


@query
def element_labels(spark, d):
    """Layout labels by rules, counted per given label."""
    e = _elements(spark, d, "text", "kind", "content_type").select(tx.element_label(F.col("text"), F.col("kind")).alias("label"), F.coalesce("content_type", F.lit("")).alias("given"))
    return e.groupBy("label", "given").agg(F.count("*").alias("rows"))


@query
def all_caps_headings(spark, d):
    """Elements in capitals that look like headings."""
    return _elements(spark, d, "text").where(tx.all_caps_heading(F.trim("text"))).select("element_key")


@query
def reflowed_elements(spark, d):
    """Elements with words divided at line ends, joined."""
    return _elements(spark, d, "text").select("element_key", F.col("text").alias("before"), tx.reflow_hyphens(F.col("text")).alias("after")).where("before <> after").select("element_key", F.length("after").alias("chars"), F.md5("after").alias("digest"))


@query
def toc_entries(spark, d):
    """Table-of-contents lines: title slug and page, the lowest page per title."""
    line = _elements(spark, d, "text").select(F.explode(F.split("text", "\\n")).alias("l"))
    e = line.select(tx.slug(F.regexp_extract("l", "^(.*?)[ ]*\\.{3,}[ ]*([0-9]+)[ ]*$", 1)).alias("title"), F.regexp_extract("l", "^(.*?)[ ]*\\.{3,}[ ]*([0-9]+)[ ]*$", 2).alias("page")).where("page <> ''")
    return e.groupBy("title").agg(F.min(F.col("page").cast("int")).alias("page"), F.count("*").alias("entries"))


@query
def ending_kinds(spark, d):
    """Ending sections by kind."""
    g = table(spark, d, "gamebook_sections").where("end_game").select("section_key", "html").dropDuplicates(["section_key"])
    return g.select("section_key", tx.ending_kind(F.col("html")).alias("ending"))


@query
def vocabulary_ratio(spark, d):
    """Share of a document's distinct words that the word list has."""
    # The word list is one row of a fixed number of words, so every document is judged where it is read.
    known = table(spark, d, "word_list").agg(F.collect_set(F.lower("word")).alias("known"))
    words = table(spark, d, "documents").select("doc_id", sq.token_set(F.coalesce("text", F.lit(""))).alias("w")).where("size(w) > 0")
    share = F.size(F.array_intersect("w", "known")) / F.size("w")
    return words.crossJoin(F.broadcast(known)).select("doc_id", F.size("w").alias("words"), F.round(share, 4).alias("in_vocabulary"))


@query
def neighbour_similarity(spark, d):
    """Token overlap of a document with the previous one of its source, where high."""
    t = table(spark, d, "documents").where("text is not null and source is not null").select("doc_id", "source", sq.token_set(F.col("text")).alias("t"))
    return sq.lag_in_slices(t, ["source"], "doc_id", "t", "p").where("p is not null").select("doc_id", F.round(sq.jaccard(F.col("t"), F.col("p")), 4).alias("similarity")).where("similarity >= 0.3")


@query
def duplicate_documents(spark, d):
    """Class of exact copies and class size of every document with text."""
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("h"))
    c = t.groupBy("h").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies")).where("copies > 1")
    return t.join(c, "h").select("doc_id", "class_id", "copies")


# --- reports, costs, state --------------------------------------------------------


@query
def issue_counts(spark, d):
    """Issues per kind over all reports."""
    i = table(spark, d, "pipeline_issues").select("report_key", "issues").dropDuplicates(["report_key"]).select("report_key", F.explode("issues").alias("i"))
    kind = F.coalesce(F.get_json_object("i", "$.type"), F.get_json_object("i", "$.kind"), F.lit("?"))
    return i.groupBy(kind.alias("kind")).agg(F.count("*").alias("issues"), F.count_distinct("report_key").alias("reports"))


@query
def run_health(spark, d):
    """Per run: sections, orphans and broken links, and a status."""
    keys = ["run_id"]
    n = _nodes(spark, d).groupBy(*keys).agg(F.count("*").alias("sections"))
    o = gr.orphans(_nodes(spark, d), _edges(spark, d), keys, "section", "dst", ["1", "background"]).groupBy(*keys).agg(F.count("*").alias("orphans"))
    b = gr.broken(_nodes(spark, d), _edges(spark, d), keys, "section", "dst").groupBy(*keys).agg(F.count("*").alias("broken"))
    h = n.join(o, keys, "left").join(b, keys, "left").na.fill(0, ["orphans", "broken"])
    return h.withColumn("status", F.when((F.col("orphans") == 0) & (F.col("broken") == 0), "healthy").when(F.col("broken") > 0, "broken").otherwise("orphans"))


@query
def cost_rollup(spark, d):
    """Usage cost per model, with the total: lines as usage, parts as prices."""
    u = table(spark, d, "lineitem").select(F.col("l_partkey").alias("model"), F.col("l_quantity").alias("tokens_in"), F.round(F.col("l_extendedprice") / 100).alias("tokens_out"), "l_returnflag")
    p = table(spark, d, "part").where("p_partkey % 3 > 0").select(F.col("p_partkey").alias("model"), (F.col("p_size") / 100).alias("rate_in"), (F.col("p_retailprice") / 10000).alias("rate_out"))
    c = sc.usage_cost(u, p, "model", 0.01, 0.03)
    return c.rollup("l_returnflag").agg(F.count("*").alias("calls"), F.round(F.sum("cost"), 2).alias("cost")).withColumn("l_returnflag", F.coalesce("l_returnflag", F.lit("all")))


@query
def model_ranking(spark, d):
    """Suppliers as models: those no other beats in quality, latency and cost, by three-part score."""
    s = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("model")).agg(
        F.round(F.avg(1 - F.col("l_discount")), 6).alias("quality"), F.round(F.avg("l_quantity"), 6).alias("latency"), F.round(F.avg("l_extendedprice") / 1000, 6).alias("cost")
    )
    best = s.agg(F.min("latency").alias("fastest"), F.min("cost").alias("cheapest"))
    front = sc.pareto_front(s, "model", "quality", ["latency", "cost"])
    scored = front.crossJoin(F.broadcast(best))  # one row
    return scored.select("model", "quality", "latency", "cost", sc.three_part_score(F.col("quality"), F.col("latency"), F.col("cost"), F.col("fastest"), F.col("cheapest")).alias("score"))


@query
def state_fold(spark, d):
    """Latest event of every user and kind: the keyed state that the event log stands for."""
    e = table(spark, d, "events")
    return e.groupBy("user_id", "event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.count("*").alias("events"))


@query
def box_overlaps(spark, d):
    """Overlap of the boxes in two embedding quadruples."""
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("v"))
    x = lambda i: F.abs(F.col("v")[i].cast("double"))
    box = lambda k: [x(k), x(k + 1), x(k) + x(k + 2), x(k + 1) + x(k + 3)]
    return e.select("vec_id", F.round(sc.iou(box(0), box(4)), 4).alias("overlap"))


@query
def macro_confidence(spark, d):
    """Macro sections of a run: number, mean confidence, widest."""
    m = table(spark, d, "sections_structured_stub").select("structure_key", "run_id", "macro_sections").dropDuplicates(["structure_key"]).select("run_id", F.explode("macro_sections").alias("m"))
    return m.groupBy("run_id").agg(F.count("*").alias("sections"), F.round(F.avg("m.confidence"), 4).alias("confidence"), F.max(F.expr("m.end_seq - m.start_seq + 1")).alias("widest"))


@query
def stat_check_targets(spark, d):
    """Pass and fail sections of stat checks."""
    p = table(spark, d, "enriched_portions").select("portion_key", F.explode("stat_checks").alias("s")).where("s is not null")
    return p.select("portion_key", "s.stat", rf.section_key(F.col("s.pass_section")).alias("pass_section"), rf.section_key(F.col("s.fail_section")).alias("fail_section")).distinct()


@query
def inventory_balance(spark, d):
    """Items gained and lost over all portions of a run."""
    p = table(spark, d, "enriched_portions").select("portion_key", "run_id", "inventory").dropDuplicates(["portion_key"])
    g = p.select("run_id", F.explode("inventory.items_gained").alias("item"), F.lit(1).alias("n"))
    lost = p.select("run_id", F.explode("inventory.items_lost").alias("item"), F.lit(-1).alias("n"))
    return g.unionByName(lost).where("item is not null").groupBy("run_id", F.lower(F.trim("item")).alias("item")).agg(F.sum("n").alias("balance"), F.count("*").alias("events"))
