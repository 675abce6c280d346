"""More document queries: extractors, layout, scans in order, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import html as ht
from quire.functions import text as tx
from quire.operators import extract as ex
from quire.operators import references as rf
from quire.operators import relational as rl
from quire.operators import scoring as sc
from quire.operators import sequences as sq
from quire.operators import stateful as st
from quire.plans.reference import ELEMENTS, _boundaries, _edges, _elements, _nodes, _portions
from quire.sources.tables import table
from quire.streaming import events as ev

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# --- extractors ------------------------------------------------------------------


@query
def combat_stat_blocks(spark, d):
    """Enemies with their stats, in elements."""
    return ex.stat_blocks(_elements(spark, d, "text"), "text").select("element_key", "place", "enemy", "skill", "stamina")


@query
def stat_changes(spark, d):
    """Signed stat changes, in elements."""
    return ex.stat_changes(_elements(spark, d, "text"), "text").select("element_key", "place", "amount", "stat")


@query
def item_checks(spark, d):
    """Items asked for, counted."""
    return ex.item_checks(_elements(spark, d, "text"), "text").groupBy("item").agg(F.count("*").alias("checks"), F.count_distinct("element_key").alias("elements"))


@query
def starting_items(spark, d):
    """First two items of the equipment of each book's rules."""
    m = ex.matches(_elements(spark, d, "run_id", "text"), ex.flat(F.col("text")), ex.ITEM_START, ["first", "second"])
    return m.select("run_id", "first", "second").distinct()


@query
def event_targets(spark, d):
    """Targets of all events with their path."""
    g = table(spark, d, "gamebook_sections").select("section_key", "sequence").dropDuplicates(["section_key"])
    return ex.event_list(g, "section_key", "sequence").select("section_key", "pos", "kind", "path", rf.section_key(F.col("target")).alias("section"))


@query
def event_kinds(spark, d):
    """Events per kind, and how many lead somewhere."""
    e = table(spark, d, "gamebook_sections").select("section_key", "sequence").dropDuplicates(["section_key"]).select(F.explode("sequence").alias("e"))
    return e.groupBy(F.col("e.kind").alias("kind")).agg(F.count("*").alias("events"), F.count("e.targetSection").alias("with_target"), F.count("e.outcomes").alias("with_outcomes"))


@query
def fight_styles(spark, d):
    """Portions with fights by style."""
    p = table(spark, d, "enriched_portions").where("size(combat) > 0").select("portion_key", "raw_text").dropDuplicates(["portion_key"])
    return p.groupBy(ex.fight_style(F.col("raw_text")).alias("style")).agg(F.count("*").alias("portions"))


@query
def merged_turn_to(spark, d):
    """Links of a portion and the targets of its choices as one ordered list."""
    p = table(spark, d, "enriched_portions").select("portion_key", "turn_to_links", F.col("choices.target").alias("t")).dropDuplicates(["portion_key"])
    return p.select("portion_key", F.array_join(ex.ordered_union(F.col("turn_to_links"), F.col("t")), "|").alias("targets")).where("targets <> ''")


@query
def enemy_strength(spark, d):
    """Enemies of the typed portions: fights, mean skill and stamina."""
    f = table(spark, d, "enriched_portions").select("portion_key", "combat").dropDuplicates(["portion_key"]).select(F.explode("combat").alias("f")).select(F.explode("f.enemies").alias("e")).where("e.enemy is not null")
    return f.groupBy(F.upper(F.trim("e.enemy")).alias("enemy")).agg(F.count("*").alias("fights"), F.round(F.avg("e.skill"), 4).alias("skill"), F.round(F.avg("e.stamina"), 4).alias("stamina"))


@query
def single_fight_outcomes(spark, d):
    """Fight modes and styles as stored."""
    f = table(spark, d, "enriched_portions").select("portion_key", "combat").dropDuplicates(["portion_key"]).select(F.explode("combat").alias("f")).where("f is not null")
    return f.groupBy(F.coalesce("f.mode", F.lit("")).alias("mode"), F.coalesce("f.style", F.lit("")).alias("style")).agg(F.count("*").alias("fights"), F.sum(F.when(F.col("f.outcomes").isNotNull(), 1).otherwise(0)).alias("with_outcomes"))


# --- layout and pages --------------------------------------------------------------


@query
def element_positions(spark, d):
    """Elements by alignment and part of the page; y near the foot counts as bottom."""
    e = _elements(spark, d, "layout", "content_type")
    y = F.col("layout.y")
    pos = F.when(y.isNull(), "unknown").when(y <= 0.10, "top").when(y >= 0.90, "bottom").otherwise("middle")
    return e.groupBy(pos.alias("position"), F.coalesce("layout.h_align", F.lit("")).alias("h_align")).agg(F.count("*").alias("elements"))


@query
def repeated_edge_texts(spark, d):
    """Short texts on at least three pages of a run."""
    e = _elements(spark, d, "run_id", "page", "text").where("length(text) between 5 and 60").select("run_id", "page", F.lower(tx.squash(F.col("text"))).alias("line")).distinct()
    return e.groupBy("run_id", "line").agg(F.count("*").alias("pages")).where("pages >= 3")


@query
def numeric_sequences(spark, d):
    """Runs of at least three rising numbers, one per page, in a run."""
    e = _elements(spark, d, "run_id", "page", "text").where(F.trim("text").rlike("^[0-9]{1,3}$")).groupBy("run_id", "page").agg(F.max(F.trim("text").cast("int")).alias("n"))
    w = sq.ordered(["run_id"], "page")
    isle = sq.islands(e, ["run_id"], ["page"], F.col("n") != F.lag("n").over(w) + 1, "seq_no")
    return isle.groupBy("run_id", "seq_no").agg(F.min("n").alias("first"), F.max("n").alias("last"), F.count("*").alias("length")).where("length >= 3").drop("seq_no")


@query
def page_flags(spark, d):
    """Per run: pages, blank pages, share with printed number, share with a section header."""
    p = table(spark, d, "pages_html").groupBy("run_id", "page").agg(F.max(F.length(tx.strip_tags(F.col("html")))).alias("chars"), F.max(F.col("page_number").isNotNull().cast("int")).alias("numbered"), F.max(F.col("html").rlike("<h2>").cast("int")).alias("headed"))
    return p.groupBy("run_id").agg(F.count("*").alias("pages"), F.sum((F.col("chars") == 0).cast("int")).alias("blank"), F.round(F.avg("numbered"), 4).alias("numbered"), F.round(F.avg(F.when(F.col("chars") > 0, F.col("headed"))), 4).alias("headed"))


@query
def blank_between_pages(spark, d):
    """Blank pages between pages with text."""
    p = table(spark, d, "pages_html").groupBy("run_id", "page").agg(F.max(F.length(tx.strip_tags(F.col("html")))).alias("chars"))
    w = sq.ordered(["run_id"], "page")
    return p.withColumn("before", F.lag("chars").over(w)).withColumn("after", F.lead("chars").over(w)).where("chars = 0 and before > 0 and after > 0").select("run_id", "page")


@query
def spread_sides(spark, d):
    """Whether left pages are even and right pages odd, per run."""
    p = table(spark, d, "pages_html").select("page_key", "run_id", "page", "spread_side").distinct().where("spread_side is not null")
    right = ((F.col("spread_side") == "R") & (F.col("page") % 2 == 1)) | ((F.col("spread_side") == "L") & (F.col("page") % 2 == 0))
    return p.groupBy("run_id").agg(F.count("*").alias("pages"), F.sum(right.cast("int")).alias("as_expected"))


@query
def chapters_by_heading(spark, d):
    """Top headings of a run in page order, equal neighbours collapsed, each to the page before the next."""
    x = F.regexp_extract_all("html", F.lit("<h1>([^<]+)</h1>"), F.lit(1))
    h = table(spark, d, "pages_html").select("run_id", "page", F.posexplode(x).alias("pos", "title")).distinct().withColumn("title", tx.squash(F.col("title")))
    w = sq.ordered(["run_id"], "page", "pos", "title")
    h = h.withColumn("prev", F.lag("title").over(w)).where("prev is null or prev <> title")
    last = table(spark, d, "pages_html").groupBy("run_id").agg(F.max("page").alias("last_page"))
    h = h.withColumn("next_page", F.lead("page").over(w)).join(last, "run_id")
    return h.select("run_id", "title", F.col("page").alias("first_page"), F.greatest(F.col("page"), F.coalesce(F.col("next_page") - 1, F.col("last_page"))).alias("last_page"))


@query
def page_text_lengths(spark, d):
    """Readable characters per page by stripping tags, with quartiles of the run."""
    p = table(spark, d, "pages_html").groupBy("run_id", "page").agg(F.max(F.length(tx.strip_tags(F.col("html")))).alias("chars"))
    return p.groupBy("run_id").agg(F.min("chars").alias("least"), F.percentile("chars", 0.5).alias("median"), F.max("chars").alias("most"))


@query
def html_text(spark, d):
    """Readable text of pages by the tolerant parser."""
    return table(spark, d, "pages_html").dropDuplicates(["page_key"]).select("page_key", ht.html_to_text(F.col("html")).alias("text"))


@query
def html_blocks(spark, d):
    """Ordered blocks of pages."""
    p = table(spark, d, "pages_html").dropDuplicates(["page_key"]).select("page_key", F.explode(ht.parse_blocks(F.col("html"))).alias("b"))
    return p.select("page_key", "b.order", "b.block_type", "b.text")


# --- scans in order -----------------------------------------------------------------


@query
def greedy_spans(spark, d):
    """Portions of a run without overlap, best first."""
    return st.greedy_intervals(_portions(spark, d), "run_id", "portion_key", "page_start", "page_end", "confidence")


@query
def sequential_sections(spark, d):
    """Boundaries whose numbers go on upwards over the pages, stray ones left out."""
    b = _boundaries(spark, d).where("section_id rlike '^[0-9]+$'").withColumn("n", F.col("section_id").cast("int"))
    return st.sequential_scan(b, "run_id", "boundary_key", "start_page", "n")


@query
def repeated_pages(spark, d):
    """Pages that repeat one of the three pages before."""
    p = table(spark, d, "pages_html").dropDuplicates(["page_key"]).select("run_id", "page_key", "page", tx.strip_tags(F.col("html")).alias("text"))
    return st.repeated_pages(p, "run_id", "page_key", "page", "text")


@query
def text_columns(spark, d):
    """Columns by position: embedding components as x centres of one label's lines."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding")[0].alias("x"))
    return st.columns_of(e, ["label"], "vec_id", "x")


@query
def distinct_boxes(spark, d):
    """Boxes of a label without near-equal ones; components of the embedding times 1,000 stand for pixels."""
    v = lambda i: F.abs(F.col("embedding")[i]) * 1000
    e = table(spark, d, "embeddings").select("vec_id", "label", v(0).alias("x0"), v(1).alias("y0"), (v(0) + v(2)).alias("x1"), (v(1) + v(3)).alias("y1"))
    return st.distinct_boxes(e, "label", "vec_id")


# --- reports ------------------------------------------------------------------------


@query
def label_majority(spark, d):
    """Majority label of each labelled record, the first by name on ties."""
    t = table(spark, d, "text_labels").groupBy("src_table", "rec_key", "label").agg(F.count("*").alias("n"))
    return t.groupBy("src_table", "rec_key").agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("label"), F.sum("n").alias("votes"))


@query
def section_lineage(spark, d):
    """In which artifacts a section of a run occurs."""
    key = lambda df, c, name: df.select("run_id", rf.section_key(F.col(c)).alias("section")).dropna().distinct().withColumn(name, F.lit(1))
    b = key(table(spark, d, "section_boundaries_scan"), "section_id", "in_boundaries")
    p = key(table(spark, d, "enriched_portions"), "section_id", "in_portions")
    g = key(table(spark, d, "gamebook_sections"), "section_id", "in_gamebook")
    out = b.join(p, ["run_id", "section"], "full_outer").join(g, ["run_id", "section"], "full_outer")
    return out.na.fill(0, ["in_boundaries", "in_portions", "in_gamebook"])


@query
def lineage_gaps(spark, d):
    """Sections per run by the first artifact that lost them."""
    s = section_lineage(spark, d)
    lost = F.when((F.col("in_boundaries") == 1) & (F.col("in_portions") == 0), "portions").when((F.col("in_portions") == 1) & (F.col("in_gamebook") == 0), "gamebook").when(F.col("in_boundaries") == 0, "boundaries").otherwise("none")
    return s.groupBy("run_id", lost.alias("lost_in")).agg(F.count("*").alias("sections"))


@query
def choice_completeness(spark, d):
    """Per section: references in the text against choice events, and whether they agree."""
    g = table(spark, d, "gamebook_sections").where("deleted_at is null").select("section_key", "html", "sequence").dropDuplicates(["section_key"])
    anchors, words = tx.references(F.col("html"), tx.ANCHOR), tx.references(tx.strip_tags(F.col("html")), tx.TURN_TO)
    held = F.array_distinct(F.filter(F.transform(F.filter(F.coalesce("sequence", F.array().cast("array<struct<kind:string,targetSection:string,choiceText:string,enemy:string,stat:string,outcomes:struct<win:struct<targetSection:string>,lose:struct<targetSection:string>>>>")), lambda e: e.kind == "choice"), lambda e: rf.section_key(e.targetSection).try_cast("int")), lambda x: x.isNotNull()))
    r = g.select("section_key", F.when(F.size(anchors) > 0, anchors).otherwise(words).alias("refs"), held.alias("held"))
    out = r.select("section_key", F.size(F.array_except("refs", "held")).alias("missing"), F.size(F.array_except("held", "refs")).alias("extra"))
    return out.withColumn("valid", (F.col("missing") + F.col("extra")) == 0)


@query
def relaxed_index(spark, d):
    """Which sections refer to a target: sorted list per target."""
    return _edges(spark, d).groupBy("run_id", "dst").agg(F.array_join(F.array_sort(F.collect_set("src")), ",").alias("sources"))


@query
def unreachable_groups(spark, d):
    """Sections that only sections without any reference lead to."""
    e = _edges(spark, d)
    roots = _nodes(spark, d).select("run_id", "section").join(e.select("run_id", F.col("dst").alias("section")).distinct(), ["run_id", "section"], "left_anti").where("section not in ('1', 'background')")
    from_roots = e.join(roots.select("run_id", F.col("section").alias("src")), ["run_id", "src"])
    others = e.join(roots.select("run_id", F.col("section").alias("src")), ["run_id", "src"], "left_anti").select("run_id", "dst").distinct()
    return from_roots.select("run_id", "dst").distinct().join(others, ["run_id", "dst"], "left_anti")


@query
def chapter_drift(spark, d):
    """Pages with tables as chapters: drift score of their markup."""
    h = F.col("html")
    n = lambda p: F.regexp_count(h, F.lit(p))
    p = table(spark, d, "pages_html").select("page_key", "html").dropDuplicates(["page_key"])
    s = p.select("page_key", n("<th[ >]").alias("residual"), n("<h1[ >]").alias("external"), n("<table").alias("tables"), n("<h2[ >]").alias("subgroups"))
    return s.where("tables > 0").select("page_key", sc.drift_score(F.col("residual"), F.col("external"), F.col("tables"), F.lit(1), F.col("subgroups")).alias("drift"))


@query
def event_state(spark, d):
    """The event log folded to a state per user and kind, as the stream folds it."""
    e = table(spark, d, "events").select(F.col("ts").alias("timestamp"), F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("stage"), F.element_at(F.array(*[F.lit(s) for s in ev.STATUSES]), (F.col("event_id") % 6 + 1).cast("int")).alias("status"), F.col("event_id").cast("int").alias("current"), F.lit(None).cast("int").alias("total"), F.lit(None).cast("string").alias("message"))
    return ev.fold(e).select("run_id", "stage", "status", "current", "events")


@query
def usage_by_minute(spark, d):
    """Token totals per model and hour."""
    e = table(spark, d, "events").select(F.col("ts").alias("timestamp"), F.col("event_type").alias("model"), F.col("user_id").alias("prompt_tokens"), F.length("props").alias("completion_tokens"))
    return ev.usage_totals(e, "1 hour").select(F.date_format("window_start", "yyyy-MM-dd HH").alias("hour"), "model", "calls", "prompt_tokens", "completion_tokens")


@query
def run_reuse(spark, d):
    """Advice for every run from its health and labels."""
    from quire.plans.reference import run_health

    verdict = F.when(F.max(F.col("confidence")) < 0.9, "bad").otherwise("good")
    a = _boundaries(spark, d).groupBy("run_id").agg(verdict.alias("assessment"))
    return ev.reuse_advice(run_health(spark, d), a, "run_id").select("run_id", "status", "assessment", "advice")


@query
def book_totals(spark, d):
    """Per kind and language of book: runs, pages and sections, with totals."""
    b = table(spark, d, "books").select("book_id", "book_kind", "lang")
    p = table(spark, d, "pages_html").groupBy("book_id").agg(F.count_distinct("run_id").alias("runs"), F.count_distinct("page_key").alias("pages"))
    g = table(spark, d, "gamebook_sections").groupBy("book_id").agg(F.count_distinct("section_key").alias("sections"))
    j = b.join(p, "book_id", "left").join(g, "book_id", "left").na.fill(0, ["runs", "pages", "sections"])
    out = j.cube("book_kind", "lang").agg(F.count("*").alias("books"), F.sum("runs").alias("runs"), F.sum("pages").alias("pages"), F.sum("sections").alias("sections"))
    return out.select(F.coalesce("book_kind", F.lit("all")).alias("book_kind"), F.coalesce("lang", F.lit("all")).alias("lang"), "books", "runs", "pages", "sections")


@query
def revenue_by_nation(spark, d):
    """Orders and revenue per nation and year: joins from facts to dimensions. Sums are of decimals, so no order of adding shows in the cents."""
    money = lambda c: F.col(c).cast("decimal(12,2)")
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(money("l_extendedprice") * (F.lit(1).cast("decimal(3,2)") - money("l_discount"))).alias("revenue"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name", "year").agg(F.count("*").alias("orders"), F.round(F.sum("revenue"), 2).cast("double").alias("revenue"))


@query
def previous_event(spark, d):
    """Each event with the latest event of another kind by the same user before it (as-of)."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    w = sq.ordered(["user_id"], "ts", "event_id")
    # At the first event of a stretch of one kind the row before is of another; the rest of the stretch has the same answer.
    x = e.withColumn("before", F.lag(F.struct("event_id", "event_type")).over(w))
    first = F.when(F.col("before").isNull() | (F.col("before.event_type") != F.col("event_type")), F.struct(F.col("before.event_id").alias("id")))
    return x.withColumn("first", first).select("event_id", F.last("first", ignorenulls=True).over(w.rowsBetween(sq.Window.unboundedPreceding, 0))["id"].alias("previous_id"))


@query
def voted_lines(spark, d):
    """Lines of the first element of each page: the longer of the two halves, joined."""
    e = _elements(spark, d, "run_id", "page", "seq", "text").where("text is not null")
    a = rl.best_row(e.select("run_id", "page", "seq", "element_key", "text"), ["run_id", "page"], [F.col("seq"), F.col("element_key")]).select("run_id", "page", F.split("text", "\\n").alias("a"))
    b = rl.best_row(e.select("run_id", "page", "seq", "element_key", "text"), ["run_id", "page"], [-F.col("seq"), F.col("element_key")]).select("run_id", "page", F.split("text", "\\n").alias("b"))
    return a.join(b, ["run_id", "page"]).select("run_id", "page", F.md5(F.array_join(ex.longer_lines(F.col("a"), F.col("b")), "\n")).alias("digest"))


@query
def interval_join_counts(spark, d):
    """Per portion the boundaries that start on one of its pages (a range join as an equi-join on pages)."""
    p = rl.pages_of_spans(_portions(spark, d).select("portion_key", "run_id", "page_start", "page_end"), "page_start", "page_end", "page")
    b = _boundaries(spark, d).where("start_page is not null").groupBy("run_id", F.col("start_page").alias("page")).agg(F.count("*").alias("n"))
    return p.join(b, ["run_id", "page"]).groupBy("portion_key").agg(F.sum("n").alias("boundaries"))
