"""Document queries: readings of a page compared and voted, numbers and lines of scans, boundary candidates, checks and scores."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quire.functions import alignment as al
from quire.functions import html as ht
from quire.functions import scan as fs
from quire.functions import text as tx
from quire.operators import elements as em
from quire.operators import readings as rd
from quire.operators import references as rf
from quire.operators import relational as rl
from quire.operators import sections as se
from quire.operators import sequences as sq
from quire.operators import stateful as st
from quire.plans.reference import _boundaries, _boundaries_in_order, _elements, _latest_pages, _portions
from quire.sources.tables import table

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _numbered(b):
    return b.where("section_id rlike '^[0-9]+$' and start_page is not null").withColumn("n", F.col("section_id").cast("int"))


# --- boundary candidates -----------------------------------------------------------


@query
def page_outliers(spark, d):
    """Boundaries that stay when each page keeps one cluster of numbers: the largest, or one three times as near to what the page's place in the run suggests."""
    b = _numbered(_boundaries(spark, d)).select("boundary_key", "run_id", "start_page", "n")
    extent = b.groupBy("run_id").agg(F.min("start_page").alias("lo"), F.max("start_page").alias("hi"))
    w = sq.ordered(["run_id", "start_page"], "n", "boundary_key")
    c = sq.islands(b, ["run_id", "start_page"], ["n", "boundary_key"], F.col("n") - F.lag("n").over(w) > 5, "cluster")
    sizes = c.groupBy("run_id", "start_page", "cluster").agg(F.count("*").alias("size"), F.avg("n").alias("middle"), F.min("n").alias("first")).join(extent, "run_id")
    place = F.when(F.col("hi") == F.col("lo"), 0.5).otherwise((F.col("start_page") - F.col("lo")) / (F.col("hi") - F.col("lo")))
    sizes = sizes.withColumn("off", F.abs(F.col("middle") - F.floor(place * 400)))
    per = sizes.groupBy("run_id", "start_page").agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("a"), "first", "off", "cluster"))).alias("x"))
    best = F.aggregate("x", F.col("x")[0], lambda acc, c: F.when(c.off * 3 < acc.off, c).otherwise(acc))
    return c.join(per.select("run_id", "start_page", best.cluster.alias("cluster")), ["run_id", "start_page", "cluster"]).select("boundary_key", "run_id", "start_page", "n")


@query
def resolved_duplicates(spark, d):
    """One boundary per section number of a run: that whose page has the longest run of neighbouring numbers, the earliest among equals."""
    b = _numbered(_boundaries_in_order(spark, d)).select("boundary_key", "run_id", "start_page", "n", "start_seq")
    fit = sq.run_lengths(b, ["run_id", "start_page"], "n").withColumnRenamed("run_length", "fit")
    j = b.join(fit, ["run_id", "start_page", "n"])
    return rl.best_row(j, ["run_id", "n"], [-F.col("fit"), F.col("start_seq"), F.col("boundary_key")]).select("run_id", "n", "boundary_key", "fit")


@query
def centred_boxes(spark, d):
    """Boxes of a label whose centre lies by the mean centre: embedding components stand for left and right."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.abs(F.col("embedding")[0].cast("double")).alias("a"), F.abs(F.col("embedding")[1].cast("double")).alias("b"))
    out = em.centred(e, ["label"], F.least("a", "b"), F.greatest("a", "b"), "centred")
    return out.groupBy("label").agg(F.count("*").alias("boxes"), F.sum(F.col("centred").cast("int")).alias("centred"))


@query
def column_splits(spark, d):
    """Where the widest gap between places parts the lines of a page in two: element heights stand for x centres, sides have three lines at least."""
    e = _elements(spark, d, "run_id", "page", "layout").where("layout.y is not null").select("element_key", "run_id", "page", F.col("layout.y").alias("x"))
    w = sq.ordered(["run_id", "page"], "x", "element_key")
    g = e.select("run_id", "page", "x", F.row_number().over(w).alias("left"), F.lead("x").over(w).alias("next"), F.count("*").over(sq.Window.partitionBy("run_id", "page")).alias("lines"))
    g = g.where("next is not null and lines >= 6").withColumn("gap", F.round(F.col("next") - F.col("x"), 6))
    widest = rl.best_row(g, ["run_id", "page"], [-F.col("gap"), F.col("left")])
    return widest.where("gap >= 0.12 and left >= 3 and lines - left >= 3").select("run_id", "page", F.round((F.col("x") + F.col("next")) / 2, 6).alias("split"), "left")


# --- numbers and lines of scans ------------------------------------------------------


@query
def number_candidates(spark, d):
    """Short texts of elements and choice targets with the numbers that they can stand for."""
    t = _elements(spark, d, "text").where("length(text) <= 6").select(F.trim("text").alias("token"))
    t = t.unionByName(table(spark, d, "enriched_portions").select(F.explode("choices.target").alias("token")).where("length(token) <= 6")).distinct()
    return t.select("token", F.array_join(fs.number_candidates(F.col("token")).cast("array<string>"), ",").alias("numbers")).where("numbers <> ''")


@query
def scan_error_numbers(spark, d):
    """Short elements that hold a number beside signs, with what is left when the number takes their place."""
    e = _elements(spark, d, "text").where("length(text) <= 24").select("element_key", fs.numbers_beside_errors(F.col("text")).alias("x")).where("size(x) > 1")
    return e.select("element_key", F.array_join(F.slice("x", 2, 4), "|").alias("candidates"))


@query
def rescue_lines(spark, d):
    """Lines of documents that are nearly a number."""
    x = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\\n")).alias("line"))
    return x.where(fs.needs_number_rescue(F.col("line"))).groupBy("doc_id").agg(F.count("*").alias("lines"))


@query
def repaired_phrases(spark, d):
    """Lines of elements and of readers' documents whose "turn to" was misread, put right (texts are spoilt as a scanner would, so that there are some)."""
    x = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.regexp_replace("text", "\\b([Tt])urn to ([0-9]*[13579])\\b", "$1um t0 $2"), "\\n")).alias("place", "line"))
    return x.withColumn("fixed", fs.repaired_phrase(F.col("line"))).where("fixed <> line").select("doc_id", "place", F.md5("fixed").alias("digest"))


@query
def key_value_lines(spark, d):
    """Stat lines and fields of elements: entity and number of pairs, first key and value."""
    x = _elements(spark, d, "text").select("element_key", F.posexplode(F.split("text", "\\n")).alias("place", "line")).select("element_key", "place", fs.key_values(F.col("line")).alias("k")).where("k is not null")
    return x.select("element_key", "place", "k.entity", F.size("k.pairs").alias("pairs"), F.col("k.pairs")[0].key.alias("key"), F.col("k.pairs")[0].value.alias("value"))


def _page_lines(spark, d):
    """run_id, page, lines of the elements in reading order."""
    e = _elements(spark, d, "run_id", "page", "seq", "text").where("text is not null")
    x = F.array_sort(F.collect_list(F.struct("seq", "element_key", "text")))
    return e.groupBy("run_id", "page").agg(F.flatten(F.transform(x, lambda r: F.split(r.text, "\\n"))).alias("lines"))


@query
def form_pages(spark, d):
    """Pages with signs of a form to fill in."""
    p = _page_lines(spark, d).select("run_id", "page", fs.form_confidence(F.col("lines")).alias("confidence"))
    return p.where("confidence > 0").withColumn("is_form", F.col("confidence") >= 0.5)


@query
def page_fragments(spark, d):
    """Documents' lines that are fragments, and those of them at the end that belong to no text."""
    x = table(spark, d, "documents").where("text is not null").select("doc_id", F.split("text", "\\n").alias("lines"))
    out = x.select("doc_id", F.size(F.filter("lines", lambda x: fs.is_fragment(x))).alias("fragments"), fs.trailing_fragments(F.col("lines")).alias("trailing"))
    return out.where("fragments > 0")


# --- readings ------------------------------------------------------------------------


def _readings(spark, d):
    """run_id, page, engine, preference, lines of both readings of every page."""
    e = _page_lines(spark, d).select("run_id", "page", F.lit("elements").alias("engine"), F.lit(0).alias("preference"), "lines")
    lines = F.filter(F.split(tx.html_lines(F.col("html")), "\\n"), lambda x: x != "")
    return e.unionByName(_latest_pages(spark, d).select("run_id", "page", F.lit("pages").alias("engine"), F.lit(1).alias("preference"), lines.alias("lines")))


def _spelled(spark, d):
    return rd.spelled(_readings(spark, d), table(spark, d, "word_list"), "word")


@query
def engine_quality(spark, d):
    """Spelling of both readings of every page, and the quality that a vote may weigh."""
    q = rd.engine_quality(_spelled(spark, d))
    return q.select("run_id", "page", "engine", F.col("spell.words").alias("words"), F.col("spell.dictionary").alias("dictionary"), F.col("spell.confusion").alias("confusion"), "quality")


@query
def best_engines(spark, d):
    """The better reading of every page with its score."""
    return rd.best_engine(_spelled(spark, d), ["run_id", "page"], "preference")


@query
def voted_pages(spark, d):
    """Pages voted line by line from three readings: elements, pages, and portions that begin there."""
    p = _portions(spark, d).join(table(spark, d, "enriched_portions").select("portion_key", "raw_text").dropDuplicates(["portion_key"]), "portion_key").where("raw_text is not null")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("portion_key", "raw_text"))), lambda r: F.split(r.raw_text, "\\n"))
    third = p.groupBy("run_id", F.col("page_start").alias("page")).agg(F.flatten(texts).alias("lines")).select("run_id", "page", F.lit("portions").alias("engine"), F.lit(2).alias("preference"), "lines")
    words = table(spark, d, "word_list")
    q = rd.engine_quality(rd.spelled(_readings(spark, d).unionByName(third), words, "word"))
    known = frozenset(r["w"] for r in words.select(F.lower("word").alias("w")).distinct().collect())  # a table of fixed size
    v = rd.voted_pages(q.select("run_id", "page", "engine", "lines", "quality"), ["run_id", "page"], known)
    return v.select("run_id", "page", "place", "source", F.md5("text").alias("digest"), "distance")


@query
def page_similarity(spark, d):
    """Likeness of neighbouring pages of a run: the higher of token overlap and sequence ratio, where it is a half at least."""
    p = _latest_pages(spark, d).select("run_id", "page", tx.strip_tags(F.col("html")).alias("text"))
    prev = F.lag("text").over(sq.ordered(["run_id"], "page"))
    x = p.withColumn("before", prev).where("before is not null and text <> '' and before <> ''")
    return x.select("run_id", "page", al.similarity_column(F.col("text"), F.col("before"), 0.5).alias("similarity")).where("similarity >= 0.5")


@query
def near_repeats(spark, d):
    """Pages that repeat one of the three kept pages before to seven tenths."""
    p = table(spark, d, "pages_html").dropDuplicates(["page_key"]).select("run_id", "page_key", "page", tx.strip_tags(F.col("html")).alias("text"))
    return st.repeated_pages(p, "run_id", "page_key", "page", "text", threshold=0.7)


@query
def table_scores(spark, d):
    """Tables of a page's markup against those of its elements: rows aligned, row and column counts, cells."""
    g = table(spark, d, "pages_html").where("html like '%<table%'").groupBy("run_id", "page").agg(F.max_by("html", "page_key").alias("html"))
    g = g.select("run_id", "page", ht.parse_tables(F.col("html")).alias("golden"))
    cells = F.filter(F.transform(F.split("text", "\\n"), lambda x: F.transform(F.split(x, "\\s*\\|\\s*|\\t+|\\s{2,}|\\s*;\\s*"), lambda y: F.trim(y))), lambda r: F.size(r) > 1)
    o = _elements(spark, d, "run_id", "page", "seq", "text", "kind").withColumn("rows", cells).where("size(rows) > 1")
    o = o.groupBy("run_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "rows"))), lambda x: x.rows).alias("output"))

    @F.pandas_udf("array<struct<golden:int,output:int,aligned:double,rows:double,columns:double,cells:double>>")
    def score(golden: pd.Series, output: pd.Series) -> pd.Series:
        out = []
        for g_, o_ in zip(golden, output, strict=True):
            gs, os_ = ([[list(r) for r in t] for t in x] for x in (g_, [] if o_ is None else o_))
            pairs = al.match_tables(gs, os_)
            out.append([(i, j, al.table_alignment(gs[i], os_[j]), al.row_count_score(len(gs[i]), len(os_[j])), al.column_score([len(r) for r in gs[i]], [len(r) for r in os_[j]]), al.cell_score(gs[i], os_[j])) for i, j in pairs])
        return pd.Series(out, dtype=object)

    x = g.join(o, ["run_id", "page"]).select("run_id", "page", F.explode(score("golden", "output")).alias("s"))
    return x.select("run_id", "page", "s.*")


@query
def content_retention(spark, d):
    """What the cleaned markup of a page keeps: recall of its tokens, ratio of lengths, and whether that is enough."""
    p = table(spark, d, "pages_html").where("html is not null").dropDuplicates(["page_key"]).select("page_key", tx.strip_tags(F.col("html")).alias("old"), tx.strip_tags(F.regexp_replace("html", "<table.*</table>", "")).alias("new"))
    tokens = lambda c: F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: F.length(x) > 1)
    r = p.select("page_key", "old", "new", tokens(F.col("old")).alias("a"), F.array_distinct(tokens(F.col("new"))).alias("b"))
    recall = F.when(F.size("a") == 0, 1.0).otherwise(F.round(F.size(F.filter("a", lambda x: F.array_contains(F.col("b"), x))) / F.size("a"), 4))
    ratio = F.when(F.length("old") == 0, 1.0).otherwise(F.round(F.length("new") / F.length("old"), 4))
    out = r.select("page_key", recall.alias("recall"), ratio.alias("ratio"), F.length("old").alias("chars"))
    return out.withColumn("retained", (F.col("recall") >= 0.9) & ((F.col("chars") < 120) | (F.col("ratio") >= 0.8))).where("ratio < 1")


# --- markup --------------------------------------------------------------------------


@query
def presented_sections(spark, d):
    """Sections' markup for reading: no running heads, page numbers, or heading of the section's own number."""
    g = table(spark, d, "gamebook_sections").select("section_key", "section_id", "html").dropDuplicates(["section_key"])
    x = g.select("section_key", "html", ht.present(F.col("html"), F.col("section_id")).alias("clean"))
    return x.select("section_key", F.length("clean").alias("chars"), F.md5("clean").alias("digest"), (F.col("clean") != F.col("html")).alias("changed"))


@query
def image_matches(spark, d):
    """Pages with images: how many captions of the markup the next page's elements of kind image share a quarter of their words with."""
    alts = F.regexp_extract_all("html", F.lit('<img[^>]*alt="([^"]*)"'), F.lit(1))
    g = _latest_pages(spark, d).select("run_id", "page", alts.alias("golden")).where("size(golden) > 0")
    o = _elements(spark, d, "run_id", "page", "seq", "kind", "text").where("kind = 'image'").groupBy("run_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: F.coalesce(x.text, F.lit(""))).alias("output"))

    @F.pandas_udf("int")
    def matched(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([al.matched_captions(list(x), [] if y is None else list(y)) for x, y in zip(a, b, strict=True)])

    x = g.join(o, ["run_id", "page"], "left")
    return x.select("run_id", "page", F.size("golden").alias("images"), matched("golden", "output").alias("matched")).withColumn("score", F.round(F.col("matched") / F.col("images"), 4))


@query
def figure_scores(spark, d):
    """Figures, images and captions of pages."""
    n = lambda p: F.regexp_count("html", F.lit(p))
    p = table(spark, d, "pages_html").select("page_key", "html").dropDuplicates(["page_key"])
    out = p.select("page_key", n("<figure[ >]").alias("figures"), n("<img[^>]* src=").alias("sourced"), n("<img[ >]").alias("images"), n("<figcaption[ >]").alias("captions"), n('data-placement="').alias("placed"))
    return out.where("figures + images + captions > 0").withColumn("unsourced", F.col("images") - F.col("sourced"))


@query
def reading_metadata(spark, d):
    """Scores that a reader put into a page's first lines, cut to 0 to 1; null where there are none."""
    head = F.regexp_extract("html", "(?i)<meta[^>]*name\\s*=\\s*[\"']ocr-metadata[\"'][^>]*>", 0)
    score = lambda k: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.nullif(F.regexp_extract(head, f"(?i){k}\\s*=\\s*[\"']([^\"']+)[\"']", 1), F.lit("")).try_cast("double")))
    p = table(spark, d, "pages_html").select("page_key", "html").dropDuplicates(["page_key"])
    return p.select("page_key", score("data-ocr-quality").alias("quality"), score("data-ocr-integrity").alias("integrity"), score("data-continuation-risk").alias("risk"))


@query
def images_by_page(spark, d):
    """Crops of a label in reading order, by top, left and name: embedding components stand for their place."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.floor(F.abs(F.col("embedding")[1]) * 100).cast("int").alias("top"), F.floor(F.abs(F.col("embedding")[0]) * 100).cast("int").alias("left"))
    return e.withColumn("place", F.row_number().over(sq.ordered(["label"], "top", "left", "vec_id"))).select("label", "vec_id", "place")


# --- checks --------------------------------------------------------------------------


@query
def capability_gaps(spark, d):
    """Content types of the elements that no kind of label covers, with the pages that need it."""
    asked = _elements(spark, d, "content_type", "page").where("content_type is not null").select(F.lower("content_type").alias("capability"), "page")
    there = table(spark, d, "text_labels").select(F.col("label").alias("capability")).distinct()
    return asked.join(F.broadcast(there), "capability", "left_anti").groupBy("capability").agg(F.count_distinct("page").alias("pages"), F.min("page").alias("first_page"), F.lit("missing").alias("severity"))


@query
def verdict_scores(spark, d):
    """Annotators against the majority: is a text junk? True and false positives and negatives, and the share right."""
    t = table(spark, d, "text_labels").select("src_table", "rec_key", "annotator", "label").distinct()
    votes = t.groupBy("src_table", "rec_key", "label").agg(F.count("*").alias("n"))
    golden = votes.groupBy("src_table", "rec_key").agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("golden"))
    j = t.join(golden, ["src_table", "rec_key"]).select("annotator", (F.col("label") == "junk").alias("said"), (F.col("golden") == "junk").alias("is"))
    n = lambda c: F.sum(c.cast("int"))
    said, is_ = F.col("said"), F.col("is")
    out = j.groupBy("annotator").agg(n(said & is_).alias("tp"), n(~said & ~is_).alias("tn"), n(said & ~is_).alias("fp"), n(~said & is_).alias("fn"))
    return out.withColumn("score", F.round((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")), 4))


@query
def node_errors(spark, d):
    """Errors of a section graph: doubled ids, targets without a section, endings with choices, other sections without any."""
    g = table(spark, d, "gamebook_sections").where("deleted_at is null").select("section_key", "run_id", rf.section_key(F.col("section_id")).alias("node"), "end_game", "sequence").dropDuplicates(["section_key"])
    t = g.select("section_key", "run_id", F.explode("sequence").alias("e")).where("e.kind = 'choice'").select("section_key", "run_id", rf.section_key(F.col("e.targetSection")).alias("node")).where("node is not null").distinct()
    known = g.select("run_id", "node").distinct()
    lost = t.join(known, ["run_id", "node"], "left_anti").select("section_key", F.concat(F.lit("target not found: "), "node").alias("error"))
    chosen = g.join(t.select("section_key").distinct().withColumn("goes", F.lit(True)), "section_key", "left").withColumn("goes", F.coalesce("goes", F.lit(False)))
    ends = chosen.where("end_game and goes").select("section_key", F.lit("ending with choices").alias("error"))
    stops = chosen.where("not end_game and not goes").select("section_key", F.lit("no choices").alias("error"))
    twice = g.join(g.groupBy("run_id", "node").agg(F.min("section_key").alias("first")), ["run_id", "node"]).where("section_key > first").select("section_key", F.lit("duplicate id").alias("error"))
    return lost.unionByName(ends).unionByName(stops).unionByName(twice)


@query
def expected_ranges(spark, d):
    """Expected first and last section of each run from its portions' count and their modules' notes."""
    p = _portions(spark, d).groupBy("run_id").agg(F.max(rf.section_key(F.col("section_id")).try_cast("int")).alias("n"))
    low, high = se.expected_range(F.col("n"), F.when(F.col("n") % 2 == 0, F.concat(F.lit("sections 1-"), F.col("n"))))
    return p.select("run_id", low.alias("low"), high.alias("high"))


@query
def portion_page_text(spark, d):
    """Pages and characters that each portion takes from the pages it spans; pages that are missing give nothing."""
    p = rl.pages_of_spans(_portions(spark, d).select("portion_key", "run_id", "page_start", "page_end"), "page_start", "page_end", "page")
    t = _latest_pages(spark, d).select("run_id", "page", F.length(tx.strip_tags(F.col("html"))).alias("chars"))
    return p.join(t, ["run_id", "page"], "left").groupBy("portion_key").agg(F.count("chars").alias("pages"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"))
