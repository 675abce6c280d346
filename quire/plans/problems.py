"""Queries of the general data problems (nested records, dead references, intervals)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import intervals as iv
from quire.operators import nested as ne
from quire.operators import references as rf
from quire.session import cut
from quire.sources.tables import table

# --- nested records -------------------------------------------------------------


#: SQL of the fights of an unwrapped raw record.
RAW_FIGHTS = """coalesce(try_variant_get(j, '$.combat', 'variant'),
  try_variant_get(j, '$.data.portion.combat', 'variant'),
  try_variant_get(j, '$.portion.combat', 'variant'),
  try_variant_get(j, '$.data.combat', 'variant'))"""


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Every child of the nested fields with its parent's key and places."""
    typed = table(spark, d, "enriched_portions").select(F.col("portion_key").alias("parent_key"), F.col("combat.enemies").alias("e"))
    enemy = ne.explode_arrow(typed, "e", ["pos1", "pos2"], "v").select(F.lit("enemy").alias("child"), "parent_key", "pos1", "pos2")

    raw = ne.unwrap_json(table(spark, d, "raw_portions").select(F.col("raw_key").alias("parent_key"), "record"), "record", "j")
    raw = raw.select("parent_key", F.expr(RAW_FIGHTS).alias("fights"))
    raw = raw.select("parent_key", F.expr(f"""transform({ne.entries_sql('fights')}, f -> named_struct('pos', f.pos, 'in',
        transform(case when coalesce(schema_of_variant(try_variant_get(f.v, '$.enemies', 'variant')), 'VOID') <> 'VOID' then {ne.entries_sql("try_variant_get(f.v, '$.enemies', 'variant')")}
                       when try_variant_get(f.v, '$.enemy', 'variant') is not null then array(named_struct('pos', 0L, 'v', f.v)) end,
                  e -> named_struct('pos', e.pos, 'there', case when {ne.has_fields_sql('e.v')} then true end))))""").alias("f"))  # fmt: skip
    fights = ne.explode_arrow(raw, "f", ["__p"], "v").select("parent_key", F.col("v.pos").alias("pos1"), F.col("v.in").alias("e"))
    raw_enemy = ne.explode_arrow(fights, "e", ["__p"], "v").where("v.there").select(F.lit("raw_enemy").alias("child"), "parent_key", "pos1", F.col("v.pos").alias("pos2"))

    issues = ne.unwrap_json(table(spark, d, "pipeline_issues").select(F.col("report_key").alias("parent_key"), "summary"), "summary", "j")
    issues = issues.select("parent_key", F.expr("try_variant_get(j, '$.flagged_genealogy_chapters', 'variant')").alias("c"))
    issues = issues.select("parent_key", F.expr(f"""transform({ne.entries_sql('c')}, x -> named_struct('pos', x.pos,
        'there', case when {ne.has_fields_sql('x.v')} then true end,
        'in', transform({ne.entries_sql("try_variant_get(x.v, '$.source_page_details', 'variant')")},
                        e -> named_struct('pos', e.pos, 'there', case when {ne.has_fields_sql('e.v')} then true end))))""").alias("c"))  # fmt: skip
    chapters = ne.explode_arrow(issues, "c", ["__p"], "v").where("v.there").select("parent_key", F.col("v.pos").alias("pos1"), F.col("v.in").alias("e"))
    chapter = chapters.select(F.lit("chapter").alias("child"), "parent_key", "pos1", F.lit(-1).cast("long").alias("pos2"))
    page = ne.explode_arrow(chapters, "e", ["__p"], "v").where("v.there").select(F.lit("chapter_page").alias("child"), "parent_key", "pos1", F.col("v.pos").alias("pos2"))
    return enemy.unionByName(raw_enemy).unionByName(chapter).unionByName(page).distinct()


def p4_enemies(spark: SparkSession, d: str) -> DataFrame:
    """Flat enemy table of the typed portions, linked by portion_key and places."""
    src = table(spark, d, "enriched_portions").select("portion_key", F.col("combat.enemies").alias("e"))
    flat = ne.explode_arrow(src, "e", ["fight_pos", "enemy_pos"], "v")
    return flat.select("portion_key", "fight_pos", "enemy_pos", "v.enemy", "v.skill", "v.stamina", "v.armour", "v.firepower", "v.speed").distinct()


def p4_raw_enemies(spark: SparkSession, d: str) -> DataFrame:
    """Flat enemy table of the raw portions in all their shapes, linked by raw_key and places."""
    src = ne.unwrap_json(table(spark, d, "raw_portions").select("raw_key", "record"), "record", "j").select("raw_key", F.expr(RAW_FIGHTS).alias("f"))
    fights = ne.explode_shaped(src, "f", "raw_key", "fight_pos", "v").withColumn("f", F.expr("try_parse_json(v)"))
    inner = "try_variant_get(f, '$.enemies', 'variant')"
    enemies = F.expr(f"case when coalesce(schema_of_variant({inner}), 'VOID') <> 'VOID' then {inner} when try_variant_get(f, '$.enemy', 'variant') is not null then f end")
    flat = ne.explode_shaped(fights.select(F.struct("raw_key", "fight_pos").alias("at"), enemies.alias("e")), "e", "at", "enemy_pos", "v")
    number = lambda k: F.get_json_object("v", f"$.{k}").try_cast("double").try_cast("int").alias(k)
    enemy = F.coalesce(F.get_json_object("v", "$.enemy"), F.expr("case when v like '\"%' then try_variant_get(try_parse_json(v), '$', 'string') end"))
    return flat.select(
        "at.raw_key", "at.fight_pos", "enemy_pos", enemy.alias("enemy"), number("skill"), number("stamina"), number("armour"), number("firepower"),
        F.get_json_object("v", "$.speed").alias("speed"), F.get_json_object("v", "$.special").alias("special"),
    ).distinct()


def p4_choices(spark: SparkSession, d: str) -> DataFrame:
    """Flat choice table of the typed portions."""
    src = table(spark, d, "enriched_portions").select("portion_key", "choices")
    flat = ne.explode_arrow(src, "choices", ["choice_pos"], "v")
    return flat.select("portion_key", "choice_pos", "v.target", F.col("v.text").alias("choice_text")).distinct()


def p4_chapters(spark: SparkSession, d: str) -> DataFrame:
    """Flat chapter table of the issue reports; name and drift score where the entry has them."""
    src = ne.unwrap_json(table(spark, d, "pipeline_issues").select("report_key", "summary"), "summary", "j")
    src = src.select("report_key", F.expr("try_variant_get(j, '$.flagged_genealogy_chapters', 'variant')").alias("c"))
    flat = ne.explode_shaped(src, "c", "report_key", "chapter_pos", "v")
    return flat.select(
        "report_key", "chapter_pos",
        F.coalesce(F.get_json_object("v", "$.chapter_basename"), F.expr("case when v like '\"%' then try_variant_get(try_parse_json(v), '$', 'string') end")).alias("chapter_basename"),
        F.get_json_object("v", "$.drift_score").cast("double").alias("drift_score"),
    ).distinct()


def p4_chapter_pages(spark: SparkSession, d: str) -> DataFrame:
    """Flat table of the source pages of flagged chapters, linked by report_key and places."""
    src = ne.unwrap_json(table(spark, d, "pipeline_issues").select("report_key", "summary"), "summary", "j")
    src = src.select("report_key", F.expr("try_variant_get(j, '$.flagged_genealogy_chapters', 'variant')").alias("c"))
    chapters = ne.explode_shaped(src, "c", "report_key", "chapter_pos", "v")
    pages = chapters.select(F.struct("report_key", "chapter_pos").alias("at"), F.expr("try_variant_get(try_parse_json(v), '$.source_page_details', 'variant')").alias("p"))
    flat = ne.explode_shaped(pages, "p", "at", "page_pos", "v")
    field = lambda path, kind: F.get_json_object("v", f"$.{path}").try_cast(kind).alias(path.rpartition(".")[2])
    return flat.select("at.report_key", "at.chapter_pos", "page_pos", field("page_number", "int"), field("metrics.table_count", "int"), field("metrics.coarse_suspect", "boolean")).distinct()


# --- dead references ------------------------------------------------------------


def _references(spark: SparkSession, d: str) -> DataFrame:
    portions = table(spark, d, "enriched_portions").select(F.col("portion_key").alias("src_key"), "run_id", "loaded_at", F.posexplode("choices.target").alias("ref_pos", "target"))
    events = table(spark, d, "gamebook_sections").select(F.col("section_key").alias("src_key"), "run_id", "loaded_at", F.posexplode("sequence").alias("ref_pos", "ev"))
    events = events.where("ev.kind = 'choice'").select("src_key", "run_id", "loaded_at", "ref_pos", F.col("ev.targetSection").alias("target"))
    both = portions.withColumn("src_table", F.lit("enriched_portions")).unionByName(events.withColumn("src_table", F.lit("gamebook_sections")))
    both = both.select("src_table", "src_key", F.col("ref_pos").cast("long").alias("ref_pos"), "run_id", rf.section_key(F.col("target")).alias("section"), "loaded_at")
    return both.where("section is not null").dropDuplicates(["src_table", "src_key", "ref_pos"])


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gamebook_sections").select("run_id", rf.section_key(F.col("section_id")).alias("section"), "loaded_at", "deleted_at")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """References that point to no section of their run at the time of the referring row."""
    dead = rf.orphan_references(_sections(spark, d), _references(spark, d), ["run_id", "section"])
    return dead.select("src_table", "src_key", "ref_pos")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Dead references and distinct dead targets per table and month."""
    dead = rf.orphan_references(_sections(spark, d), _references(spark, d), ["run_id", "section"])
    per_key = dead.groupBy("src_table", F.date_format("loaded_at", "yyyy-MM").alias("month"), "run_id", "section").agg(F.count("*").alias("n"))
    return per_key.groupBy("src_table", "month").agg(F.sum("n").alias("dead_references"), F.count("*").alias("dead_targets"))


def p5_state(spark: SparkSession, d: str) -> DataFrame:
    """Current dead targets of every run with their number of references, from counts kept over two batches of changes."""
    keys = ["run_id", "section"]
    events = cut(rf.change_events(_sections(spark, d), _references(spark, d), keys))
    # Two deliveries: all changes up to the middle of the period, then those after it.
    middle = events.agg(F.expr("timestamp_micros(div(unix_micros(min(at)) + unix_micros(max(at)), 2))").alias("m")).first()["m"]
    _, state = rf.advance(rf.no_counts(events, keys), events.where(F.col("at") <= F.lit(middle)), keys)
    _, state = rf.advance(cut(state), events.where(F.col("at") > F.lit(middle)), keys)
    return rf.current_orphans(state).select(*keys, "refs")


# --- intervals ------------------------------------------------------------------


def _boundary_spans(spark: SparkSession, d: str) -> DataFrame:
    el = table(spark, d, "elements_core_content_types_rubric_v1").select("run_id", "id", "seq").dropna().groupBy("run_id", "id").agg(F.min("seq").alias("seq"))
    last = el.groupBy("run_id").agg(F.max("seq").alias("last_seq"))
    b = table(spark, d, "section_boundaries_scan").select("boundary_key", "run_id", "start_element_id", "end_element_id").dropDuplicates(["boundary_key"])
    b = b.join(el.select("run_id", F.col("id").alias("start_element_id"), F.col("seq").alias("start_seq")), ["run_id", "start_element_id"])
    b = b.join(el.select("run_id", F.col("id").alias("end_element_id"), F.col("seq").alias("end_seq")), ["run_id", "end_element_id"], "left")
    b = b.where("end_element_id is null or end_seq is not null")
    # One row per start: its furthest end, and whether one of its boundaries is open.
    starts = cut(b.groupBy("run_id", "start_seq").agg(F.max("end_seq").alias("end_seq"), F.max(F.col("end_element_id").isNull()).alias("open")))
    starts = iv.next_start(starts, ["run_id"], "start_seq", "next_seq").join(last, "run_id")
    open_seq = F.when(F.col("open"), F.coalesce(F.col("next_seq") - 1, F.col("last_seq")))
    return starts.select("run_id", "start_seq", F.greatest("end_seq", open_seq).alias("end_seq"))


def _macro_spans(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "sections_structured_stub").select("run_id", F.explode("macro_sections").alias("m"))
    return m.select("run_id", "m.start_seq", "m.end_seq")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Continuous spans of a run's sections and the gaps between them, for both section tables."""
    rows = _boundary_spans(spark, d).withColumn("src_table", F.lit("boundaries")).unionByName(_macro_spans(spark, d).withColumn("src_table", F.lit("macro")))
    rows = rows.where("run_id is not null")
    keys = ["src_table", "run_id"]
    spans = iv.merge_intervals(rows, keys, "start_seq", "end_seq")
    gaps = iv.gaps_between(spans, keys, "start_seq", "end_seq")
    cols = ["src_table", "run_id", "kind", "start_seq", "end_seq"]
    return spans.withColumn("kind", F.lit("span")).select(*cols).unionByName(gaps.withColumn("kind", F.lit("gap")).select(*cols))


QUERIES = {
    "p4_found": p4_found,
    "p4_enemies": p4_enemies,
    "p4_raw_enemies": p4_raw_enemies,
    "p4_choices": p4_choices,
    "p4_chapters": p4_chapters,
    "p4_chapter_pages": p4_chapter_pages,
    "p5_found": p5_found,
    "p5_report": p5_report,
    "p5_state": p5_state,
    "p6_found": p6_found,
}
