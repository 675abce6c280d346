from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quire.operators import nested as ne
from quire.plans import problems, reference4
from tests import edge_tables as et


def test_two_levels_keep_places(spark):
    rows = [(1, [None, [{"a": 1}, None, {"a": None}], []]), (2, None), (3, []), (4, [[{"a": 7}]])]
    df = spark.createDataFrame(rows, "k int, v array<array<struct<a:int>>>").withColumn("extra", F.lit("x"))
    got = ne.explode_arrow(df, "v", ["p", "q"], "e").collect()
    assert sorted((r.k, r.p, r.q, r.e.a, r.extra) for r in got) == [(1, 1, 0, 1, "x"), (4, 0, 0, 7, "x")]


def things(spark, doc):
    df = ne.unwrap_json(spark.createDataFrame([(1, doc)], "k int, j string"), "j", "v")
    return sorted((r.p, r.x) for r in ne.explode_shaped(df, "v", "k", "p", "x").collect())


def test_shapes(spark):
    assert things(spark, json.dumps([{"a": 1}, None, {}, {"b": None}, "s"])) == [(0, '{"a":1}'), (4, '"s"')]
    assert things(spark, json.dumps({"a": 1})) == [(0, '{"a":1}')]
    assert things(spark, json.dumps({"0": {"a": 1}, "2": {"b": 2}})) == [(0, '{"a":1}'), (2, '{"b":2}')]
    assert things(spark, json.dumps(json.dumps([{"a": 1}]))) == [(0, '{"a":1}')]
    assert things(spark, "3") == [] and things(spark, "{broken") == [] and things(spark, None) == [] and things(spark, "[]") == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, v array<struct<a:int>>")
    assert ne.explode_arrow(df, "v", ["p"], "e").count() == 0


def test_flat_tables_of_every_shape(spark, tmp_path):
    goblin = {"enemy": "GOBLIN", "skill": "7", "stamina": 5}
    records = [{"combat": [{"enemies": [goblin, None, {"enemy": "OGRE"}]}]}, {"data": {"portion": {"combat": {"enemies": goblin}}}}, {"portion": {"combat": [None, goblin]}}, {"data": {"combat": [{"enemies": {"2": goblin}}]}}, {"combat": 3}]
    raw = [(k, json.dumps(r)) for k, r in enumerate(records)] + [(9, "{broken"), (10, json.dumps(json.dumps(records[1])))]
    spark.createDataFrame(raw, "raw_key long, record string").write.parquet(str(tmp_path / "raw_portions.parquet"))
    got = {tuple(r)[:6] for r in problems.p4_raw_enemies(spark, str(tmp_path)).collect()}
    g = ("GOBLIN", 7, 5)
    assert got == {(0, 0, 0, *g), (0, 0, 2, "OGRE", None, None), (1, 0, 0, *g), (2, 1, 0, *g), (3, 0, 2, *g), (10, 0, 0, *g)}
    page = {"page_number": 4, "metrics": {"table_count": 2, "coarse_suspect": True}}
    flagged = [[{"reasons": ["a", "b"], "source_page_details": [page, None, page]}, "x.html"], {"reasons": ["a"], "source_page_details": page}, 3, None]
    issues = [(k, json.dumps({"flagged_genealogy_chapters": f})) for k, f in enumerate(flagged)]
    spark.createDataFrame(issues, "report_key long, summary string").write.parquet(str(tmp_path / "pipeline_issues.parquet"))
    pages = {tuple(r) for r in problems.p4_chapter_pages(spark, str(tmp_path)).collect()}
    assert pages == {(0, 0, 0, 4, 2, True), (0, 0, 2, 4, 2, True), (1, 0, 0, 4, 2, True)}
    assert {tuple(r) for r in reference4.weighted_reasons(spark, str(tmp_path)).collect()} == {("a", 2), ("b", 1)}


@pytest.mark.skipif(not et.SOURCE.exists(), reason="no data folder here")
def test_flat_tables_have_the_children_found(spark):
    d = str(et.SOURCE.parent / "sf0.01")
    found = problems.p4_found(spark, d).collect()
    for child, flat in (("raw_enemy", problems.p4_raw_enemies), ("chapter_page", problems.p4_chapter_pages)):
        want = {tuple(r)[1:] for r in found if r.child == child}
        assert want and {tuple(r)[:3] for r in flat(spark, d).collect()} == want
