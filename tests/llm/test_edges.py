from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.llm import bpe, pii, quality, queries, scannoise
from tests import edge_tables as et

pytestmark = pytest.mark.skipif(not et.SOURCE.exists(), reason="no data folder here")


def test_empty_tables_give_empty_results(spark, tmp_path):
    d = et.emptied(spark, tmp_path)
    for name, query in queries.QUERIES.items():
        if name != "p8_fill":
            assert query(spark, d).count() == 0, name


def test_clashing_columns_nulls_and_copies_change_nothing(spark, tmp_path):
    d = et.messy(spark, tmp_path)
    for name in ("p1_found", "p2_found", "p3_found"):
        want = {str(r) for r in queries.QUERIES[name](spark, str(et.SOURCE)).collect()}
        assert {str(r) for r in queries.QUERIES[name](spark, d).collect()} == want, name
    want = {str(r) for r in queries.p9_found(spark, str(et.SOURCE)).collect()}
    assert {str(r) for r in queries.p9_found(spark, d).collect()} == want
    ids = {r.doc_id: r.ids for r in queries.p7_ids(spark, d).collect()}
    assert ids.pop(None) == [] and ids == {r.doc_id: r.ids for r in queries.p7_ids(spark, str(et.SOURCE)).collect()}


def test_very_long_texts(spark):
    sentence = "You lift the lan-\ntern at 12 Old Ash Street, Bramby; write to ann.lee@mail.example. "
    long = sentence * 20_000
    df = spark.createDataFrame([(1, long), (2, "=" * 300_000), (3, "x" * 300_000), (4, " " * 300_000)], "doc_id long, text string")
    assert {r.doc_id for r in bpe.count_column(df, "doc_id", "text", "n").where("n > 0").collect()} == {1, 2, 3, 4}
    got = {(r.kind, r.value) for r in pii.find(df, "doc_id", "text").collect()}
    assert got == {("address", "12 Old Ash Street"), ("email", "ann.lee@mail.example")}
    rows = quality.vote_rows(df, "element", "doc_id", "text", frozenset({"you", "the", "at", "to"}), html=False)
    assert rows.count() == 4
    df = df.withColumn("run_id", F.lit("r")).withColumn("book_id", F.lit("b")).withColumn("page", F.lit(1))
    seen = scannoise.scan(df, "element", "doc_id", "text", frozenset({"you", "the", "lift", "at", "to", "write"}), html=False)
    assert [(r.a, r.b, list(r["keys"])) for r in seen.where("kind = 'h'").collect()] == [("lan", "tern", [1])]
