from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.operators import graph as gr
from quire.operators import relational as rl
from quire.operators import scoring as sc
from quire.operators import sequences as sq
from quire.operators import stateful as st


def test_coarse_span_kept_or_dropped(spark):
    fine = spark.createDataFrame([("r", 1, 1, 2)], "run string, key int, s int, e int")
    coarse = spark.createDataFrame([("r", 2, 1, 4)], "run string, key int, s int, e int")
    got = rl.merge_fine_coarse(fine, coarse, ["run"], "key", "s", "e", 0.5).collect()
    assert sorted((r.key, r.origin) for r in got) == [(1, "fine"), (2, "coarse")]
    full = spark.createDataFrame([("r", 1, 1, 4)], "run string, key int, s int, e int")
    assert [r.key for r in rl.merge_fine_coarse(full, coarse, ["run"], "key", "s", "e", 0.5).collect()] == [1]


def test_first_row_wins_and_blank_keys_fall_back(spark):
    a = spark.createDataFrame([("k", 1), ("", 2), ("", 2)], "key string, n int")
    b = spark.createDataFrame([("k", 0), ("m", 5)], "key string, n int")
    got = rl.first_per_key([a, b], F.col("key"), "n").collect()
    assert sorted((r.key, r.n, r.source_no) for r in got) == [("", 2, 0), ("k", 1, 0), ("m", 5, 1)]


def test_ties_go_to_the_first(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 2, 0.9), ("a", 3, 0.1), (None, 4, 0.5)], "k string, i int, c double")
    got = {r.k: r.i for r in rl.best_row(df, ["k"], [-F.col("c"), F.col("i")]).collect()}
    assert got == {"a": 1, None: 4}


def test_unclaimed(spark):
    links = spark.createDataFrame([("1", "10"), ("1", "20"), ("1", None)], "s string, t string")
    claims = spark.createDataFrame([("1", "10")], "s string, t string")
    assert [(r.s, r.t) for r in rl.unclaimed(links, claims, ["s", "t"]).collect()] == [("1", "20")]


def test_page_numbers(spark):
    rows = [("r", p, n) for p, n in [(1, None), (2, 2), (3, None), (4, 4), (5, None), (6, 9), (7, None)]]
    df = spark.createDataFrame(rows, "run string, page int, n int")
    got = [r.x for r in sq.fill_page_numbers(df, ["run"], "page", "n", "x").orderBy("page").collect()]
    assert got == [1, 2, 3, 4, None, 9, 10]


def test_reachability_and_confusions(spark):
    edges = spark.createDataFrame([("r", a, b) for a, b in [("1", "2"), ("2", "3"), ("3", "1"), ("9", "3")]], "run string, src string, dst string")
    starts = spark.createDataFrame([("r", "1")], "run string, node string")
    assert {(x.node, x.depth) for x in gr.reachable(edges, starts, ["run"], "src", "dst", "node").collect()} == {("1", 0), ("2", 1), ("3", 2)}
    got = {x.c for x in gr.digit_confusions(spark.createDataFrame([("10",)], "n string"), "n", "c").collect()}
    assert got == {"70", "19"}


def test_pareto_front(spark):
    rows = [("a", 0.9, 10.0, 1.0), ("b", 0.8, 20.0, 2.0), ("c", 0.7, 5.0, 5.0), ("d", 0.1, None, 1.0), ("e", 0.9, 10.0, 1.0)]
    df = spark.createDataFrame(rows, "m string, q double, l double, c double")
    assert {r.m for r in sc.pareto_front(df, "m", "q", ["l", "c"], buckets=3).collect()} == {"a", "c", "d", "e"}


def test_greedy_intervals_and_scan(spark):
    rows = [("r", 1, 1, 5, 0.9), ("r", 2, 4, 8, 0.95), ("r", 3, 9, 9, 0.1), ("r", 4, None, 3, 1.0)]
    df = spark.createDataFrame(rows, "run string, key int, s int, e int, c double")
    assert {r.key for r in st.greedy_intervals(df, "run", "key", "s", "e", "c").collect()} == {2, 3}


def test_sequential_scan(spark):
    def kept(rows):
        df = spark.createDataFrame([("r", i, p, n) for i, (p, n) in enumerate(rows)], "run string, key int, p int, n int")
        return [(r.p, r.n) for r in st.sequential_scan(df, "run", "key", "p", "n").orderBy("p", "n").collect()]

    assert kept([(1, 1), (1, 2), (1, 40), (2, 3), (2, 90), (3, 4)]) == [(1, 1), (1, 2), (2, 3), (3, 4)]  # a jump within a page is stray
    assert kept([(1, 1), (2, 90)]) == [(1, 1), (2, 90)]  # on a later page it stands
    assert kept([(37, 90), (37, 97), (38, 93), (38, 94)]) == [(37, 90), (38, 93), (38, 94)]  # a small step back takes the stray one's place
    assert kept([(1, 5), (2, 5), (9, 4)]) == [(1, 5)] and kept([]) == []


def test_document_order_is_not_that_of_ids(spark, tmp_path):
    from quire.plans import reference as rf

    elements = [(1, "r", "001-2", 0, 1), (2, "r", "001-1", 1, 1), (3, "r", "001-3", 2, 1)]
    spark.createDataFrame(elements, "element_key long, run_id string, id string, seq long, page int").write.parquet(str(tmp_path / f"{rf.ELEMENTS}.parquet"))
    rows = [(1, "r", "1", "001-2", 0.9), (2, "r", "2", "001-1", 0.9), (3, "r", "3", "001-3", 0.9), (4, "r", "9", "nowhere", 0.9), (5, "r", "1", "001-1", 0.88)]
    b = spark.createDataFrame(rows, "boundary_key long, run_id string, section_id string, start_element_id string, confidence double")
    for c, t in (("end_element_id", "string"), ("start_page", "int"), ("start_line_idx", "int"), ("method", "string")):
        b = b.withColumn(c, F.lit(None).cast(t))
    b.write.parquet(str(tmp_path / "section_boundaries_scan.parquet"))
    d = str(tmp_path)
    assert {(r.boundary_key, r.next_start) for r in rf.boundary_spans_next_start(spark, d).collect()} == {(1, "001-1"), (2, "001-1"), (5, "001-3"), (3, "nowhere"), (4, None)}
    assert {(r.boundary_key, r.previous) for r in rf.ordering_conflicts(spark, d).collect()} == {(5, 2)}
    assert {r.boundary_key for r in rf.keep_earliest_within_50(spark, d).collect()} == {1, 2, 3, 4}


def test_reachable_has_no_depth_limit(spark):
    edges = spark.createDataFrame([("r", str(i), str(i + 1)) for i in range(60)], "run string, src string, dst string")
    from quire.operators import graph as gr

    got = gr.reachable(edges, spark.createDataFrame([("r", "0")], "run string, node string"), ["run"], "src", "dst", "node", depth=None)
    assert got.agg({"depth": "max"}).first()[0] == 60 and got.count() == 61


def test_previous_event_of_any_kind(spark, tmp_path):
    from quire.plans import reference2 as r2

    kinds = ["a", "a", "b", "new kind", "new kind", "a", "a"]
    spark.createDataFrame([(i, 1, i, k) for i, k in enumerate(kinds)], "event_id long, user_id long, ts long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    got = {r.event_id: r.previous_id for r in r2.previous_event(spark, str(tmp_path)).collect()}
    assert got == {0: None, 1: None, 2: 1, 3: 2, 4: 2, 5: 4, 6: 4}


def test_repeated_pages_compare_with_kept_ones_only(spark):
    text = "one two three four five six seven"
    rows = [("r", 1, 1, text), ("r", 2, 2, text), ("r", 3, 3, None), ("r", 4, 4, text + " eight")]
    got = st.repeated_pages(spark.createDataFrame(rows, "run string, k int, p int, t string"), "run", "k", "p", "t", threshold=0.85).collect()
    assert sorted((r.k, r.of) for r in got) == [(2, 1), (4, 1)]


def test_hot_join_is_a_plain_inner_join(spark):
    rows = [("hot", i) for i in range(3_000)] + [(f"k{i}", i) for i in range(1_500)] + [(None, 1)]
    many = spark.createDataFrame(rows, "k string, v long")
    one = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k7", "c"), ("absent", "d"), (None, "e")], "k string, w string")
    got = sorted((r.k, r.v, r.w) for r in rl.hot_join(many, one, ["k"]).collect())
    assert got == sorted([("hot", i, w) for i in range(3_000) for w in "ab"] + [("k7", 7, "c")])
    assert rl.hot_join(many.limit(0), one, ["k"]).count() == 0 == rl.hot_join(many, one.limit(0), ["k"]).count()


def test_lag_in_slices_is_a_plain_lag(spark):
    from pyspark.sql import Window

    from quire.operators import sequences as sq

    rows = [(s, i, f"v{i}" if i % 7 else None) for s, ids in (("a", range(0, 400, 3)), ("b", [5, 250, 251, 900]), ("c", [1])) for i in ids]
    df = spark.createDataFrame(rows, "s string, i long, v string")
    want = {(r.s, r.i, r.p) for r in df.withColumn("p", F.lag("v").over(Window.partitionBy("s").orderBy("i"))).collect()}
    assert {(r.s, r.i, r.p) for r in sq.lag_in_slices(df, ["s"], "i", "v", "p", width=40).collect()} == want
    assert sq.lag_in_slices(df.limit(0), ["s"], "i", "v", "p").count() == 0


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    from quire import session

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                return type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isEmpty": staticmethod(lambda: True)}))})

    spark = type("Session", (), {"sparkContext": Context, "conf": type("Conf", (), {"get": staticmethod(lambda *_: None)})})
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(spark)
