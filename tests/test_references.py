from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from quire.operators import references as rf


def t(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def test_orphans_equal_brute_force(spark):
    rng = random.Random(5)
    recs, refs = [], []
    for i in range(300):
        at = rng.randrange(0, 200)
        gone = at + rng.randrange(-3, 60) if rng.random() < 0.5 else None
        recs.append((rng.choice("xyz"), t(at), None if gone is None else t(gone)))
    for i in range(400):
        refs.append((i, rng.choice("xyzw"), t(rng.randrange(0, 260))))
    refs += [(1000, None, t(3)), (1001, "x", None)]
    records = spark.createDataFrame(recs + recs[:9], "k string, loaded_at timestamp, deleted_at timestamp")
    asked = spark.createDataFrame(refs, "id int, k string, loaded_at timestamp")
    got = {r.id for r in rf.orphan_references(records, asked, ["k"]).collect()}
    want = {i for i, k, at in refs if k and at and not any(a == k and l <= at and (d is None or d > at) for a, l, d in recs)}
    assert got == want


def test_kept_counts_equal_a_full_computation(spark):
    """Random batches in order of time: the orphans of all batches and the last report are those of the whole history."""
    rng = random.Random(11)
    recs, refs = [], []
    for _ in range(250):
        at = rng.randrange(0, 200)
        gone = at + rng.randrange(-3, 60) if rng.random() < 0.5 else None
        recs.append((rng.choice("uvxyz"), t(at), None if gone is None else t(gone)))
    refs = [(rng.choice("uvxyzw"), t(rng.randrange(0, 260))) for _ in range(300)]
    records = spark.createDataFrame(recs, "k string, loaded_at timestamp, deleted_at timestamp")
    asked = spark.createDataFrame(refs, "k string, loaded_at timestamp")
    events = rf.change_events(records, asked, ["k"])
    state, found = rf.no_counts(events, ["k"]), set()
    edges = [0, *sorted(rng.sample(range(1, 400), 3)), 400]
    for low, high in zip(edges, edges[1:]):
        batch = events.where((F.col("at") >= F.lit(t(low))) & (F.col("at") < F.lit(t(high))))
        dead, state = rf.advance(state, batch, ["k"])
        found |= {(r.k, r.loaded_at, r.refs) for r in dead.collect()}
        state = spark.createDataFrame(state.collect(), "k string, alive long, refs long")
    want = {(r.k, r.loaded_at, r.refs) for r in rf.orphan_times(records, asked, ["k"]).collect()}
    assert found == want and want
    alive = {k for k, at, gone in recs if gone is None}
    assert {r.k for r in rf.current_orphans(state).collect()} == {k for k, _ in refs} - alive


def test_section_names(spark):
    rows = ["16", " 16", "#section-16", "Section 16", "turn to 16", "(16)", "16.", "16.0", "§ 16", "016", "16 ", "１６", "Background ", " ", "", None, "0"]
    got = [r.s for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string").select("i", rf.section_key(F.col("x")).alias("s")).orderBy("i").collect()]
    assert got == ["16"] * 12 + ["background", None, None, None, "0"]


def test_empty_tables(spark):
    records = spark.createDataFrame([], "k string, loaded_at timestamp, deleted_at timestamp")
    asked = spark.createDataFrame([("a", t(0))], "k string, loaded_at timestamp")
    assert rf.orphan_references(records, asked, ["k"]).count() == 1
    assert rf.orphan_references(records, asked.limit(0), ["k"]).count() == 0


def test_reachable_without_bound_and_by_all_events(spark, tmp_path):
    from quire.plans import reference

    def event(kind, target=None, win=None, lose=None):
        return {"kind": kind, "targetSection": target, "outcomes": {"win": {"targetSection": win}, "lose": {"targetSection": lose}}}

    rows = [("r", str(i), True, [event("choice", str(i + 1))]) for i in range(1, 30)]
    rows += [("r", "30", True, [event("combat", None, "40", "section 41"), event("stat_change", "42")]), ("r", "40", True, None), ("r", "41", True, []), ("r", "42", False, [event("choice", "43")]), ("r", "43", True, None)]
    event_type = "struct<kind string, targetSection string, outcomes struct<win struct<targetSection string>, lose struct<targetSection string>>>"
    df = spark.createDataFrame(rows, f"run_id string, section_id string, is_gameplay_section boolean, sequence array<{event_type}>")
    df.selectExpr("*", "false as end_game", "cast(null as timestamp) as deleted_at").write.parquet(str(tmp_path / "gamebook_sections.parquet"))
    by_choice = {r.node: r.depth for r in reference.reachable_sections(spark, str(tmp_path)).collect()}
    assert by_choice == {str(i): i - 1 for i in range(1, 31)}
    assert {r.node: r.depth for r in reference.reachable_by_events(spark, str(tmp_path)).collect()} == by_choice | {"40": 30, "41": 30}
