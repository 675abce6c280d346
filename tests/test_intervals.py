from __future__ import annotations

import random

from quire.operators import intervals as iv


def brute(rows):
    spans = []
    for s, e in sorted((s, e) for s, e in rows if s is not None and e is not None and s <= e):
        if spans and s <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    gaps = [(a[1] + 1, b[0] - 1) for a, b in zip(spans, spans[1:])]
    return [tuple(x) for x in spans], gaps


def test_merge_equals_brute_force_over_shard_borders(spark):
    rng = random.Random(3)
    rows = []
    for key in ("a", "b", None):
        for _ in range(120):
            s = rng.randrange(-40, 400)
            rows.append((key, s, s + rng.choice([0, 1, 3, 9, 40, 130, -2])))
    rows += [("a", None, 5), ("a", 5, None), ("c", 7, 3), ("d", 0, 4095)] + rows[:20]
    df = spark.createDataFrame(rows, "k string, s long, e long")
    spans = iv.merge_intervals(df, ["k"], "s", "e", width=16)
    gaps = iv.gaps_between(spans.where("k is not null"), ["k"], "s", "e", width=16)
    for key in ("a", "b", "d"):
        want_s, want_g = brute([(s, e) for k, s, e in rows if k == key])
        assert sorted((r.s, r.e) for r in spans.where(f"k = '{key}'").collect()) == want_s
        assert sorted((r.s, r.e) for r in gaps.where(f"k = '{key}'").collect()) == want_g
    assert spans.where("k = 'c'").count() == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, s long, e long")
    spans = iv.merge_intervals(df, ["k"], "s", "e")
    assert spans.count() == 0 and iv.gaps_between(spans, ["k"], "s", "e").count() == 0


def test_next_start_over_shards(spark):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 40, 41, 500)], "k string, n long")
    got = {r.n: r.nx for r in iv.next_start(df, ["k"], "n", "nx", width=8).collect()}
    assert got == {1: 2, 2: 40, 40: 41, 41: 500, 500: None}
