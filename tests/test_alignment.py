from __future__ import annotations

import random
from itertools import product
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quire.functions import alignment as al
from quire.functions import text as tx
from quire.operators import choices as ch
from quire.operators import elements as em
from quire.operators import extract as ex
from quire.operators import stateful as st
from quire.operators import validate as va
from quire.sources import bundle, engines


def test_votes_and_outliers():
    assert al.disagreement(["abc"]) == 0.0 and al.disagreement(["abc", "abc"]) == 0.0
    assert al.outlier({"a": "the gate is cold", "b": "the gate is cold.", "c": "zzzz"}) == "c"
    assert al.outlier({"a": "x", "b": "y"}) is None
    assert al.vote_lines(["the gate is cold", "b"], ["the gate is cold.", "b"]) == ["the gate is cold.", "b"]
    assert al.fuse("tbe gate", "the gafe", frozenset({"the", "gate"})) == "the gate"


def test_tables_and_boxes():
    g = [["a", "b"], ["c", "d"]]
    assert al.row_likeness(["a", "b"], ["a", "bc"]) == 0.75 and al.row_likeness(["a"], ["a", "b", "c", "d"]) == 0.1
    assert al.match_tables([g, [["x"]]], [[["x"]], g]) == [(0, 1), (1, 0)]
    assert al.cell_score(g, g) == 1.0 and al.cell_score([], []) == 1.0
    assert al.row_count_score(4, 3) == 0.75 and al.column_score([3, 3, 2], [2, 2]) == 0.5
    assert al.match_boxes([(0, 0, 2, 2), (5, 5, 6, 6)], [(0, 0, 2, 2)]) == [(0, 0, 1.0)]
    assert al.inner_boxes([(0, 0, 10, 10), (1, 1, 3, 3)]) == [1]
    assert al.best_assignment([[0.1, 0.9], [0.9, 0.1]]) == [1, 0] and al.best_assignment([]) == []
    assert al.retention("a b c", "a b") == (False, 0.6667)


def test_rows_and_tables_aligned():
    assert al.table_alignment([["a", "b"], ["c", "d"]], [["a", "b"], ["x", "y"], ["c", "d"]]) == 1.0
    assert al.table_alignment([], []) == 1.0 and al.table_alignment([["a"]], []) == 0.0
    rng = random.Random(1)
    for _ in range(200):
        g, o = ([[rng.choice("abc"), rng.choice("xy")] for _ in range(rng.randint(0, 7))] for _ in range(2))
        best = [[0] * (len(o) + 1) for _ in range(len(g) + 1)]
        for i, j in product(range(len(g)), range(len(o))):
            best[i + 1][j + 1] = best[i][j] + 1 if al.row_likeness(g[i], o[j]) >= 0.75 else max(best[i][j + 1], best[i + 1][j])
        chain = al.aligned_rows(g, o, 0.75)
        assert len(chain) == best[-1][-1] and all(al.row_likeness(g[i], o[j]) >= 0.75 for i, j in chain)
        assert all(a < c and b < d for (a, b), (c, d) in zip(chain, chain[1:]))


def test_best_assignment_is_the_best_of_all():
    rng = random.Random(2)
    for _ in range(150):
        n, m = rng.randint(1, 5), rng.randint(1, 5)
        score = [[rng.choice([-0.5, 0, rng.random()]) for _ in range(m)] for _ in range(n)]
        worth = lambda cols: sum(score[i][j] + al.SAME_PLACE * (i == j) for i, j in enumerate(cols) if j >= 0)  # noqa: B023, E731
        every = [c for c in product(range(-1, m), repeat=n) if len({j for j in c if j >= 0}) == sum(j >= 0 for j in c)]
        assert abs(worth(al.best_assignment(score)) - max(map(worth, every))) < 1e-9
    big = [[float((7 * i) % 12 == j) for j in range(12)] for i in range(12)]
    assert al.best_assignment(big) == [(7 * i) % 12 for i in range(12)]


def test_columns_and_boxes(spark):
    x = [(1, 0.1 + i / 100) for i in range(5)] + [(1, 0.8 + i / 100) for i in range(5)] + [(2, 0.30), (2, 0.31), (2, 0.32), (2, 0.33), (2, 0.46), (2, 0.47), (2, 0.48), (2, 0.49)] + [(3, 0.1), (3, 0.9)]
    df = spark.createDataFrame([(g, i, v) for i, (g, v) in enumerate(x)], "g int, k int, x double")
    got = {(r.g, r.k): r.column for r in st.columns_of(df, ["g"], "k", "x").collect()}
    assert got == {(1, i): int(i >= 5) for i in range(10)} | {(2, i): int(i >= 14) for i in range(10, 18)} | {(3, 18): 0, (3, 19): 0}
    boxes = [(1, 0.0, 0.0, 100.0, 100.0), (2, 1.0, 1.0, 101.0, 101.0), (3, 0.0, 0.0, 150.0, 100.0), (4, 9.0, 9.0, 109.0, 109.0), (5, 11.0, 0.0, 111.0, 100.0)]
    b = spark.createDataFrame([("p", *r) for r in boxes], "g string, k int, x0 double, y0 double, x1 double, y1 double")
    assert {r.k for r in st.distinct_boxes(b, "g", "k").collect()} == {1, 3, 5}


def test_choices(spark):
    df = spark.createDataFrame([(1, '<p>If you run, turn\nto <a href="#16">16</a> or go to 61.</p>'), (2, None), (3, "")], "k int, html string")
    c = ch.candidates(df, "k", "html")
    assert {(r.k, r.target, r.evidence) for r in ch.best(c, "k").collect()} == {(1, 16, "anchor"), (1, 61, "go_to")}
    near = spark.createDataFrame([(1, 16, 18), (1, 16, 16), (1, 6, 16), (1, 99, 16)], "k int, t int, a int")
    assert {(r.t, r.a) for r in ch.near_anchor(near, ["k"], "t", "a").collect()} == {(16, 18), (6, 16)}


def test_extractors(spark):
    df = spark.createDataFrame([(1, "GOBLIN KING   SKILL 7\nSTAMINA 9. Lose ten points of\nstamina, gain 2 points of luck."), (2, None)], "k int, t string")
    assert [(r.enemy, r.skill, r.stamina) for r in ex.stat_blocks(df, "t").collect()] == [("GOBLIN KING", 7, 9)]
    assert [(r.amount, r.stat) for r in ex.stat_changes(df, "t").orderBy("place").collect()] == [(-10, "stamina"), (2, "luck")]


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_text_functions(spark):
    assert column(spark, ["I6", "S", "x", None, "1O"], tx.number_token) == ["16", "5", None, None, "10"]
    assert column(spark, ["splin-\ntered", "a - b"], tx.reflow_hyphens) == ["splintered", "a - b"]
    assert column(spark, ["The Old Gate!", "  "], tx.slug) == ["the-old-gate", ""]
    assert column(spark, ["THE OLD GATE", "A=B AND C", "Old"], tx.all_caps_heading) == [True, False, False]
    assert column(spark, ["a\na\nb", ""], tx.duplicate_line_share) == [0.3333, 0.0]
    assert column(spark, ["You have won a victory", "The end"], tx.ending_kind) == ["victory", "death"]
    assert column(spark, ["12\nText", "Text"], em.without_prefix) == ["Text", "Text"]
    assert column(spark, ["Table", "Other", None], em.kind_of) == ["table", "text", "text"]
    assert column(spark, ["@@##!!%%", "a plain line", "bcdfghjklm"], em.gibberish) == [True, False, True]


def test_patches_and_templates(spark):
    s = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, t string")
    p = spark.createDataFrame([("1", "remove", None, 1), ("2", "replace", "x", 1), ("2", "replace", "y", 2), ("3", "add", "z", 1), ("4", "replace", "q", 1)], "id string, op string, value string, patch_no int")
    assert {(r.id, r.t) for r in va.apply_patches(s, p, ["id"], "t").collect()} == {("2", "y"), ("3", "z")}
    t = spark.createDataFrame([("r", "1{day}"), ("r", "20")], "run string, target string")
    states = spark.createDataFrame([("r", "day", 3), ("r", "day", 4)], "run string, state string, value int")
    assert {r.x for r in va.template_targets(t, "target", states, ["run"], "x").collect()} == {"13", "14"}


def test_bundle_and_engine(spark, tmp_path):
    e = spark.createDataFrame([("one", 1, "One", "<p>1</p>"), ("two", 2, "Two", "<p>2</p>")], "entry_id string, order int, title string, html string")
    m = bundle.write_bundle(e, e.select("entry_id"), str(tmp_path / "b"), "Book")
    assert m.count() == 2 and Path(tmp_path, "b", "pages", "two.html").read_text() == "<p>2</p>"
    with pytest.raises(ValueError):
        bundle.write_bundle(e.withColumn("order", F.lit(1)), e, str(tmp_path / "c"), "Book")
    (tmp_path / "scans").mkdir()
    (tmp_path / "scans" / "a.png").write_bytes(b"abc")
    lines = engines.read_with_engine(spark, str(tmp_path / "scans"), lambda f: f.assign(page=1, line_no=0, text=f["content"].map(lambda b: bytes(b).decode()), confidence=1.0)[["path", "page", "line_no", "text", "confidence"]])
    assert [r.text for r in lines.collect()] == ["abc"]


def test_tables_of_pages():
    from quire.functions import html as ht

    one = "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>"
    more = "<table><tr><th>A</th><th>B</th></tr><tr><td></td><td>x</td></tr></table>"
    assert ht.tables_of(one + more) == [[["A", "B"], ["1", "2"], ["", "x"]]]
    assert len(ht.tables_of(one + "<p>text</p>" + more)) == 2
    assert ht.continued_rows([["1", "2"], ["", "x"]]) == [["1", "2 x"]]
    assert ht.tables_of(None) == [] and ht.cleaned(None) is None
    assert ht.cleaned('<div onclick="x"><script>bad()</script><p>a&amp;b <a href="#3">3</a><a href="http://x">y</a></p></div>') == '<p>a&amp;b <a href="#3">3</a><a>y</a></p>'


def test_sections(spark):
    from quire.operators import sections as se

    df = spark.createDataFrame([(1, "Roll two dice, then roll 2d6+3 and turn to 9."), (2, None)], "k int, t string")
    assert [(r.dice, r.plus) for r in se.dice_checks(df, "t").orderBy("place").collect()] == [(2, 0), (2, 3)]
    items = spark.createDataFrame([("r", "brass key"), ("r", "Key"), ("r", "rope"), ("q", "key")], "run string, item string")
    assert {(r.run, r.item) for r in se.longest_names(items, ["run"], "item").collect()} == {("r", "brass key"), ("r", "rope"), ("q", "key")}
    low, high = se.expected_range(F.col("n"), F.col("p"))
    rows = spark.createDataFrame([(0, "sections 1-350"), (12, None), (0, "9-2")], "n int, p string").select(low.alias("a"), high.alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(1, 350), (1, 12), (1, 400)]


def test_disagreement_of_whole_texts(spark, tmp_path):
    from quire.plans import reference4

    start = "The gate is cold and dark. " * 12
    pages = [(1, "r", 1, f"<p>{start}Turn to 17 now.</p>"), (2, "r", 2, f"<p>{start}Élan Übermut</p>"), (3, "r", 3, f"<p>{start}Same end.</p>")]
    texts = {1: start + "XQZ 9 @@ wholly else", 2: start + "Ýñþ Ôç", 3: start + "Same end."}
    spark.createDataFrame(pages, "page_key long, run_id string, page int, html string").write.parquet(str(tmp_path / "pages_html.parquet"))
    elements = spark.createDataFrame([(k, "r", k, 0, t) for k, t in texts.items()], "element_key long, run_id string, page int, seq long, text string")
    elements.write.parquet(str(tmp_path / "elements_core_content_types_rubric_v1.parquet"))
    got = {r.page: r.disagreement for r in reference4.engine_disagreement(spark, str(tmp_path)).collect()}
    assert got[1] > 0 and got[2] > 0 and got[3] == 0
