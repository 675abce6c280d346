from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import alignment as al
from quire.functions import html as ht
from quire.functions import scan as fs
from quire.operators import elements as em
from quire.operators import readings as rd


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_numbers_of_misread_signs(spark):
    assert column(spark, ["I6", "S", "l8:", "0", "x1", "", None, "ssssss", "1-2"], fs.number_candidates) == [[16], [5, 8], [18, 88, 181, 182, 881, 882], [], [], [], [], [], [12]]
    assert column(spark, ["in 4", "Section42", "12a", "7", None], fs.numbers_beside_errors) == [["in 4", "4"], ["Section42", "42"], ["12a", "12"], ["7"], []]
    assert column(spark, ["1Z", "12", " 3b ", "abc1", "", None, "1234567"], fs.needs_number_rescue) == [True, True, True, False, False, None, False]


def test_phrases_put_right(spark):
    lines = ["If so, Tum to 12. Then rest.", "turn t0 7", "TURN TO 5", "Turn tO 9!", "tum", None, ""]
    assert column(spark, lines, fs.repaired_phrase) == ["If so, Turn to 12. Then rest.", "turn to 7", "TURN TO 5", "Turn to 9!", "tum", None, ""]


def test_key_values(spark):
    got = column(spark, ["MANTICORE  SKILL 11  STAMINA 12", "Gold pieces: 7", "LUCK =", "a plain line", None], fs.key_values)
    assert [(r.entity, [(p.key, p.value) for p in r.pairs]) if r else None for r in got] == [("MANTICORE", [("SKILL", 11), ("STAMINA", 12)]), (None, [("GOLD PIECES", 7)]), (None, [("LUCK", None)]), None, None]


def test_forms_and_fragments(spark):
    form = ["SKILL =", "STAMINA =", "LUCK =", "GOLD", "ITEMS"]
    assert column(spark, [form, ["A line of prose that goes on for a while."], [], None], fs.form_confidence, "array<string>") == [1.0, 0.0, 0.0, 0.0]
    lines = ["The gate is cold.", "It opens.", "his", "ser", "x-y", "the"]
    assert column(spark, [lines, lines[:2], lines[:5] + ["12"], None, ["ab1", "cd", "xx", "yy", "zz"]], fs.trailing_fragments, "array<string>") == [4, 0, 0, 0, 5]


def test_spelling_and_best_reading(spark):
    rows = [(1, "a", 0, ["The kitchen is cold and the gates are open to you"]), (1, "b", 1, ["Tbe k1tchen is cxld and the gates arr open to yqxw"]), (1, "c", 2, ["short"]), (2, "a", 0, None)]
    df = spark.createDataFrame(rows, "page int, engine string, preference int, lines array<string>")
    known = spark.createDataFrame([(w,) for w in "The kitchen is cold and gate are open to you".split()], "word string")
    s = rd.spelled(df, known, "word")
    got = {(r.page, r.engine): r.spell for r in s.collect()}
    assert got[1, "a"].words == 11 and got[1, "a"].dictionary == 0 and got[1, "b"].dictionary > 0.3 and got[1, "b"].confusion == 0.6
    q = {(r.page, r.engine): (r.eligible, r.quality) for r in rd.engine_quality(s).collect()}
    assert q[1, "a"] == (True, 1.0) and q[1, "c"] == (False, None)
    assert [(r.page, r.engine) for r in rd.best_engine(s, ["page"], "preference").collect()] == [(1, "a")]


def test_votes_over_several_readings(spark):
    readings = {"a": ["the gate is cold", "you wait", "end of it"], "b": ["the gate is cold", "you wa1t"], "c": ["tbe gate is cold", "you wait", "end of it"]}
    assert [x[0] for x in rd.voted(readings)] == ["the gate is cold", "you wait", "end of it"]
    assert rd.voted({"a": ["tbe gate"], "b": ["the gafe"]}, {}, frozenset({"the", "gate"})) [0][0] in ("tbe gate", "the gate", "the gafe")
    assert rd.voted({"a": ["tbe gate is"], "b": ["the gafe is"]}, {"a": 0.1, "b": 0.9})[0][:2] == ("the gafe is", "b")
    assert rd.voted({}) == [] and rd.voted({"a": ["x"], "b": [" "]}) == [("x", "a", 0.0)]
    df = spark.createDataFrame([(1, e, x, None) for e, x in readings.items()] + [(2, "a", None, 0.5)], "page int, engine string, lines array<string>, quality double")
    assert [(r.page, r.place, r.text) for r in rd.voted_pages(df, ["page"], frozenset()).orderBy("place").collect()] == [(1, 0, "the gate is cold"), (1, 1, "you wait"), (1, 2, "end of it")]
    assert rd.voted_pages(df.limit(0), ["page"], frozenset()).count() == 0


def test_similarity_bounds_lose_nothing():
    texts = ["one two three four", "one two three", "0ne tw0 thr33 f0ur", "", "wholly other words here"]
    for a in texts:
        for b in texts:
            full = al.similarity(a, b)
            assert (al.similarity(a, b, 0.7) >= 0.7) == (full >= 0.7)
    assert al.matched_captions(["a red gate", "", "moss"], ["the red gate", "!!", "a"]) == 2 and al.matched_captions([], ["x"]) == 0


def test_markup(spark):
    assert ht.text_of('<p>a</p><table><tr><td>1</td><td>2</td></tr></table><img alt="x"><img>') == "a\n1 2\n[image: x]\n[image]"
    blocks = [(b["block_type"], b["text"]) for b in ht.blocks_of('<h1>T</h1><p></p><ul><li>q <a href="#2">x</a></li></ul><img alt="i">')]
    assert blocks == [("h1", "T"), ("/h1", ""), ("ul", ""), ("li", 'q <a href="#2"> x </a>'), ("/li", ""), ("/ul", ""), ("img", "i")]
    assert ("p", "") in [(b["block_type"], b["text"]) for b in ht.blocks_of("<p></p>", drop_empty=False)] and ht.blocks_of(None) == []
    assert ht.cleaned('<p class="running-head">X</p>\n <p class="z">Y<img alt="i" data-count="2" src="q"></p>') == '<p class="running-head">X</p>\n<p>Y<img alt="i" data-count="2"></p>'
    assert ht.presented('<p class="running-head">H</p><h2> 12 </h2><p>a&amp;b</p><h2>12b</h2><img src="x">', "12", images=False) == "<p>a&amp;b</p><h2>12b</h2>"
    assert ht.presented(None) is None


def test_centred_lines(spark):
    rows = [("p", i, 0.4, 0.6) for i in range(9)] + [("p", 9, 0.0, 0.1), ("q", 10, 0.1, 0.2)]
    got = {r.k: r.c for r in em.centred(spark.createDataFrame(rows, "p string, k int, a double, b double"), ["p"], F.col("a"), F.col("b"), "c").collect()}
    assert got == {**{i: True for i in range(9)}, 9: False, 10: True}


def test_checks_that_the_tables_leave_empty(spark):
    rows = [("7", "12\nThe gate."), ("12", "12\nThe gate."), ("7", "The gate."), ("x", "3"), ("7", None), (None, "3")]
    df = spark.createDataFrame(rows, "s string, t string")
    assert [bool(r.w) for r in df.select(em.wrong_number(F.col("s"), F.col("t")).alias("w")).collect()] == [True, False, False, False, False, False]
    from quire.functions import text as tx

    assert column(spark, ["a\n\n\n\nb", "a\n\nb", "", None], tx.collapse_blank_lines) == ["a\n\nb", "a\n\nb", "", None]


def test_selected_boxes_do_not_overlap(spark):
    from quire.operators import stateful as st

    rows = [("p", 1, 0.0, 0.0, 10.0, 10.0), ("p", 2, 5.0, 5.0, 14.0, 14.0), ("p", 3, 10.0, 0.0, 15.0, 5.0), ("p", 4, 20.0, 20.0, 21.0, 21.0), ("p", 5, None, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, k int, x0 double, y0 double, x1 double, y1 double")
    assert {(r.k, r["rank"]) for r in st.select_boxes(df, "g", "k", 2).collect()} == {(1, 1), (3, 2)}
    assert {r.k for r in st.select_boxes(df, "g", "k", 9).collect()} == {1, 3, 4}
