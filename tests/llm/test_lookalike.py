from __future__ import annotations

from quire.llm import lookalike as lk

SAME = [
    "The café of the fjord XII, a­ged 48",
    "Thе café оf thе fjοrd XII, aged 48",
    "The café of the fjord Ⅻ, aged 48",
    "Ｔｈｅ café of the f​jord XII, aged ４８",
]
OTHER = ["The cafe of the fjord XII, aged 48", "The café of the fjord XII, aged 4⁸", "The café of the\nfjord XII, aged 48", "the café of the fjord XII, aged 48", "The café of the fjord XII—aged 48"]


def pairs(spark, rows):
    df = spark.createDataFrame(rows, "k long, g string, t string")
    return {(r.key_a, r.key_b) for r in lk.same_look_pairs(lk.consistent_forms(df, "k", "g", "t"), "k", "g").collect()}


def test_pairs(spark):
    rows = [(i, "b", t) for i, t in enumerate(SAME)] + [(10 + i, "b", t) for i, t in enumerate(OTHER)]
    rows += [(20, "other", SAME[0]), (21, "b", None), (22, "b", ""), (23, "b", ""), (24, "b", SAME[0])] + [(0, "b", SAME[0])]
    want = {(a, b) for a in (0, 1, 2, 3, 24) for b in (0, 1, 2, 3, 24) if a < b} - {(0, 24)}
    assert pairs(spark, rows) == want
    assert pairs(spark, []) == set()


def test_real_words_of_another_script_stay(spark):
    df = spark.createDataFrame([(1, "b", "Привет мир снова"), (2, "b", "a plain word")], "k long, g string, t string")
    got = {r.k: r.form for r in lk.consistent_forms(df, "k", "g", "t").collect()}
    assert got == {1: "Привет мир снова", 2: "a plain word"}


def test_a_repair_needs_the_vocabulary(spark):
    bent = "Zаnobеki"
    one = spark.createDataFrame([(1, "b", bent + " sleeps"), (2, "b", "all sleeps")], "k long, g string, t string")
    assert {r.form for r in lk.consistent_forms(one, "k", "g", "t").collect()} == {bent + " sleeps", "all sleeps"}
    known = one.union(spark.createDataFrame([(3, "b", "Zanobeki sleeps")], "k long, g string, t string"))
    assert {r.form for r in lk.consistent_forms(known, "k", "g", "t").collect()} == {"Zanobeki sleeps", "all sleeps"}


def test_characters_without_width():
    for c in ("\ufe0f", "\U000e0041", "\u115f", "\u3164", "\uffa0", "\u180b", "\U000e0101"):
        assert lk.base_form(f"ga{c}te") == "gate", hex(ord(c))


def test_pairs_of_a_class_with_many_copies(spark):
    """One odd spelling among many copies: as many pairs as copies, in linear time."""
    n = 100_000
    forms = spark.range(n).selectExpr("id as k", "'b' as g", "'common' as raw", "'form' as form").union(spark.createDataFrame([(n, "b", "odd", "form"), (n + 1, "b", "alone", "other")], "k long, g string, raw string, form string"))
    pairs = lk.same_look_pairs(forms, "k", "g")
    assert pairs.count() == n and pairs.where(f"key_b <> {n}").count() == 0
