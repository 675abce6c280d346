from __future__ import annotations

import random

from pyspark.sql import functions as F

from quire.llm import scannoise as sn

KNOWN = frozenset("the kitchen is cold and you open a gate to moss-covered stone long before dark of".split())


def noise(spark, texts):
    df = spark.createDataFrame([(i, t, "r", "b", 1) for i, t in enumerate(texts)], "k long, text string, run_id string, book_id string, page int")
    rows = sn.cut(sn.scan(df, "element", "k", "text", KNOWN, html=False))
    return {(r.rec_key, r.noise, r.value) for r in sn.word_noise(rows).collect()}


def test_divided_and_misread_words(spark):
    plain = ["the kitchen is cold and you open a gate to the moss-covered stone"] * 25
    got = noise(spark, plain + ["you open the kit-\nchen and the gate", "the moss-\ncovered stone is cold", "the kifchen is cold", "you open tbe gate", "the k!tchen is dark", None, "", "the kit­\nchen is cold"])
    assert got == {(25, "hyphen", "kitchen"), (26, "hyphen", "moss-covered"), (27, "misread", "kitchen"), (28, "misread", "the"), (29, "misread", "kitchen"), (32, "hyphen", "kitchen")}


def test_misread_words_of_many_copies(spark):
    plain = [f"the kitchen {w} is cold and you open a gate to the stone" for w in ("of", "is", "you", "and", "dark", "long", "before", "open", "gate", "stone", "cold", "a")]
    copies = ["the kifchen is cold and you open a gate", "you open the kif-\nchen and the gate is cold"]
    got = noise(spark, plain + copies[:1] * 6 + copies[1:] * 6)
    assert got == {(k, "misread", "kitchen") for k in range(12, 24)} | {(k, "hyphen", "kitchen") for k in range(18, 24)}


def test_lists_and_junk_are_no_prose(spark):
    plain = ["the kitchen is cold and you open a gate to the stone"] * 25
    assert noise(spark, plain + ["- kifchen\n- gate\n- stone", "kifchen | 12 | 4\ngate | 3 | 9", "xx kifchen zz qq ww rr tt"]) == set()


def test_anagram_shift_finds_every_confusion(spark):
    words = [(a + "xq", b + "xq") for a, b in sn.CONFUSIONS if a != b]
    rare = spark.createDataFrame([(w, 1) for w, _ in words], "word string, n long").distinct()
    frequent = spark.createDataFrame([(t, 100) for _, t in words], "word string, n long").distinct()
    got = {r.word for r in sn.corrections(rare, frequent).collect()}
    assert got == {w for w, _ in words}
    assert sn.corrections(rare.limit(0), frequent).count() == 0


def test_two_confusions_in_a_word(spark):
    """Planted double errors: at least nine of ten come back, and none of the words that two confusions do not explain."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choice(["ta", "re", "mon", "lig", "ster", "hav", "bun", "ci", "do", "fel", "wind", "gar"]) for _ in range(4)) for _ in range(120)})
    spoilt = {}
    for w in words:
        once = {w[:i] + a + w[i + len(b) :] for a, b in sn.CONFUSIONS for i in range(len(w)) if w.startswith(b, i)}
        one = rng.choice(sorted(once))
        two = {one[:i] + a + one[i + len(b) :] for a, b in sn.CONFUSIONS for i in range(len(one)) if one.startswith(b, i)} - once - {w}
        spoilt[rng.choice(sorted(two))] = w
    rare = spark.createDataFrame([(x, 1) for x in [*spoilt, "unexplained", "kitchenette"]], "word string, n long")
    frequent = spark.createDataFrame([(w, 100) for w in words], "word string, n long")
    got = {r.word: r.target for r in sn.corrections(rare, frequent).collect()}
    assert set(got) <= set(spoilt) and sum(got.get(x) == w for x, w in spoilt.items()) >= 0.9 * len(spoilt)


def test_prose_of_words_that_the_list_lacks(spark):
    plain = ["the kitchen is cold and you open a gate to the stone"] * 3
    got = noise(spark, [*plain, "Het huis staat aan de rivier en de keu-\nken is koud.", "zxq wrt kif-\nchn qqp vbn mmn trw. zz"])
    assert got == {(3, "hyphen", "keuken")}


def test_running_heads_of_any_length(spark):
    head = "The Long and Winding History of the House of the Cold Gate and of All Who Went In and Out of It for Years"
    schema = "src_table string, rec_key long, run_id string, book_id string, page int, text string, place int, count int, kind string"
    books = spark.createDataFrame([("b", head)], "book_id string, title string")
    df = spark.createDataFrame([(p, "r", "b", p, s, head if s == 0 else f"Line {s} of it.") for p in range(2, 6) for s in range(4)], "element_key long, run_id string, book_id string, page int, seq long, text string")
    got = {(r.rec_key, r.noise) for r in sn.edge_noise(sn.element_edges(df).select(schema.replace(" string", "").replace(" long", "").replace(" int", "").split(", ")), books).collect()}
    assert got == {(p, "header") for p in range(2, 6)}


def lines(spark, rows):
    schema = "src_table string, rec_key long, run_id string, book_id string, page int, text string, place int, count int, kind string"
    books = spark.createDataFrame([("b", "The Cold Gate")], "book_id string, title string")
    got = sn.edge_noise(spark.createDataFrame([("element", k, "r", "b", p, t, i, 9, "t") for k, p, t, i in rows], schema), books)
    return {(r.rec_key, r.noise, r.value) for r in got.collect()}


def test_edges(spark):
    rows = [(1, 1, "The Cold Gate", 0), (2, 2, "THE COLD GATE   2", 0), (3, 2, "14", 8), (4, 3, "Tbe Cold Gate", 0), (5, 3, "- 3 -", 8), (6, 20, "14-22", 0), (7, 20, "20", 8), (8, 21, "31", 0), (9, 21, "21", 8), (10, 2, "2", 4)]
    assert lines(spark, rows) == {(2, "header", "THE COLD GATE   2"), (4, "header", "Tbe Cold Gate"), (5, "pageno", "- 3 -"), (6, "header", "14-22"), (7, "pageno", "20"), (9, "pageno", "21")}


def test_repair(spark):
    df = spark.createDataFrame([(1, "You open the kit-\nchen and\nthe kifchen."), (2, None)], "k long, text string")
    found = spark.createDataFrame([("element", 1, "hyphen", "kitchen", "kit\nchen"), ("element", 1, "misread", "kitchen", "kifchen")], "src_table string, rec_key long, noise string, value string, stored string")
    got = {r.rec_key: r.text for r in sn.repair(df, "element", "k", "text", found, html=False).select("rec_key", F.col("text")).collect()}
    assert got == {1: "You open the kitchen and the kitchen.", 2: None}


def test_divided_words_are_those_of_the_pattern():
    rng = random.Random(5)
    bits = ["kit", "chen", "5th", "ß", "_", "-", "-\n", "¬\n", "- \n", "--\n", "-\n\n", "\n", " ", "12", "well-made", "."]
    for _ in range(5_000):
        text = "".join(rng.choice(bits) for _ in range(12))
        assert sn.divided_words(text) == ({(a.lower(), b.lower()) for a, b in sn.DIVIDED.findall(text)}, sn.DIVIDED.sub(" ", text))
    assert sn.divided_words("the kit-\nchen of x-\n5") == ({("kit", "chen")}, "the   of x-\n5")


def test_copies_are_looked_at_once(monkeypatch):
    looked = []
    look = sn.Reader.look
    monkeypatch.setattr(sn.Reader, "look", lambda self, text: looked.append(text) or look(self, text))
    reader = sn.Reader(KNOWN)
    texts = ["you open the kit-\nchen and the old gate", "the stone is cold and you open it"]
    got = [reader.read(t, 3) for t in texts * 3] + [reader.read(texts[0])]
    reader.settle()
    assert looked == [*texts, texts[0]] and got[0] == got[2] == got[6] == ({"old"}, {("kit", "chen")})
    assert reader.counts[3]["the"] == 6 and reader.counts[1]["the"] == 1


def test_cells_have_two_separators():
    words = "you open the gate to the stone".split()
    prose = "you open the gate; to the stone\nthe kitchen is cold and dark,\nand you open the gate again"
    assert sn.is_running_text(prose, words, set(words), 6)
    assert not sn.is_running_text("gate | 3 | 9", words, set(words), 6) and not sn.is_running_text("gate    3    9", words, set(words), 6)


def test_limits_of_the_reader_lose_no_count(monkeypatch):
    texts = [("the stone is cold and you open it", 2), ("you open the kit-\nchen and the old gate", 3), ("the gate is dark and you open it", 1)] * 4

    def counts():
        reader = sn.Reader(KNOWN)
        found = [reader.read(*x) for x in texts]
        reader.settle()
        return found, reader.counts, len(reader.memo)

    found, counted, remembered = counts()
    monkeypatch.setattr(sn.Reader, "REMEMBERED", 300)
    monkeypatch.setattr(sn.Reader, "WAITING", 2)
    assert counts() == (found, counted, 1) and remembered == 2
