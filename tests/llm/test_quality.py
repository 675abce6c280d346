from __future__ import annotations

import pytest

from quire.llm import pagetext, quality, queries
from tests import edge_tables as et

COMMON = frozenset("the a of and is in you to it for was at".split())
PROSE = "You lift the lantern and it is cold in the vault, for nobody was at the gate to open it."
TEXTS = {
    "prose": [PROSE, "To open the gate, turn to the page of the vault and wait for a sign in it."],
    "list": ["- Nine ropes\n- Four cloaks\n- Ten necklaces\n- Two flutes", "Old gate ........ 12\nDark vault ..... 40\nCold hall ........ 77", "Rope, frayed  12, 40, 77\nCloak, dusty  3, 18\nFlute, old  9, 30"],
    "table": ["Name | Born | Died\nUlver | 1840 | 1904\nHolt | 1850 | 1931\nMere | 1812 | 1880", "rope\t12.5\t3\t40%\ncloak\t7.25\t12\t9%\nflute\t1.10\t4\t77%"],
    "junk": ["xkcd qwrt zzpl mnbv trwq plkj hgfd sdfg vbnm qwrt zxcv", "6b240c641f19e537d13d60333c1eea76ba8d1b8020e5284392136a56c604bca6", "gate gate gate gate gate gate gate gate gate gate"],
}


def rows(spark, table, html=False):
    return quality.vote_rows(spark.createDataFrame(table, "k long, t string"), "page" if html else "element", "k", "t", COMMON, html)


def test_types_from_agreement_alone(spark):
    table, want, k = [], {}, 0
    for name, texts in TEXTS.items():
        for t in texts * (30 if name == "prose" else 6):
            table.append((k, t))
            want[k] = name
            k += 1
    table += [(1000, None), (1001, ""), (1002, "   ")]
    got = {r.rec_key: r.text_type for r in quality.text_types(rows(spark, table)).collect()}
    assert {k: v for k, v in got.items() if k in want} == want and not {1000, 1001, 1002} & set(got)


def test_posteriors_of_the_types_sum_to_one(spark):
    table = [(i, t) for i, t in enumerate(x for texts in TEXTS.values() for x in texts * 9)]
    got = quality.text_types(rows(spark, table)).collect()
    assert len(got) == len(table)
    for r in got:
        p = [r[f"p_{c}"] for c in quality.CLASSES]
        assert abs(sum(p) - 1) < 1e-5 and r.text_type == quality.CLASSES[p.index(max(p))] and abs(r.other_share - sum(p[1:])) < 1e-5


def test_page_is_what_most_of_it_is(spark):
    items = "".join(f"<li>{x} rope</li>" for x in "old new red blue long".split())
    head = "<header>THE OLD GATE</header>"
    table = [(1, head + f"<p>{PROSE}<p>{PROSE}</p><ul>{items}</ul>"), (2, head + f"<ul>{items * 4}</ul><p>the end</p>")]
    table += [(10 + i, f"<p>{PROSE}</p>") for i in range(20)] + [(40 + i, f"<ul>{items}</ul>") for i in range(8)]
    got = {r.rec_key: r.other_share for r in quality.text_types(rows(spark, table, html=True)).collect()}
    assert got[1] < 0.5 < got[2]


def test_empty_table(spark):
    assert quality.text_types(rows(spark, [(1, None)]).limit(0)).count() == 0


def test_units_of_tolerant_markup():
    u = pagetext.units('<p class="running-head">HEAD</p><p>a&amp;b<br>c<p><b>12</b></p><ul><li>x<li>y</ul><footer>9</footer>')
    assert [(x.kind, x.text) for x in u] == [("header", "HEAD"), ("p", "a&b\nc"), ("b", "12"), ("li", "x"), ("li", "y"), ("footer", "9")]
    assert pagetext.units(None) == [] and pagetext.units("<img alt=''>") == []


def test_statistics_of_pages_are_those_of_their_readable_text(spark):
    page = spark.createDataFrame([(1, f"<p>{PROSE}</p><ul><li>Nine ropes<li>Four cloaks</ul>"), (2, "<img alt=''>"), (3, None)], "k long, t string")
    text = spark.createDataFrame([(1, f"{PROSE}\n- Nine ropes\n- Four cloaks")], "k long, t string")
    assert quality.statistics(page, "k", "t", COMMON, html=True).collect() == quality.statistics(text, "k", "t", COMMON).collect()


@pytest.mark.skipif(not et.SOURCE.exists(), reason="no data folder here")
def test_statistics_of_every_element_and_page(spark):
    got = {(r.src_table, r.rec_key) for r in queries.p1_statistics(spark, str(et.SOURCE)).select("src_table", "rec_key").collect()}
    pages = spark.read.parquet(str(et.SOURCE / "pages_html.parquet")).collect()
    elements = spark.read.parquet(str(et.SOURCE / f"{queries.ELEMENTS}.parquet")).collect()
    want = {("page", r.page_key) for r in pages if any(x.text.strip() for x in pagetext.units(r.html))}
    assert want and got == want | {("element", r.element_key) for r in elements if quality.plain(r.text or "")}
