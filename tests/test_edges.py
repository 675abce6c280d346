from __future__ import annotations

import pytest

from quire.operators import stateful as st
from quire.plans import problems, reference3, reference5
from tests import edge_tables as et

pytestmark = pytest.mark.skipif(not et.SOURCE.exists(), reason="no data folder here")


def test_empty_tables_give_empty_results(spark, tmp_path):
    d = et.emptied(spark, tmp_path)
    for name, query in problems.QUERIES.items():
        assert query(spark, d).count() == 0, name


def test_clashing_columns_nulls_and_copies_change_nothing(spark, tmp_path):
    d = et.messy(spark, tmp_path)
    for name in ("p4_found", "p5_found", "p6_found"):
        want = sorted(map(str, problems.QUERIES[name](spark, str(et.SOURCE)).collect()))
        assert sorted(map(str, problems.QUERIES[name](spark, d).collect())) == want, name


def test_repeated_pages_with_a_wrong_character_in_most_words(spark):
    import difflib

    page = "wonderful lanterns brightly illuminated underground passageways throughout forgotten settlements yesterday"
    bad = " ".join(w[:4] + "#" + w[5:] for w in page.split())
    other = "Nobody opens the cold gate of the old mill before noon, says the miller of the hill."
    df = spark.createDataFrame([("r", 1, 1, page), ("r", 2, 2, bad), ("r", 3, 3, other), ("r", 4, 4, page)], "run_id string, k long, page int, text string")
    got = {(r.k, r.of, r.similarity) for r in st.repeated_pages(df, "run_id", "k", "page", "text", threshold=0.85).collect()}
    assert got == {(2, 1, round(difflib.SequenceMatcher(None, bad, page).ratio(), 4)), (4, 1, 1.0)}


def test_paragraphs_of_every_page_and_titles_of_five(spark, tmp_path):
    rows = [(i, "r", i, i, f"line {i} of the old book goes on\nand on") for i in range(1, 9)] + [(10 + i, "q", i, i, f"Line {i}") for i in range(4, 8)]
    df = spark.createDataFrame(rows, "element_key long, run_id string, page int, seq long, text string")
    df.write.parquet(str(tmp_path / "elements_core_content_types_rubric_v1.parquet"))
    got = {(r.run_id, r.page): r.lines for r in reference5.paragraphs_of_lines(spark, str(tmp_path)).collect()}
    assert got == {("r", i): 2 for i in range(1, 9)} | {("q", i): 1 for i in range(4, 8)}
    assert {r.run_id: r.element_key for r in reference3.title_candidates(spark, str(tmp_path)).collect()}["q"] in (14, 15)
