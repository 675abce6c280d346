from __future__ import annotations

from itertools import product

from quire.llm import surrogates as sg

KEY = b"a secret of the test"


def made(spark, rows, evidence=None, key=KEY):
    df = spark.createDataFrame(rows, "kind string, value string")
    return {(r.kind, r.value): r.surrogate for r in sg.surrogates(df, key, evidence).collect()}


def test_every_person_stays_a_different_person(spark):
    given = [n for n in sg.MALE + sg.FEMALE] + ["Jon", "Nadia", "Ann", "Ulf"]
    names = [("name", f"{g} {f}") for g, f in product(given, ["Lee", "Quarnholt", "Smith-Jones"])] + [("name", f"{c}. {f}") for c, f in product("ABCDEFGHIJKLMNOPQRSTUVWXYZ", ["Lee", "Quarnholt"])]
    got = made(spark, names)
    assert len(got) == len(names) and len(set(got.values())) == len(names)
    assert not set(got.values()) & {v for _, v in names}
    assert len({v.split()[1] for k, v in got.items() if k[1].endswith(" Lee")}) == 1


def test_coreference_of_orders_capitals_and_initials(spark):
    got = made(spark, [("name", x) for x in ("John Lee", "LEE, John", "J. Lee", "Lee, J.", "John Q. Lee", "JOHN LEE", "Lee, John")])
    first, family = got["name", "John Lee"].split()
    assert got["name", "LEE, John"] == f"{family.upper()}, {first}" and got["name", "Lee, John"] == f"{family}, {first}" and got["name", "JOHN LEE"] == f"{first.upper()} {family.upper()}"
    assert got["name", "J. Lee"] == f"{sg.folded(first)[0].upper()}. {family}" and got["name", "Lee, J."] == f"{family}, {sg.folded(first)[0].upper()}."
    assert got["name", "John Q. Lee"].split()[0] == first and got["name", "John Q. Lee"].split()[2] == family
    same = made(spark, [("email", "ann.lee@post.example"), ("email", "ann.lee (at) post dot example"), ("phone", "+44 (0)20 7946 0958"), ("phone", "+44 20-7946-0958")])
    assert same["email", "ann.lee (at) post dot example"].replace(" (at) ", "@").replace(" dot ", ".") == same["email", "ann.lee@post.example"]
    assert [c for c in same["phone", "+44 20-7946-0958"] if c.isdigit()] == [c for c in same["phone", "+44 (0)20 7946 0958"].replace("(0)", "") if c.isdigit()]


def test_gender_and_script(spark):
    assert [sg.gender_of(x) for x in ("ann", "nadia", "rene", "hans-peter", "ulf", "иван", "наталья")] == ["f", "f", "m", "m", "m", "m", "f"]
    k = sg.Keyed(KEY)
    for salt in range(12):
        for part, script in (("иван", "cyrillic"), ("ελένη", "greek"), ("jack", "latin")):
            assert sg.script_of(k.given("f", part, "m", salt)) == script == sg.script_of(k.invented("family", "", part, salt))
    evidence = spark.createDataFrame([("ulf", "f")], "part string, gender string")
    plain, told = made(spark, [("name", "Ulf Lee")]), made(spark, [("name", "Ulf Lee")], evidence)
    assert plain["name", "Ulf Lee"] != told["name", "Ulf Lee"]
    pool = {n for n in sg.FEMALE if sg.folded(n)[0] == sg.folded(told["name", "Ulf Lee"])[0]}
    assert not pool or told["name", "Ulf Lee"].split()[0] in pool


def test_numbers_keep_their_format_and_are_never_original(spark):
    phones = [("phone", f"+44 20 79{i:06d}") for i in range(3_000)] + [("phone", f"0{i:09d}") for i in range(100_000_000, 100_001_000)]
    got = made(spark, phones)
    assert len(set(got.values())) == len(phones) and not set(got.values()) & {v for _, v in phones}
    assert all(v.startswith("+44 ") if k[1][0] == "+" else v[0] == "0" and v[1] != "0" for k, v in got.items())
    k = sg.Keyed(KEY)
    assert len({k.permuted(f"{i:04d}", "0123456789", "x") for i in range(10_000)}) == 10_000
    ids = made(spark, [("id_number", "000-12-3456"), ("id_number", "000 12 3456"), ("id_number", "00018311O")])
    assert ids["id_number", "000-12-3456"].replace("-", " ") == ids["id_number", "000 12 3456"] and ids["id_number", "00018311O"][-1].isalpha()


def test_another_key_gives_other_surrogates_and_empty_input_none(spark):
    rows = [("name", "Ann Lee"), ("address", "12 Old Ash Street"), ("email", "a@b.example")]
    a, b = made(spark, rows), made(spark, rows, key=b"other")
    assert all(a[k] != b[k] for k in a) and a["address", "12 Old Ash Street"].endswith(" Street")
    assert sg.surrogates(spark.createDataFrame([(None, None), ("name", None)], "kind string, value string"), KEY).count() == 0
