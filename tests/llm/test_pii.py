from __future__ import annotations

import random

from quire.llm import pii

LETTERS = {
    1: "Please write to ann.lee@mail.example or call +44 1632 960184. The form shows SSN: 000-12-3456.",
    2: "We moved to Flat 6, 69 Ash Ave., Bramby.\nYours faithfully,\nWalter\nQuarnholt",
    3: "Unsere Anschrift ist Lindenstr. 83, Ashmere. Herr Klaus Eskelsley hat gescannt. Tel.: 030 23125 774",
    4: "J'habite 71 bis, avenue des Vignes, Tallow. Écrivez-moi à ann AT post DOT example. Cordialement,\nRené Gannulund",
    5: "Vivo en C/ Fuente, 5, Corn. Mi DNI es 00018311O.",
    6: "Mark the sheet, and may Hope or Grace guide your Will. Call 3 goblins to the Rose Gate. 285 Old Bram Street is where it begins. See image at 300@2x and element@016-2604, entry 70/0644.",
    7: None,
    8: "",
    9: "The farm passed to Zimmerkins, Will, and to A. B. Rustimere. the gate the sheet the rose",
}
WANT = {
    (1, "email", "ann.lee@mail.example"), (1, "phone", "+44 1632 960184"), (1, "id_number", "000-12-3456"),
    (2, "address", "69 Ash Ave"), (2, "name", "Walter Quarnholt"),
    (3, "address", "Lindenstr. 83"), (3, "name", "Klaus Eskelsley"), (3, "phone", "030 23125 774"),
    (4, "address", "71 bis, avenue des Vignes"), (4, "email", "ann AT post DOT example"), (4, "name", "René Gannulund"),
    (5, "address", "C/ Fuente, 5"), (5, "id_number", "00018311O"),
    (9, "name", "Zimmerkins, Will"), (9, "name", "A. B. Rustimere"),
}


def docs(spark):
    return spark.createDataFrame(list(LETTERS.items()), "doc_id long, text string")


def test_found(spark):
    got = {(r.doc_id, r.kind, r.value) for r in pii.find(docs(spark), "doc_id", "text").collect()}
    assert got == WANT
    assert pii.find(docs(spark).limit(0), "doc_id", "text").count() == 0


def test_placeholders_and_surrogates(spark):
    found = pii.cut(pii.entities(docs(spark), "doc_id", "text", b"secret"))
    rows = found.collect()
    assert {(r.doc_id, r.kind, r.value) for r in rows} == WANT
    table = {(r.kind, r.value): r.surrogate for r in rows}
    assert len(set(table.values())) == len(table) and all(k[1] != v for k, v in table.items())
    phone = table["phone", "+44 1632 960184"]
    assert [c if not c.isdigit() else "9" for c in phone] == [c if not c.isdigit() else "9" for c in "+44 1632 960184"] and phone.startswith("+44 ")
    texts = {r.doc_id: r for r in pii.replace(docs(spark), "doc_id", "text", found).collect()}
    assert texts[1].placeholder_text == "Please write to [EMAIL] or call [PHONE]. The form shows SSN: [ID_NUMBER]."
    assert "Quarnholt" not in texts[2].surrogate_text and texts[2].surrogate_text.startswith("We moved to Flat 6, ")
    assert texts[6].placeholder_text == LETTERS[6] and texts[7].placeholder_text is None


def test_gates_lose_nothing():
    """With and without the cheap patterns before the grammars, on texts made from the grammars."""
    rng = random.Random(7)
    spaces, capitals = [" ", "\n", "\r\n", "\u00a0", "\t", "  ", " \n "], ["Ash", "Šimunek", "Łódź", "Ödön", "Ёлка", "Ωmega", "O’Hara", "Çelik"]

    def made() -> str:
        j, w = rng.choice(spaces), rng.choice(capitals)
        n, m = str(rng.randint(1, 999)), str(rng.randint(10**8, 10**9))
        return rng.choice([
            f"{n}{j}{w}{j}Street", f"{n}{j}N.{j}{w}{j}{w}{j}Road", f"{n}a-{n}{j}The{j}{w}s", f"{w}weg{j}{n}", f"Alter{j}{w}platz{j}{n}b", f"Auf{j}der{j}{w}{j}{n}", f"{n}{j}bis,{j}rue{j}de{j}la{j}{w}",
            f"C/{w},{j}{n}", f"C/{j}{w}{j}{n}", f"Avenida{j}{w}{j}{n}", f"+44{j}20{j}{m}", f"+1{j}({n.zfill(3)}){j}555-0199", f"({n.zfill(3)}){j}555-{n.zfill(4)}", f"06{j}12{j}34{j}56{j}78", f"0{n.zfill(3)}/{m[:7]}",
            f"passport no. L{n[0]}KXB{n[0]}ZP{n.zfill(3)}", f"identity card: KX{n[0]}PL{n[0]}QZW2", f"QQ{j}12{j}34{j}56{j}C", f"X-{m[:7]}-L", f"{m[:3]}-{m[3:5]}-{m[5:9]}", f"tax ID 86{j}095{j}742{j}719",
            f"o’neil{n}@mail.example", f"müller (at) post.example", f"ann{j}AT{j}post{j}dot{j}example", f"１２３４５６７８９", f"+49{j}３０{j}１２３４５６７",
        ])

    for _ in range(3_000):
        text = rng.choice(["I live at ", "My ", "Ich wohne ", "(", ""]) + made() + rng.choice([".", ", thanks.", ")", "\n", " in Bramby"])
        assert pii.contacts(text) == pii.contacts(text, gated=False), repr(text)
    assert pii.contacts("My passport no. is L7KXB4ZP29")[0] == [("id_number", "L7KXB4ZP29")]
    assert pii.contacts("Her identity card: KX7PL9QZW2")[0] == [("id_number", "KX7PL9QZW2")]
    assert pii.contacts("12 Šimunek Street")[0] == [("address", "12 Šimunek Street")]


def test_contacts_of_other_spellings():
    assert pii.contacts("Write to o'neil@mail.example.")[0] == [("email", "o'neil@mail.example")]
    assert pii.contacts("Écrivez à l'adresse d'ann@mail.example, müller@post.example.")[0] == [("email", "müller@post.example"), ("email", "ann@mail.example")]
    assert pii.contacts("Call +1 (212) 555-0199 now.")[0] == [("phone", "+1 (212) 555-0199")]
    assert pii.contacts("Pay to DE89 3704 0044 0532 0130 00 today.")[0] == []


def test_spelled_at_before_any_domain():
    spelled = ["basil.quarnnier (at) lommerpole.invalid", "ann AT post.example", "ann [at] mail.post [dot] example", "ann at post dot mail.example", "ann at post (dot) example", "ann at post\u00a0dot\u00a0example"]
    for value in spelled:
        assert pii.contacts(f"Please write to {value}. Thank you.")[0] == [("email", value)]
    assert pii.contacts("Write to me at stanley.pelluwick@post.example now.")[0] == [("email", "stanley.pelluwick@post.example")]
    assert pii.contacts("Write to me AT STANLEY.PELLUWICK@post.example now, or look at post.example.")[0] == [("email", "STANLEY.PELLUWICK@post.example")]


def test_addresses_with_any_white_space():
    for space in (" ", "\n", "\r\n", "\u00a0", "\t"):
        for words in (("Im", "Winkel", "7"), ("Zum", "Anger", "12"), ("Zur", "Linde", "3a"), ("Am", "Bach", "5"), ("An", "der", "Mauer", "4"), ("Auf", "der", "Heide", "9"), ("Mühlweg", "8"), ("Calle", "Mayor", "5"), ("12", "Łęg", "Street")):
            value = space.join(words)
            assert pii.contacts(f"Ich wohne jetzt {value}, danke.")[0] == [("address", value)], repr(value)


def test_given_names_are_learnt_without_a_list(spark):
    """With an empty list of given names, those that the corpus shows before initials or after titles are found with other families too."""
    letters = [f"Yours, {g} {i}. {f}" for g in ("Oriana", "Tebaldo") for i, f in zip("ABCD", ("Quarnholt", "Eskelwick", "Rustimere", "Gannulund"))]
    letters += ["Mrs Oriana Sorrelbert wrote it.", "We met Tebaldo Merripole and Nolwen Tavikins there.", "the old gate Old Quarnholt"]
    df = spark.createDataFrame(list(enumerate(letters)), "k long, t string")
    got = {r.value for r in pii.names(pii.cut(pii.scan_text(df, "k", "t")), "k", known=frozenset()).collect()}
    assert {"Oriana Sorrelbert", "Tebaldo Merripole"} <= got and "Nolwen Tavikins" not in got and "Old Quarnholt" not in got
