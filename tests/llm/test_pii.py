"""Personal spans on hand-written cases; offsets through damage and disguises."""

import pytest

from dimskog.llm import pii
from tests.llm.test_garble import damage

GIVEN = {"anna", "åsa", "bo", "karl-johan", "elsa", "sten", "maj", "zoë", "ragnar"}
SURNAMES = {f"{a}{b}" for a in ("alm", "berg", "ek", "lind", "björk", "söder", "hög", "dal") for b in ("ström", "kvist", "berg", "gren", "dahl", "blad", "näbb", "fält")} | {"abdirahmo"}
D = pii.Detector(pii.Names(GIVEN, SURNAMES))


def found(text):
    return [(text[s:e], k) for s, e, k in D.spans(text)]


CASES = [
    ("Mejla anna.berg+jour@mail.example.org nu", [("anna.berg+jour@mail.example.org", "email")]),
    ("[a_b@c.test](mailto:a_b@c.test).", [("a_b@c.test", "email"), ("a_b@c.test", "email")]),
    ("via bo (at) hem.example eller bo[at]hem[punkt]example", [("bo (at) hem.example", "email"), ("bo[at]hem[punkt]example", "email")]),
    ("via bo @ hem.example", [("bo @ hem.example", "email")]),
    ("tel 070-174 06 79, +46 (0)31-390 0633", [("070-174 06 79", "phone"), ("+46 (0)31-390 0633", "phone")]),
    ("nytt nummer 07700 900462 i dag", [("07700 900462", "phone")]),
    ("tel +1 202-555-0104.", [("+1 202-555-0104", "phone")]),
    ("OCR 9278607789. Remissnr 2024-656-4123. Artikelnummer 0316087586638872. Provnr 03-1632-843.", []),
    ("orgnr 559264-7220, serienr SN407588249, mätvärden 536 76 80 18, CRP 107, 120/80, Box 276", []),
    ("Personnummer 811212-3456, 198112123456 och 811272+3456", [("811212-3456", "id_number"), ("198112123456", "id_number"), ("811272+3456", "id_number")]),
    ("pass AB1234567, 2024-01-02", [("AB1234567", "id_number")]),
    ("bor på Ugglebogatan 84 i Ort", [("Ugglebogatan 84", "street")]),
    ("Hemadress Norra Åsgatan 33 B, 2 tr, 123 45 Ort", [("Norra Åsgatan 33 B", "street")]),
    ("Sankta Ylvas väg 16, BERGSVÄG 63-65", [("Sankta Ylvas väg 16", "street"), ("BERGSVÄG 63-65", "street")]),
    ("Dr. Anna Almström, Doktor Björkberg", [("Anna Almström", "person"), ("Björkberg", "person")]),
    ("Söderblad, Åsa och Karl-Johan", [("Söderblad, Åsa", "person"), ("Karl-Johan", "person")]),
    ("C/o ragnar ekdahl, ELSA HÖGBERG", [("ragnar ekdahl", "person"), ("ELSA HÖGBERG", "person")]),
    ("Å. Lindgren och Anna Elsa af Dalfält-Ekberg kom", [("Å. Lindgren", "person"), ("Anna Elsa af Dalfält-Ekberg", "person")]),
    ("Sten i vänster njure, 5 mm. Maj månads kontroll uteblev. Den 3 maj 2024.", []),
    ("Väntar på besked från Elsa i vänster sida", [("Elsa", "person")]),
    ("[PERSON], 26 years old, 36,6 °C. Enligt Hb 120", []),
    ("ring noll sju noll ett två tre fyra fem sex sju nu", [("noll sju noll ett två tre fyra fem sex sju", "phone")]),
    ("Аnna Almström", [("Аnna Almström", "person")]),
    ("", []),
]


@pytest.mark.parametrize("text, want", CASES)
def test_case(text, want):
    assert found(text) == want


@pytest.mark.parametrize("chain", ["utf8_cp1252", "utf8_mac", "latin1_cp437", "utf8_cp1252_twice", "latin1_mac", "latin1_cp1251"])
def test_spans_are_of_the_stored_text(chain):
    clean = "Närstående: Åsa Högström, 070-174 06 79, bor på Ängsvägen 12 A, önskar återbud på måndag."
    bad = damage(clean, chain)
    want = [(damage(w, chain), k) for w, k in (("Åsa Högström", "person"), ("070-174 06 79", "phone"), ("Ängsvägen 12 A", "street"))]
    assert found(bad) == want


def test_lost_letters():
    assert found("Zo� H�gstr�m, S�dra Bj�rkv�gen 7") == [("Zo� H�gstr�m", "person"), ("S�dra Bj�rkv�gen 7", "street")]


def test_long_text_is_scanned_whole():
    assert found("x " * 300_000 + "anna@b.test")[-1] == ("anna@b.test", "email")


def test_operator(spark, tables):
    names = [("Q1", "Anna", "Anna", "given_name"), ("Q2", None, "Almström", "family_name"), ("Q3", None, None, "given_name")]
    text = "Anna Almström, anna@b.test, dos 20 mg, Hb 120."
    folder = tables(notes=[(1, text, "u"), (2, None, "u"), (3, "", "u"), (4, text, "u")], rows=[(1, "train", "s", text, None), (2, None, None, "inget", [])], gazetteer=names)
    got = {tuple(r) for r in pii.found(spark, folder).collect()}
    assert got == {(t, i, s, e, k) for t, i in (("notes", 1), ("notes", 4), ("sv_pure3", 1)) for s, e, k in ((0, 13, "person"), (15, 26, "email"))}
    red = {(r.tbl, r.row_id): r.redacted for r in pii.redacted(spark, folder).collect()}
    assert red["notes", 1] == "[PERSON], [E-POST], dos 20 mg, Hb 120." and red["notes", 3] == "" and red["sv_pure3", 2] == "inget"


@pytest.mark.parametrize(
    "text, want",
    [
        ("ring NOLL SJU NOLL ETT TVÅ TRE FYRA FEM SEX SJU nu", ("NOLL SJU NOLL ETT TVÅ TRE FYRA FEM SEX SJU", "phone")),
        ("call zero seven zero one two three four five six seven now", ("zero seven zero one two three four five six seven", "phone")),
        ("ring plus fyra sex sju ett två tre fyra fem sex sju åtta nu", ("plus fyra sex sju ett två tre fyra fem sex sju åtta", "phone")),
    ],
)
def test_spelled_digits(text, want):
    """In capitals, in English and without a zero."""
    assert want in found(text)


@pytest.mark.parametrize(
    "text, want",
    [
        ("Ring plus fyra sex sju tre fem ett två sex åtta nio fyra", ("plus fyra sex sju tre fem ett två sex åtta nio fyra", "phone")),
        ("Bor i \\rebro vid [ngsgatan 5, \\stra", ("[ngsgatan 5", "street")),
        ("mejl " + "anna [punkt] maria [punkt] " * 9 + "elisabet (at) hem [punkt] example", ("anna [punkt] maria [punkt] " * 9 + "elisabet (at) hem [punkt] example", "email")),
        ("bor " + "Å" + "l" * 90 + "gatan 4 B", ("Å" + "l" * 90 + "gatan 4 B", "street")),
        ("sjuksköterska   Dalfält kom", ("Dalfält", "person")),
        ("träffade " + "von der de la di " + "Dalfält, Anna i dag", ("von der de la di Dalfält, Anna", "person")),
        ("hälsade " + "ekström" + "-dalström" * 6 + ", anna. ", ("ekström" + "-dalström" * 6 + ", anna", "person")),
    ],
)
def test_no_window_cuts_a_span(text, want):
    assert want in found(text)


def test_national_letters_without_braces():
    assert pii.normal_form("[sa [kerlund, \\stra \\rebro")[0] == "Äsa Äkerlund, Östra Örebro"  # the set reads [ as Ä


def test_seven_equal_digit_words():
    assert found("tel noll ett ett ett ett ett ett ett ett.") == [("noll ett ett ett ett ett ett ett ett", "phone")]
