"""Encoding damage: round trips through every chain, decoys, and the whole operator."""

import pytest

from dimskog.llm import codecs, garble

CLEAN = "Patienten söker för ihållande värk i vänster öra, Åsa Öberg och René Källström på Älvsjö vårdcentral såg över läget."
DECOYS = [
    "Fält {namn} | {datum} lämnades tomt.", "Kvot 3 ÷ 2, Σ = 14 och ΔE samt β-värde.", "Åt crème brûlée på château.", "På dörren stod Выход, trots svensk avdelning.",
    "Skrev ”¿por qué?” på lappen…", "Se https://rutin.vard.example/pm?id=9&vy=full här.", "E-post [a.b@c.test](mailto:a.b@c.test) till [PERSON] eller x[at]y[punkt]test.",
    "Gästforskare från São Tomé.", "Ann-Sofie Østerbråten och Zoë Yildızlar.", "10 µm, 38°C ±0,2 – naïvt.", "Varför just jag? Och du?",
]


def damage(text, chain):
    return "".join(codecs.forward(c, chain) or c for c in text)


@pytest.mark.parametrize("chain", [c for c in codecs.STEPS if c not in ("cp850_latin1", "mac_latin1")])
def test_chain_round_trip(chain):
    bad = damage(CLEAN, chain)
    assert bad != CLEAN and codecs.is_suspect(bad)
    best = codecs.best_chain(bad)
    assert codecs.splice(bad, codecs.repair_spans(bad, best))[0] == CLEAN, best


@pytest.mark.parametrize("text", DECOYS[1:] + [CLEAN])
def test_decoys_have_no_chain(text):
    assert codecs.best_chain(text) is None


def test_marks_map_back():
    bad = damage(CLEAN, "utf8_cp1252")
    fixed, marks = codecs.splice(bad, codecs.repair_spans(bad, "utf8_cp1252"))
    from dimskog.llm.pii import Mapper

    m = Mapper()
    m.add(marks)
    for word in CLEAN.split():
        i = fixed.index(word)
        assert bad[m.back(i, False) : m.back(i + len(word), True)] == damage(word, "utf8_cp1252")


def test_whole_operator(spark, tables):
    lines = [CLEAN, "Väntar på besked från Björn under trädgårdsdagen, något förhöjd.", "Kärlmätning i båda benen pågår, höftvärk lättar något på kvällen."]
    notes = [(i, lines[i % 3], "u") for i in range(300)] + [(400 + i, t, "u") for i, t in enumerate(DECOYS)] + [(500, None, "u"), (501, "", None), (502, " ", None)]
    bad = [damage(lines[k % 3], c) for k, c in enumerate(["utf8_cp1252", "latin1_cp437", "utf8_mac", "latin1_cp1251", "utf8_cp1252_twice"] * 3)]
    bad += [lines[0].replace("ä", "{").replace("å", "}").replace("ö", "|"), lines[1].replace("ä", "�"), lines[2].replace("ä", "?").replace("å", "?").replace("ö", "?"), "Lätt v" + damage("ä", "utf8_latin1") + "rk."]
    rows = [(i, "train", None, t, None) for i, t in enumerate(bad)]
    folder = tables(notes=notes, rows=rows)
    got = {(r.tbl, r.row_id) for r in garble.found(spark, folder).collect()}
    assert got == {("sv_pure3", i) for i in range(len(bad))}
    fixed = {r.row_id: r.restored for r in garble.restored(spark, folder).collect()}
    for i in range(15):
        assert fixed[i] == lines[i % 3]
    assert fixed[15] == lines[0] and fixed[18] == "Lätt värk."


def test_nothing_there(spark, tables):
    assert garble.found(spark, tables()).count() == 0
    assert garble.found(spark, tables(notes=[(1, "Allt väl", "u")])).count() == 0


def test_everyday_signs_between_letters_are_evidence(spark, tables):
    """An ö read as a closing quotation mark, nothing else being wrong."""
    clean = ["Mötet var bra och högst lämpligt.", "Högst möjliga dos sattes in för besvären.", "Åter till läkare om böjning gör ont i höften."]
    notes = [(i, clean[i % 3], "u") for i in range(90)] + [(200, "Tåget Malmö–Lund gick, ”kort” sagt.", "u")]
    rows = [(i, "train", None, clean[i].replace("ö", "”").replace("ä", "„"), None) for i in range(3)] + [(9, "train", None, "M”tet var bra.", None)]
    folder = tables(notes=notes, rows=rows)
    assert {(r.tbl, r.row_id) for r in garble.found(spark, folder).collect()} == {("sv_pure3", i) for i in (0, 1, 2, 9)}
    assert {r.row_id: r.restored for r in garble.restored(spark, folder).collect()} == {**dict(enumerate(clean)), 9: "Mötet var bra."}


def test_two_chains_in_one_text_are_both_undone():
    seen = {}
    for t in [CLEAN, "Modern är orolig och mötet ställdes in när hon hörde av sig."] * 50:
        for a, c, b in garble.CONTEXT.findall(t):
            key = (garble._near(a), c, garble._near(b))
            seen[key] = seen.get(key, 0) + 1
    bad = "Modern " + damage("är", "utf8_cp1252") + " orolig och m”tet st„lldes in när hon hörde av sig."
    for own in ({"utf8_cp1252": 0.99, "cp850_latin1": 0.95}, {"utf8_cp1252": 0.99, "cp850_latin1": 0.95, "latin1_cp850": 0.6}):
        assert garble.restore(bad, own, seen) == "Modern är orolig och mötet ställdes in när hon hörde av sig."
    half = garble.restore(bad, {"cp850_latin1": 0.9, "latin1_mac": 0.6, "mac_latin1": 0.6}, seen)
    assert damage("är", "utf8_cp1252") in half or "Modern är" in half


def test_a_source_has_its_own_weight():
    """Equal signatures: damage in a source that is full of it, as written in one that is not."""
    counts = [(0, "latin1_cp437", 2, 1, 400), (1, "latin1_cp437", 2, 1, 3), (0, "latin1_cp437", 3, 2, 300), (1, "latin1_cp437", 1, 1, 900)]
    p = garble.fit(counts, [1_000, 1_000_000])
    assert p[0, "latin1_cp437", 2, 1] > 0.9 > p[1, "latin1_cp437", 2, 1]
