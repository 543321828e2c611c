"""Propagation, dictionary scan, chunking and tags against brute force."""

import re

from pyspark.sql import functions as F

from dimskog.operators import chunking, coreference, gazetteer, tagging
from dimskog.schema import ENTITY

NOTE = "Anna Ek kom. Dr. Anna Ek, astma. Hon har astma (ej astmaliknande). Annas bror. Ek och Anna igen.\nAnna!"


def test_propagation(spark):
    docs = spark.createDataFrame([(1, NOTE), (2, None), (3, "")], "doc int, text string")
    rows = [(1, 0, "Dr. Anna Ek", "private_person", 13, 24, "bert", 1.0, None, "high"), (1, 1, "astma", "medical", 26, 31, "llm", 0.8, "sjukdom", "low"), (2, 0, "Anna", "private_person", 0, 4, "rule", 1.0, None, "high")]
    e = spark.createDataFrame(rows, f"doc int, {ENTITY}")
    got = {(r.start, r.end, r.text) for r in coreference.propagate(docs, e, ["doc"]).collect()}
    covered = [(13, 24), (26, 31)]
    want = set()
    for needle in ("Dr. Anna Ek", "Anna", "astma"):  # titles and short parts are no needles
        for m in re.finditer(rf"\b{re.escape(needle)}\b", NOTE):
            if not any(m.start() < b and m.end() > a for a, b in covered):
                covered.append(m.span())
                want.add((*m.span(), needle))
    assert got == want and ("astma" in {t for *_, t in got})


def test_gazetteer(spark):
    rows = [("Q1", None, "Björkö sjukhus", "hospital"), ("Q2", "Västra skolan", "Västra skolan", "place"), ("Q3", "Ek", "Ek", "family_name"), ("Q4", "Björkö", None, "family_name"), ("Q5", None, None, "place")]
    p = gazetteer.patterns(spark.createDataFrame(rows, "wikidata_id string, label_en string, label_sv string, category string"))
    got = {r.key: r.label for r in p.collect()}
    assert got == {"björkö sjukhus": "private_address", "björkö": "private_address", "västra skolan": "private_address"}
    text = "Till Björkö sjukhus, BJÖRKÖ; björkö, Björkös och xBjörkö."
    hits = gazetteer.scan(spark.createDataFrame([(1, text), (2, None)], "id int, text string"), p, "id").collect()
    assert {(r.start, r.end) for r in hits} == {(5, 19), (5, 11), (21, 27)}


def test_gazetteer_names_of_any_length(spark):
    """Five tokens, signs at the end, a hit inside a longer name; nothing beside a letter or digit."""
    rows = [("Q1", None, "Norra Björkö Gamla Stads Sjukstuga", "hospital"), ("Q2", None, "Hotellet (gamla)", "place"), ("Q3", None, "Björkö", "place"), ("Q4", None, "Eko.", "place")]
    p = gazetteer.patterns(spark.createDataFrame(rows, "wikidata_id string, label_en string, label_sv string, category string"))
    text = "Vid Norra Björkö gamla stads sjukstuga och Hotellet (Gamla), Hotellet (Gamla)x, Hotellet gamla; Eko. Eko.a Eko"
    hits = gazetteer.scan(spark.createDataFrame([(1, text), (2, ""), (3, None)], "id int, text string"), p, "id").collect()
    want = ["Norra Björkö gamla stads sjukstuga", "Björkö", "Hotellet (Gamla)", "Eko."]
    assert sorted((r.start, r.text) for r in hits) == sorted((text.index(w), w) for w in want) and all(text[r.start : r.end] == r.text for r in hits)
    none = spark.createDataFrame([], "key string, name string, label string")
    assert gazetteer.scan(spark.createDataFrame([(1, text)], "id int, text string"), none, "id").count() == 0


UNITS = ["Dr. Ek kom. Hon mår bra!\nNästa rad", "", "a", "En. Två.  Tre?!\n\nFyra kl. 8. x", "ingen punkt\n", "...", "Slut. " * 40]


def cut_units(text):
    out, at = [], 0
    for line in re.findall(r"[^\n]+\n?|\n", text):
        last = 0
        for m in re.finditer(r"[.!?]+(?=\s|$)", line):
            word = re.search(r"(\w+)\.?$", line[last : m.start()])
            if not (word and word[1].lower() in chunking.ABBREVIATIONS):
                out.append((at + last, at + m.end()))
                last = m.end()
        if last < len(line):
            out.append((at + last, at + len(line)))
        at += len(line)
    return out


def pack_units(units, most):
    out = []
    for s, e in units:
        if out and e - out[-1][0] <= most:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def test_units_and_packing(spark):
    df = spark.createDataFrame([(t,) for t in UNITS], "t string")
    for t, r in zip(UNITS, df.select("t", chunking.units(F.col("t")).alias("u"), chunking.packed(chunking.units(F.col("t")), 30).alias("p")).collect()):
        assert [tuple(x) for x in r.u] == cut_units(t), t
        assert [tuple(x) for x in r.p] == pack_units(cut_units(t), 30)
        assert "".join(t[s:e] for s, e in r.u) == t


def test_windows(spark):
    for n in (0, 1, 99, 100, 101, 150, 151, 1000):
        got = [tuple(x) for x in spark.createDataFrame([("x" * n,)], "t string").select(chunking.windows(F.col("t"), 100, 50)).first()[0]]
        want, s = [], 0
        while n and True:
            want.append((s, min(n, s + 100)))
            if s + 100 >= n:
                break
            s += 50
        assert got == want


def test_training_chunks(spark):
    text = "En Anna. Två\n\nTre Bo."
    rows = [(1, text, [(3, 7, "GIVENNAME"), (18, 20, "GIVENNAME"), (5, 12, "X")]), (2, " \n ", []), (3, "ab", None), (4, None, [])]
    df = spark.createDataFrame(rows, "id int, source_text string, privacy_mask array<struct<start_pos:int,end_pos:int,label:string>>")
    got = {(r.id, r.start_pos, r.end_pos): [tuple(s) for s in r.spans] for r in chunking.training_chunks(df, "id").collect()}
    assert got == {(1, 0, 9): [(3, 7, "GIVENNAME")], (1, 9, 13): [], (1, 14, 21): [(4, 6, "GIVENNAME")], (3, 0, 2): []}


def test_decode(spark):
    rows = [("B-Name", 0.9, 0, 0), ("B-Name", 0.9, 0, 4), ("I-Name", 0.9, 5, 7), ("I-Address", 0.9, 8, 12), ("I-Address", 0.5, 13, 15), ("S-X", 0.9, 16, 18), ("E-X", 0.8, 19, 20), ("B-X", 0.9, 21, 22)]
    want = [(0, 7, "private_person", 0.9), (8, 12, "private_address", 0.9), (16, 20, "X", 0.8), (21, 22, "X", 0.9)]
    assert [(s, e, label, conf) for s, e, label, _, conf in tagging.decoded(rows)] == want
    df = spark.createDataFrame([(rows,), (None,), ([],)], "t array<struct<tag:string,conf:double,cs:int,ce:int>>")
    got = [r[0] for r in df.select(tagging.decode(F.col("t"))).collect()]
    assert [(r.start, r.end, r.label, r.confidence) for r in got[0]] == want and got[1:] == [None, []]


def test_repair(spark):
    text = "Dr. Anna Ek, utredning. 45 år"
    spans = [(0, 2, "private_person", 0.9), (4, 6, "private_person", 0.8), (8, 12, "private_person", 0.95), (13, 22, "private_email", 0.9), (24, 26, "private_person", 0.9)]
    df = spark.createDataFrame([(text, spans)], "t string, s array<struct<start:int,end:int,label:string,confidence:double>>")
    got = [tuple(x) for x in df.select(tagging.repair(F.col("s"), F.col("t"))).first()[0]]
    assert got[0] == (0, 8, "private_person", 0.8) or got[0][:2] == (0, 12)
    assert (24, 26, "demographics", 0.9) in got and not any(x[2] == "private_email" for x in got)


def test_align(spark):
    df = spark.createDataFrame([("Anna Bo kom", [(0, 7, "Name"), (6, 7, "Age"), (8, 11, None), (None, 3, "Age")]), (None, []), ("x", None)], "t string, s array<struct<start:int,end:int,category:string>>")
    got = [r[0] and [(x.tok_idx, x.cs, x.ce, x.tag) for x in r[0]] for r in df.select(tagging.tags(F.col("t"), F.col("s"))).collect()]
    assert got == [[(0, 0, 4, "B-Name"), (1, 5, 7, "B-Age"), (2, 8, 11, "O")], None, [(0, 0, 1, "O")]]


def test_sub_words_of_special_tokens():
    tokens = [(0, 0), (0, 2), (2, 4), (5, 7), (0, 0)]
    ids = tagging.aligned(tokens, [(0, 4, "Name"), (5, 7, None)])
    assert ids == [-100, tagging.TAGS.index("B-Name"), tagging.TAGS.index("I-Name"), 0, -100]


def test_tags_and_repair_on_awkward_spans():
    assert tagging.repaired("", []) == [] and tagging.tagged([], [(0, 1, "Name")]) == []
    assert tagging.repaired("ab  ", [(2, 4, "x", 0.5), (0, 1, "x", 0.9)]) == [(0, 4, "x", 0.5)]
