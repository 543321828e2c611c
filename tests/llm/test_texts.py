"""Look-alikes, tokens, packing and reading levels."""

import random
import unicodedata

import pytest

from dimskog.llm import lookalike, packing, readability, tokens

PLAIN = ["", "Anna Ek", "Дом № 7", "Ελένη Λάμπρου", "β-blockerare", "München-resa", "Łucja O'Darragh", "36,3 °C", "Zoë Großkreuz", " två  blanksteg "]
ODD = {
    "Elsa von Ek": "Elsa von Ek", "Osѕian": "Ossian", "Ｆｕｒｏ１": "Furo1", "a​b﻿": "ab", "Ro\u0308nn": "Rönn", "Нb 156": "Hb 156", "Rӧnn": "Rönn",
    "lokfo​̈rare": "lokförare", "Kаrin\xa0": "Karin ", "­": "", "2024\t01": "2024 01", "νon": "von", "Åsa": "Åsa",
}


@pytest.mark.parametrize("text", PLAIN)
def test_plain_stays(text):
    assert lookalike.is_plain(text) and lookalike.plain(text) == text


@pytest.mark.parametrize("text, want", ODD.items())
def test_odd_becomes_plain(text, want):
    want = unicodedata.normalize("NFC", want)
    assert not lookalike.is_plain(text)
    assert lookalike.plain(text) == want and lookalike.plain(want) == want


def test_conflicts_are_refused(monkeypatch):
    monkeypatch.setattr(lookalike, "_form", lambda c: c + "x")
    with pytest.raises(ValueError):
        lookalike.Transducer(["a"])


def test_every_script_with_look_alikes_is_mapped():
    for text, want in {"Aոna": "Anna", "Կarin": None, "ᎪᎷanda": "AManda", "Օlof": "Olof", "Ꮶarin": "Karin", "а\u030asa": None, "K\u0430\u030artor": "Kårtor"}.items():
        got = lookalike.plain(text)
        if want:
            assert got == want and lookalike.is_plain(got) and not lookalike.is_plain(text)
    assert not lookalike.is_plain("Կarin") and lookalike.plain("Կarin") == "Կarin"  # looks like no Latin letter
    assert lookalike.is_plain("東京タワーの") and lookalike.is_plain("ᎠᎡᎢ") and lookalike.is_plain("Հայաստան")


def test_once_is_enough():
    rnd = random.Random(8)
    pool = ["a", "е", "ο", "\u0301", "\u200b", "\u200d", " ", "\xa0", "Ａ", "1", "ö", "o\u0308", "Ս", "\u1100", "\u1161", "ﾠ", "\ufe0f", "🇸", "🇪", "한", "ß", "\u0345", "µ", "Å"]
    for _ in range(3_000):
        t = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 12)))
        once = lookalike.plain(t)
        assert lookalike.plain(once) == once == unicodedata.normalize("NFC", once), (t, once)


def test_lookalike_queries(spark, data):
    audit = "audit_id long, note string, original string, label string, text string"
    key = "item_id long, note string, item_group string, text string"
    folder = data(
        audit=([(1, "n", "Аnna", "p", "z"), (2, "n", None, "p", "z"), (3, "n", "Anna ", "p", "z"), (4, "n", "", "p", "z")], audit),
        synthetic_notes_key=([(1, "n", "should_redact", "Ａnna"), (2, "n", "should_not_flag", "Ａnna"), (3, "n", "should_redact", None)], key),
    )
    assert {tuple(r) for r in lookalike.found(spark, folder).collect()} == {("audit", 1), ("synthetic_notes_key", 1)}
    assert {(r.item_id, r.findings, r.findings_as_is) for r in lookalike.matched(spark, folder).collect()} == {(1, 2, 0), (3, 0, 0)}


ENC = tokens.encoding(tokens.FOLDER, "byte_bpe_50k")


def test_stretches_encode_like_the_whole():
    rnd = random.Random(1)
    for _ in range(200):
        t = "".join(rnd.choice(["a", "bc", " ", "  ", "\n", "1", "22", "'s", ".", "å", "🙂", "!?", "\xa0"]) for _ in range(rnd.randint(0, 120)))
        cut = tokens.stretches(t, rnd.randint(1, 20))
        assert "".join(cut) == t
        ids = [i for s in cut for i in ENC.encode_ordinary(s)]
        assert ids == ENC.encode_ordinary(t) and tokens.decode(ids, ENC) == t


def test_ids(spark, data):
    rows = [(1, "Hej på dig"), (2, None), (3, ""), (4, "<|endoftext|>"), (5, "ord " * 30_000), (6, "å" * 50_000)]
    folder = data(documents=(rows, "doc_id long, text string"))
    got = {r.doc_id: r.ids for r in tokens.ids(spark, folder).collect()}
    assert got == {i: ENC.encode_ordinary(t or "") for i, t in rows} and got[2] == got[3] == [] and 50256 not in got[4]


def test_packing_promises(spark, data):
    rnd = random.Random(4)
    rows = [(i, " ".join(["ord"] * rnd.choice([0, 1, 2, 3, 5, 9, 14, 40])), rnd.choice(["a", "a", "a", "b", None])) for i in range(400)]
    rows += [(900, None, "a"), (901, "", None), (902, "ord " * 500, "b")]
    folder = data(documents=(rows, "doc_id long, text string, source string"), size_limits=([(3, "documents", "text", "tokens", 16, 0)], "limit_id int, tbl string, field_name string, size_unit string, max_size int, overlap_size int"))
    out = packing.packed(spark, folder).collect()
    size = {i: len(ENC.encode_ordinary(t or "")) for i, t, _ in rows}
    parts, room = {}, {}
    for r in out:
        parts.setdefault(r.doc_id, []).append(r)
        room[r.shard, r.sequence] = room.get((r.shard, r.sequence), 0) + r.n_tokens
    assert set(parts) == set(size) and all(sum(r.n_tokens for r in p) == size[i] for i, p in parts.items())
    assert all(len(p) == 1 for i, p in parts.items() if size[i] <= 16) and max(room.values()) <= 16
    assert len(room) <= 1.05 * (sum(size.values()) / 16) + 2
    positions = {(r.shard, r.sequence, r.position) for r in out}
    assert len(positions) == len(out)


def test_mixture_of_windows():
    items = [("a" if i % 3 else "b", i / 3000, 7 + i % 5) for i in range(3000)]
    for share in (None, {"a": 0.5, "b": 0.5}):
        out = packing.fill_shard(items, 100, 20, share)
        assert len(out) == 3000 and len({i for i, *_ in out}) == 3000
        windows = {}
        for i, sequence, _ in out:
            w = windows.setdefault(sequence // 20, {"a": 0, "b": 0})
            w[items[i][0]] += items[i][2]
        target = 0.5 if share else sum(s for k, _, s in items if k == "a") / sum(s for *_, s in items)
        full = [w for k, w in sorted(windows.items()) if min(w.values()) or not share][:-1]
        assert len(full) > 5 and all(abs(w["a"] / (w["a"] + w["b"]) - target) < 0.05 for w in full[:-1])


def test_a_deficit_is_paid_first():
    items = [("ab"[i % 2], i / 400, 10) for i in range(400)]
    first = lambda credit: sum(1 for i, seq, _ in packing.fill_shard(items, 100, 4, {"a": 1, "b": 1}, credit) if seq < 4 and items[i][0] == "a")
    assert first(None) == 20 and first({"a": 100.0, "b": -100.0}) == 30 and first({"a": -100.0, "b": 100.0}) == 10


def test_flow():
    flow = packing.Flow([100, 300, 50, 0], [100, 300, 50, 10], [0.5, 0.5, 0.0, 0.0])
    assert flow.end[:2].tolist() == [200.0, 600.0] and flow.start[2] == 600 and flow.passed[-1] == 1
    assert flow.tokens_at(1.0).tolist() == [100, 300, 50, 0] and flow.tokens_at(0.0).tolist() == [0, 0, 0, 0]
    half = flow.tokens_at(0.2)
    assert abs(half[0] - half[1]) < 1e-9 and half[2] == 0


def test_mixture_over_shards_with_given_targets(spark, monkeypatch):
    """Three shards and more: each window keeps the targets, and what one shard is ahead the next makes up for."""
    monkeypatch.setattr(packing, "SHARD_WEIGHT", 30_000)
    monkeypatch.setattr(packing, "WINDOW_SEQUENCES", 16)
    rnd = random.Random(6)
    rows = [(i, " ord" * rnd.randint(1, 60), "abb"[i % 3] if i % 20 else None) for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = packing.pack(docs, 128, targets={"a": 2.0, "b": 1.0}).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, *_ in rows)
    windows, shards = {}, {}
    for r in out:
        w = windows.setdefault((r.shard, r.sequence // 16), {})
        w[r.source] = w.get(r.source, 0) + r.n_tokens
        s = shards.setdefault(r.shard, {})
        s[r.source] = s.get(r.source, 0) + r.n_tokens
    assert len(shards) > 4 and max(sum(1 for r in out if r.shard == k) for k in shards) < 1.1 * 30_000 / packing.BASE
    last = max(r.shard for r in out if r.source == "a")  # until one source is used up, all keep to the targets
    full = [w for (s, _), w in sorted(windows.items()) if s < last and sum(w.values()) > 15 * 128]
    assert len(full) > 8 and all(abs(w["a"] / sum(w.values()) - 2 / 3) < 0.04 for w in full)
    a = b = 0
    for k in range(last):
        a, b = a + shards[k]["a"], b + shards[k]["b"]
        assert abs(a - 2 * b) < 3 * 240  # over every seam within a few documents, so nothing adds up
    assert all(None not in shards[k] for k in range(last))  # a source without a target comes last


def test_totals(spark, data):
    rows = [(i, " ord" * (i % 40), "ab"[i % 2] if i % 5 else None) for i in range(300)]
    limits = ([(3, "documents", "text", "tokens", 16, 0)], "limit_id int, tbl string, field_name string, size_unit string, max_size int, overlap_size int")
    folder = data(documents=(rows, "doc_id long, text string, source string"), size_limits=limits)
    assert {tuple(r) for r in packing.totals(spark, folder).collect()} == {(s, sum(1 for r in rows if r[2] == s), 0, 0, 0) for s in ("a", "b", None)}
    assert packing.fill_report(spark, folder).count() == 1


def test_documents_without_tokens_are_many_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_WEIGHT", 2_000)
    docs = spark.createDataFrame([(i, None if i % 2 else "", "a") for i in range(1_000)], "doc_id long, text string, source string")
    out = packing.pack(docs, 16).groupBy("shard").count().collect()
    assert len(out) == 10 and sum(r["count"] for r in out) == 1_000 and max(r["count"] for r in out) <= 101


def test_packing_edge_cases(spark):
    assert packing.fill_shard([], 10, 4) == []
    assert sorted(packing.fill_shard([("a", 0.1, 0), (None, 0.2, 0)], 10, 4))[0][0] == 0
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert packing.pack(none, 16).count() == 0


EASY = "Du ska få en liten bok. Den är röd. Mamma är med dig. Vi äter glass sen."
HARD = "Den multivariata regressionsmodellen, innefattande neurodegeneration och hemodynamisk instabilitet, predicerade mortalitetsutfallet oberoende av komorbiditetsbördan hos intensivvårdspatienter."


def test_levels_order():
    easy, hard = readability.measures(EASY), readability.measures(HARD)
    assert easy[-1] < hard[-1] and easy[0] == hard[0] == "sv" and easy[1] == 4
    assert readability.measures("The child has a red ball. It is big.")[0] == "en"
    assert readability.measures("Barnet har det bra, og jeg er ikke redd for noe.")[0] == "no"
    assert readability.measures("Hän ei ole täällä, mutta se on hyvin.")[0] == "fi"
    assert readability.measures(None) is readability.measures("") is readability.measures(" \n 12 34") is None


@pytest.mark.parametrize("word, lang, n", [("läsa", "sv", 2), ("station", "sv", 2), ("time", "en", 1), ("little", "en", 2), ("reading", "en", 2), ("hyvää", "fi", 2), ("x", "en", 1)])
def test_syllables(word, lang, n):
    assert readability.syllables(word, lang) == n


def test_levels_operator(spark, data):
    rows = [(i, EASY if i % 2 else HARD) for i in range(40)] + [(90, None), (91, " "), (92, "x" * 100_000)]
    labels = [(i, i, "g1", 1 if i % 2 else 5) for i in range(40)] + [(50, 1, "g1", 1), (51, 2, "g2", None), (52, 777, "g1", 3)]
    folder = data(documents=(rows, "doc_id long, text string"), reading_labels=(labels, "label_id long, doc_id long, grader string, reading_level int"))
    got = {r.doc_id: r.level for r in readability.levels(spark, folder).collect()}
    assert got[1] < 1.5 and got[2] > 4.5 and got[90] is got[91] is None and 1 <= got[92] <= 5
    empty = data(documents=([], "doc_id long, text string"), reading_labels=([], "label_id long, doc_id long, grader string, reading_level int"))
    assert readability.levels(spark, empty).count() == 0
