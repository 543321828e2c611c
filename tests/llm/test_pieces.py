"""Greedy cuts by pointer doubling against one cut after another, and the promises of the pieces."""

import random

import pytest

from dimskog.llm import pieces

TEXTS = [
    "", "kort", "x" * 500, "ord " * 200, "En mening. " * 60, "Stycke ett.\n\nStycke två är lite längre.\nRad.\n\n" * 12, "á" * 200, "👩‍⚕️" * 80, "rad\r\n" * 90,
    "\n" * 300, "ett,två;tre " * 50, "å" * 59 + " " + "ö" * 59 + ". " + "ä" * 400,
]


def one_by_one(text, limit, overlap):
    step = pieces.successors(text, limit, overlap)
    out, at = [], 0
    while at < len(text):
        at = int(step[at])
        out.append(at)
    return out or [0]


@pytest.mark.parametrize("limit, overlap", [(60, 10), (40, 0), (7, 3), (2, 1), (1, 0)])
def test_doubling_equals_greedy(limit, overlap):
    for t in TEXTS:
        ends = pieces.cuts(t, limit, overlap)
        assert ends == ([len(t)] if len(t) <= limit else one_by_one(t, limit, overlap))
        spans = pieces.spans(t, limit, overlap)
        assert all(0 <= s and e - s <= limit for s, e in spans) and spans[-1][1] == len(t) and spans[0][0] == 0
        assert all(b[0] == a[1] - overlap for a, b in zip(spans, spans[1:]))
        whole = t[spans[0][0] : spans[0][1]] + "".join(t[a[1] : b[1]] for a, b in zip(spans, spans[1:]))
        assert whole == t


def test_breaks_are_used():
    t = "Stycke ett är här nu.\n\nStycke två kommer sedan och är långt nog för att delas."
    assert pieces.cuts(t, 45, 0)[0] == t.index("Stycke två")
    s = "En mening till här. En annan mening som är längre än den första var."
    assert pieces.cuts(s, 30, 0)[0] == s.index("En annan")
    assert pieces.cuts("a" * 30 + " " + "b" * 30, 40, 0)[0] == 31


def test_random_promises():
    rnd = random.Random(2)
    for _ in range(60):
        t = "".join(rnd.choice("ab .\n,;é") for _ in range(rnd.randint(0, 400)))
        limit = rnd.randint(2, 90)
        overlap = rnd.randint(0, limit - 1)
        assert pieces.cuts(t, limit, overlap) == ([len(t)] if len(t) <= limit else one_by_one(t, limit, overlap))


def test_first_piece_is_longer_than_the_overlap():
    t = "kort ord " + "x" * 300
    assert pieces.spans(t, 60, 40)[:2] == [(0, 60), (20, 80)]


def test_bad_overlap():
    with pytest.raises(ValueError):
        pieces.cuts("x" * 99, 10, 10)


def test_operator(spark, tables):
    notes = [(1, "x " * 100, "u"), (2, "kort", "u"), (3, None, "u"), (4, "", "u"), (1, "x " * 100, "u")]
    rows = [(1, "train", "s", "y" * 41, None), (2, "train", "s", "y" * 40, None)]
    folder = tables(notes=notes, rows=rows)
    assert sorted((r.tbl, r.row_id) for r in pieces.found(spark, folder).collect()) == [("notes", 1), ("notes", 1), ("sv_pure3", 1)]
    every = pieces.all_pieces(spark, folder).collect()
    assert {(r.tbl, r.row_id, r.n_pieces) for r in every if r.n_pieces == 1} == {("notes", 2, 1), ("notes", 4, 1), ("sv_pure3", 2, 1)}
    assert all(r.piece == ("x " * 100)[r.start_pos : r.end_pos] for r in every if r.tbl == "notes" and r.row_id == 1)


def test_hard_cuts_keep_clusters_whole():
    for unit in ("🇸🇪", "👩‍⚕️", "각", "á", "नि"):
        t = unit * 60
        for end in pieces.cuts(t, 21, 0)[:-1]:
            assert end % len(unit) == 0, (unit, end)


def test_rejoined(spark, tables):
    folder = tables(notes=[(1, "x " * 100, "u"), (2, None, "u"), (3, "", "u"), (4, "🇸🇪" * 99, "u")], rows=[(1, "train", "s", "y" * 41, None)])
    assert {tuple(r) for r in pieces.rejoined(spark, folder).collect()} == {(t, i, n, True, True, True) for t, i, n in (("notes", 1, 200), ("notes", 3, 0), ("notes", 4, 198), ("sv_pure3", 1, 41))}
