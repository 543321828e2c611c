"""Encoding chains: how a text written in one encoding looks when it is read in another.

A chain is a list of (written as, read as) steps.  Its inverse table maps each character sequence
that the chain produces to the character that was meant.  All tables are derived from Python's
codecs; nothing is listed by hand except the national 7-bit set, which Python lacks.
"""

from __future__ import annotations

import re
from functools import cache

# name -> steps (written as, read as)
STEPS = {
    "utf8_latin1": [("utf-8", "latin-1")],
    "utf8_cp1252": [("utf-8", "cp1252")],
    "utf8_cp1252_twice": [("utf-8", "cp1252"), ("utf-8", "cp1252")],
    "utf8_latin1_twice": [("utf-8", "latin-1"), ("utf-8", "latin-1")],
    "utf8_cp437": [("utf-8", "cp437")],
    "utf8_cp850": [("utf-8", "cp850")],
    "utf8_mac": [("utf-8", "mac_roman")],
    "utf8_cp1251": [("utf-8", "cp1251")],
    "latin1_cp437": [("latin-1", "cp437")],
    "latin1_cp850": [("latin-1", "cp850")],
    "latin1_mac": [("latin-1", "mac_roman")],
    "latin1_cp1251": [("latin-1", "cp1251")],
    "latin1_koi8": [("latin-1", "koi8_r")],
    "cp850_latin1": [("cp850", "cp1252")],
    "mac_latin1": [("mac_roman", "cp1252")],
}
# The Swedish national 7-bit set (SEN 850200 Annex C) read as ASCII.
SEVEN_BIT = {"{": "ä", "}": "å", "|": "ö", "[": "Ä", "]": "Å", "\\": "Ö", "`": "é", "~": "ü", "^": "Ü"}
LOST, QUESTION, NATIONAL = "lost", "question", "seven_bit"

#: Letters that a Swedish, Nordic or foreign name is expected to use beside a-z.
EXPECTED = "åäöÅÄÖéÉüÜøØæÆáÁçÇëËşŞłŁïèàñíóôêâûîćžšßı"
LETTER = re.compile(r"[^\W\d_]")


def _step(char: str, written: str, read: str) -> str | None:
    try:
        data = char.encode(written)
    except UnicodeEncodeError:
        if len(char) == 1 and 0x80 <= ord(char) < 0xA0 and written != "utf-8":
            data = bytes([ord(char)])
        else:
            return None
    out = []
    for byte in data:  # bytes that a code page leaves undefined are read as C1 controls
        try:
            out.append(bytes([byte]).decode(read))
        except UnicodeDecodeError:
            out.append(chr(byte))
    return "".join(out)


def forward(char: str, chain: str) -> str | None:
    """How the chain shows ``char``, or None where the chain cannot write it."""
    for written, read in STEPS[chain]:
        parts = [_step(c, written, read) for c in char]
        if None in parts:
            return None
        char = "".join(parts)
    return char


def _alphabet(chain: str) -> list[str]:
    if chain.startswith("utf8"):
        spans = ((0xA0, 0x180), (0x370, 0x400), (0x400, 0x460), (0x2010, 0x2045), (0x20AC, 0x20AD), (0x2116, 0x2123), (0xFEFF, 0xFF00))
    else:
        spans = ((0xA0, 0x100),)
    return [chr(c) for lo, hi in spans for c in range(lo, hi)]


@cache
def inverse(chain: str) -> tuple[dict[str, str], int, re.Pattern]:
    """(sequence -> character meant, longest sequence, pattern of first characters) of a chain."""
    if chain == NATIONAL:
        table = dict(SEVEN_BIT)
    else:
        table = {}
        for c in _alphabet(chain):
            g = forward(c, chain)
            if g and g != c and not g.isascii():
                table.setdefault(g, c)
    first = "".join(sorted({re.escape(g[0]) for g in table}))
    return table, max(map(len, table)), re.compile(f"[{first}]")


ALL = [*STEPS, NATIONAL]
MULTI = [c for c in STEPS if c.startswith("utf8")]


def _lead_chars() -> set[str]:
    chars = {g[0] for c in STEPS for g in inverse(c)[0]} | {"\ufffd"} | set(SEVEN_BIT)
    return chars - set("åäöÅÄÖéÉüÜ–”°")  # everyday characters mark a text only as far as ``_suspect`` says


#: Java pattern of texts that may be damaged: any character but the everyday letters, with "?", square
#: brackets and everyday signs only beside letters.  One negated class, so that clean text is passed over quickly.
SUSPECT = (
    r"[^\x00-\x3e\x40-\x5a\x5f\x61-\x7aåäöÅÄÖéÉüÜ]"
    r"(?:(?<=[^?\[\]°–”])|(?<=\?)(?=\p{L})|(?<=\p{L}[\[\]°–”])(?=\p{L})|(?<=\s\[)(?=\p{Ll}{2,}[\s,.]))"
)


@cache
def leads(chain: str) -> frozenset[str]:
    """First characters of the chain's sequences."""
    return frozenset(g[0] for g in inverse(chain)[0])


#: Punctuation that is everyday text: as a damaged letter it must stand between two letters.
QUOTING = frozenset("‘’‚“”„†‡…–—«»‹›¿¡·")
# Bracketed placeholders, link texts, disguised signs and template fields, written as meant.
_MEANT = re.compile(r"\[[^\[\]\n]*@[^\[\]\n]*\]|(?<!\w)\[[^\W\d_-]+(?:-[^\W\d_]+)*\](?!\w)|\[[^\[\]\n]*\]\(|(?<!\w)\{\w+\}(?!\w)|(?<=\s)[|\\~^`](?=\s)")


_DISGUISE = re.compile(r"\[(?:at|punkt|dot|snabel-?a)\]", re.I)


def occurrences(text: str, chain: str) -> list[tuple[int, int, str]]:
    """Longest-match occurrences of the chain's sequences: (start, end, character meant)."""
    table, longest, first = inverse(chain)
    out, at = [], 0
    if chain == NATIONAL:
        for meant in (_DISGUISE, _MEANT):
            text = meant.sub(lambda m: " " * (m.end() - m.start()), text)
    for m in first.finditer(text):
        i = m.start()
        if i < at:
            continue
        if text[i] in QUOTING and chain not in MULTI and not (text[i - 1 : i].isalpha() and text[i + 1 : i + 2].isalpha()):
            continue
        for n in range(min(longest, len(text) - i), 0, -1):
            c = table.get(text[i : i + n])
            if c is not None:
                out.append((i, i + n, c))
                at = i + n
                break
    return out


def contexts(text: str, found: list[tuple[int, int, str]]) -> list[tuple[str, str, str]]:
    """(left letter, meant, right letter) of each occurrence, neighbours read as decoded; '' for no letter."""
    starts = {s: c for s, _, c in found}
    ends = {e: c for _, e, c in found}
    out = []
    for s, e, c in found:
        left = ends.get(s) or text[s - 1 : s]
        right = starts.get(e) or text[e : e + 1]
        out.append((left if LETTER.match(left) else "", c, right if LETTER.match(right) else ""))
    return out


_QUESTION = re.compile(r"[^\W\d_]\?+(?=[^\W\d_])")
_TOKEN = re.compile(r"\S+")


def questions(text: str) -> list[tuple[int, int]]:
    """Runs of '?' between letters, outside addresses: letters that were replaced."""
    out = []
    if "?" in text:
        for t in _TOKEN.finditer(text):
            word = t.group()
            if "?" in word and not ("@" in word or "/" in word or "=" in word):
                out += [(t.start() + m.start() + 1, t.start() + m.end()) for m in _QUESTION.finditer(word)]
    return out


def repair_spans(text: str, chain: str) -> list[tuple[int, int, str]]:
    """Occurrences of ``chain`` worth replacing: all of a multi-byte chain, of others those beside a letter that give a letter."""
    found = occurrences(text, chain)
    if chain in MULTI:
        return [x for x in found if x[1] - x[0] > 1 or x[2] in EXPECTED]
    near = contexts(text, found)
    out = []
    for x, (left, c, right) in zip(found, near):
        if c in EXPECTED and (left or right):
            if left and left.islower() and c.isupper() and not right.isupper():
                continue
            out.append(x)
        elif c in "°±·" and not chain == NATIONAL:
            out.append(x)
        elif c in EXPECTED and c.isupper() and text[x[1] : x[1] + 2] == ". ":
            out.append(x)  # an initial
    return out


@cache
def _suspect() -> re.Pattern:
    return re.compile("[" + "".join(re.escape(c) for c in sorted(_lead_chars())) + "]")


_SIGN = re.compile(r"[”–°](?<=[^\W\d_].)(?=[^\W\d_])")


def is_suspect(text: str) -> bool:
    return (_suspect().search(text) or _SIGN.search(text)) is not None


def best_chain(text: str) -> str | None:
    """The chain that explains most of a text by itself, without corpus statistics; None if none does.

    A multi-byte chain earns its Swedish letters and the number of damaged characters they account
    for, so that a chain applied twice wins over one of its own steps.
    """
    best, score = None, 0.0
    chars = set(text)
    for chain in ALL:
        if leads(chain).isdisjoint(chars):
            continue
        spans = repair_spans(text, chain)
        if not spans:
            continue
        swedish = sum(c in "åäöÅÄÖ" for _, _, c in spans)
        if chain in MULTI:
            good = sum((e - s) * (1.0 if c in EXPECTED or c in "°±–…½µ\ufeff" else 0.05) for s, e, c in spans)
        else:
            good = swedish + 0.3 * (len(spans) - swedish) - (1.0 if chain != NATIONAL else 0.5)
            if good < 0.8:
                continue
        if good > score + 1e-9:
            best, score = chain, good
    return best


def splice(text: str, spans: list[tuple[int, int, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(text with the spans replaced, breakpoints (position in the new text, shift to the old one))."""
    out, marks, at, made = [], [], 0, 0
    for s, e, c in spans:
        out.append(text[at:s])
        made += s - at
        out.append(c)
        made += len(c)
        marks.append((made, e - made))
        at = e
    out.append(text[at:])
    return "".join(out), marks
