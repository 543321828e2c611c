"""Personal information inside free text: typed spans of the stored text, and the redacted text.

Offset-preserving deobfuscation
-------------------------------
Every text passes a chain of transducers, each of which records where it changed the length:
encoding damage is undone, full-width forms, invisible characters and look-alike letters are folded,
and runs of spelled digits become digits.  Detectors run on that normal text; each span is then
mapped back through the recorded shifts to code points of the text as stored.  Disguised signs of
e-mail addresses ("(at)", "[punkt]", spaced "@") are part of the address grammar, so that the span
covers the disguise.

Names are recognised by vocabularies: given names and surnames come from the labelled masks of a
bounded sample of rows (``LABELLED_ROWS``) and from the gazetteer, and surnames generalise to unseen
compounds whose first and last part both occur in many known surnames.

Defined results: null texts give no row, empty texts no span; spans never overlap (e-mail before
identity number before phone before street before person); a mask never decides a span; extra
columns are ignored.  Long texts are scanned whole.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimskog.llm import codecs
from dimskog.llm.corpus import map_batches, note_texts
from dimskog.runtime import table

#: About so many labelled rows at most teach names; the vocabulary saturates long before.
LABELLED_ROWS = 8_000
#: A surname part counts when it joins so many different other parts.
PART_SUPPORT = 6

#: Stand-ins for a letter that was lost to U+FFFD or "?"; names and ways are also known with them.
LOST_UPPER, LOST_LOWER = "\u01a2", "\u01a3"
UPPER = "A-ZÀ-ÖØ-ÞŁŞĆČŠŽ" + LOST_UPPER
CAP = rf"[{UPPER}][^\W\d_]*(?:[-’'][^\W\d_]+)*"
PARTICLE = r"(?:(?:af|von|de|van|der|la|di|du|el|al) )"
RUN = re.compile(rf"(?:[{UPPER}]\.|{CAP})(?:,? {PARTICLE}*(?:[{UPPER}]\.|{CAP}))*\.?")
TOKEN = re.compile(rf"(,? ?)({PARTICLE}*)({CAP}\.?)")
TITLES = frozenset("dr dr. doktor prof prof. fru herr ssk överläkare st-läkare läkare psykolog sjuksköterska professor".split())
LONGEST_TITLE = max(map(len, TITLES))
AT = re.compile(r"[@＠\[(](?:(?<=[@＠])| ?(?:at|snabel-?a) ?[\])])", re.I)
DOT = r"(?:\.| ?[\[(] ?(?:punkt|dot) ?[\])] ?)"
LONGEST_DOT = len(" [ punkt ] ")
LOCAL = re.compile(rf"(?:[\w+%-]+{DOT})*[\w+%-]+ ?$", re.I)
DOMAIN = re.compile(rf" ?(?:[^\W_][\w-]*{DOT})+[^\W\d_]{{2,}}", re.I)
ROLE = frozenset("info registrator kontakt reception remiss support noreply no-reply kansli postmaster avdelningen mottagningen".split())
DIGITS = re.compile(r"[+(\d](?<!\w.)(?:(?<=\d)|\d)[\d \-./()+]{6,}\d")
PHONE = re.compile(r"(?<![\w+/.\-])(?:\+\d{1,3}|00\d\d|0)(?: ?\(0\))?(?:(?: - |[ \-/.])?\d){6,11}(?![\w]|-\d)")
IDENT = re.compile(r"(?<![\w\-+])(?:(?:19|20)\d\d(\d\d)(\d\d)[-+ ]?\d{4}|\d\d(\d\d)(\d\d)[-+ ]\d{4})(?![\w]|-\d)")
PASSPORT = re.compile(r"[A-Z]{2}(?<!\w..)\d{7}(?!\w)")
NOT_PERSONAL = re.compile(r"(?:orgnr|(?<!telefon)(?<!tel)(?<!mobil)\w(?:nr|nummer)|ocr|box|mätvärden|portvärde|serie|lot|batch|faktura|artikel|remiss|referens|ref|organisationsnummer)[.:]? ?$", re.I)
#: No word of the two patterns, with its sign and space, is longer.
LONGEST_MARK = len("xorganisationsnummer: ")
PERSONAL = re.compile(r"(?:person|samordnings|pass|telefon|mobil|nytt )(?:nr|nummer)[.:]? ?$", re.I)
WAYS = "gatan|gata|vägen|väg|stigen|stig|gränden|gränd|backen|backe|allén|allé|torget|torg|stranden|promenaden|platsen"
WAYS = "|".join([WAYS, *(re.sub("[^a-z]", LOST_LOWER, w) for w in WAYS.split("|") if not w.isascii())])
_WAY_ENDS = tuple(WAYS.split("|"))
LONGEST_WAY = max(map(len, _WAY_ENDS))
HOUSE = re.compile(r" (\d{1,4}(?: ?- ?\d{1,4}| ?[A-H](?![\w/]))?)(?!\w)")
ADJECTIVES = "Norra|Södra|Östra|Västra|Stora|Lilla|Gamla|Nya|Övre|Nedre|Inre|Yttre"
ADJECTIVES += "|" + ADJECTIVES.upper()
ADJECTIVES += "|Sƣdra|Vƣstra|Ƣstra|Ƣvre|SƣDRA|VƣSTRA|ƢSTRA|ƢVRE"
STREET_HEAD = re.compile(
    rf"(?:(?:{ADJECTIVES}) [^\W\d_][\w-]*"
    rf"|(?:[{UPPER}][^\W\d_]+ )?[{UPPER}][\w-]*[sS] (?i:{WAYS})|[{UPPER}][\w-]*)$"
)

# Swedish digit words.
DIGIT_WORDS = {"noll": "0", "ett": "1", "en": "1", "två": "2", "tre": "3", "fyra": "4", "fem": "5", "sex": "6", "sju": "7", "åtta": "8", "nio": "9"}
DIGIT_WORDS |= {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_D = "|".join(DIGIT_WORDS)
SPELLED = re.compile(rf"(?<!\w)(?:plus )?(?:{_D})(?:[ ,-]+(?:{_D})){{6,}}(?!\w)", re.I)
#: Six digit words after another one, in lower case; begins with a plain set, so that texts without are passed over quickly.
_MAY_SPELL = re.compile(rf"[ ,-](?:{_D})(?:[ ,-]+(?:{_D})){{5}}")
#: Characters that encoding damage leaves in a text of ASCII alone.
_NATIONAL = re.compile("[" + re.escape("".join(codecs.SEVEN_BIT)) + "]")

#: The placeholders of the project, by kind.
PLACEHOLDERS = {"email": "[E-POST]", "phone": "[TELEFON]", "id_number": "[ID-NUMMER]", "street": "[ADRESS]", "person": "[PERSON]"}

_ODD = re.compile("[\\u00ad\\u200b-\\u200f\\u2060\\ufeff\\uff01-\\uff5e\\u0370-\\u03ff\\u0400-\\u058f\\u13a0-\\u13ff\\u0300-\\u036f]")


def _lossy(name: str) -> str:
    return re.sub(r"[^\x00-\x7f]", LOST_LOWER, name)


class Names:
    """Given names, surnames and surname parts, all in lower case."""

    def __init__(self, given: set[str], surnames: set[str]):
        self.given = {v for g in given if len(g) > 1 for v in (g, _lossy(g))}
        self.surnames = {v for s in surnames if len(s) > 2 for v in (s, _lossy(s), s.replace("ß", "ss"))}
        heads, tails = defaultdict(set), defaultdict(set)
        for s in self.surnames:
            for i in range(2, len(s) - 1):
                heads[s[:i]].add(s[i:])
                tails[s[i:]].add(s[:i])
        self.heads = {h for h, t in heads.items() if len(t) >= PART_SUPPORT}
        self.tails = {t for t, h in tails.items() if len(h) >= PART_SUPPORT}
        self._memo: dict[str, int] = {}

    def kind(self, word: str) -> int:
        """1 given name, 2 surname, 0 neither; hyphenated words by their parts."""
        k = self._memo.get(word)
        if k is None:
            k = self._memo[word] = self._kind(word.lower())
        return k

    def _kind(self, w: str) -> int:
        if w in self.given:
            return 1
        if self._surname(w):
            return 2
        if "-" in w:
            parts = w.split("-")
            if all(p in self.given for p in parts):
                return 1
            if all(self._surname(p) for p in parts):
                return 2
        return 0

    def _surname(self, w: str) -> bool:
        return w in self.surnames or any(w[:i] in self.heads and w[i:] in self.tails for i in range(2, len(w) - 1))


_NAME = re.compile(rf"[{UPPER}][^\W\d_]*[^\W\d_{UPPER}][^\W\d_]*(?:[-’ ][{UPPER}][^\W\d_]+)*$")


def learn_names(spark: SparkSession, sf_dir: str) -> Names:
    """Vocabulary from the masks of at most LABELLED_ROWS rows and from the gazetteer (fixed size).

    The rows are taken by hash, so they stand for all sources and days; a value counts when it occurs
    twice, looks like a name and its span does not begin or end inside a word (shifted masks do).
    """
    every = table(spark, sf_dir, "sv_pure3")
    rows = every.where("size(privacy_mask) > 0 and source_text is not null")
    names = F.expr(
        "transform(filter(privacy_mask, m -> m.label in ('GIVENNAME', 'SURNAME')), m -> struct(m.label as label, "
        "substring(source_text, m.start_pos + 1, m.end_pos - m.start_pos) as v, "
        "substring(source_text, greatest(m.start_pos, 1), if(m.start_pos > 0, 1, 0)) as b, substring(source_text, m.end_pos + 1, 1) as a))"
    )
    seen: Counter = Counter()
    each = -(-max(1, every.count()) // LABELLED_ROWS)
    sample = rows.where(F.pmod(F.xxhash64("row_id"), F.lit(each)) == 0).select(names.alias("names"))
    for row in sample.collect():  # about LABELLED_ROWS at most
        for m in row.names:
            if m.v and not m.b.isalpha() and not m.a.isalpha() and _NAME.match(m.v) and codecs.best_chain(m.v) is None:
                seen[m.label, m.v] += 1
    given = {p.lower() for (label, v), n in seen.items() if label == "GIVENNAME" and n > 1 for p in v.split(" ")}
    surnames = {p.lower() for (label, v), n in seen.items() if label == "SURNAME" and n > 1 for p in v.split(" ")[-1].split("-")}
    for r in table(spark, sf_dir, "gazetteer").where("category in ('given_name', 'family_name')").collect():  # fixed size
        for v in (r.label_sv, r.label_en):
            if v:
                (given if r.category == "given_name" else surnames).add(v.strip().lower())
    return Names(given, surnames - given)


# ---------------------------------------------------------------- transducers


def _fold(text: str) -> tuple[str, list]:
    """Fold full-width forms, invisible characters, combining accents and look-alikes in mixed words."""
    from dimskog.llm.lookalike import LOOKALIKE

    spans = []
    n = len(text)
    for m in _ODD.finditer(text):
        i, c = m.start(), m.group()
        if "！" <= c <= "～":
            spans.append((i, i + 1, chr(ord(c) - 0xFEE0)))
        elif unicodedata.category(c) == "Cf":
            spans.append((i, i + 1, ""))
        elif unicodedata.combining(c):
            if i and not (spans and spans[-1][1] > i - 1):
                both = unicodedata.normalize("NFC", text[i - 1] + c)
                if len(both) == 1:
                    spans.append((i - 1, i + 1, both))
        elif c in LOOKALIKE and ((i and text[i - 1].isalpha() and text[i - 1] < "ɐ") or (i + 1 < n and text[i + 1].isalpha() and text[i + 1] < "ɐ")):
            spans.append((i, i + 1, LOOKALIKE[c]))
    return codecs.splice(text, spans)


def _digits(text: str) -> tuple[str, list]:
    spans = [
        (m.start(), m.end(), "".join("+" if w.lower() == "plus" else DIGIT_WORDS[w.lower()] for w in re.findall(r"\w+", m.group())))
        for m in SPELLED.finditer(text)
    ]
    return codecs.splice(text, spans)


class Mapper:
    """Maps positions of the normal text back through every transducer to the stored text."""

    def __init__(self):
        self.layers: list[tuple[list[int], list[int]]] = []

    def add(self, marks: list[tuple[int, int]]) -> None:
        if marks:
            self.layers.append(([p for p, _ in marks], [s for _, s in marks]))

    def back(self, position: int, end: bool) -> int:
        for at, shift in reversed(self.layers):
            # an end inside or at a replaced piece belongs to the end of that piece
            i = bisect_right(at, position) - 1
            position = position + (shift[i] if i >= 0 else 0)
        return position


def _lost(text: str) -> tuple[str, list]:
    """A letter in place of each lost one: U+FFFD, or "?" in a text that shows them inside words."""
    pattern = "\ufffd{1,3}"
    if len(codecs.questions(text)) >= 2:
        pattern += r"|(?<=[^\W\d_])\?+|\?+(?=[^\W\d_])"
    spans = []
    for m in re.finditer(pattern, text):
        inside = m.start() and text[m.start() - 1].isalpha()
        spans.append((m.start(), m.end(), LOST_LOWER if inside else LOST_UPPER))
    return codecs.splice(text, spans)


def normal_form(text: str) -> tuple[str, Mapper]:
    mapper = Mapper()
    if not text.isascii() or _NATIONAL.search(text):
        for _ in range(3):  # a text may have gone through more than one chain
            if not codecs.is_suspect(text):
                break
            chain = codecs.best_chain(text)
            if not chain:
                break
            text, marks = codecs.splice(text, codecs.repair_spans(text, chain))
            mapper.add(marks)
        if _ODD.search(text):
            text, marks = _fold(text)
            mapper.add(marks)
    if "\ufffd" in text or "?" in text and codecs.questions(text):
        text, marks = _lost(text)
        mapper.add(marks)
    if _MAY_SPELL.search(text.lower()):
        text, marks = _digits(text)
        mapper.add(marks)
    return text, mapper


# ---------------------------------------------------------------- detectors


def _emails(t: str) -> list[tuple[int, int, str]]:
    out, at = [], 0
    if "@" in t or "＠" in t or ")" in t or "]" in t:
        for m in AT.finditer(t):
            left = _local(t, at, m.start())
            right = DOMAIN.match(t, m.end())
            if left and right:
                s, e = left.start(), right.end()
                while t[s] in "._-+%":
                    s += 1
                if t[s : s + 7].lower() == "mailto:":
                    s += 7
                if t[s : m.start()].strip().lower() not in ROLE:
                    out.append((s, e, "email"))
                at = e
    return out


def _local(t: str, low: int, at: int) -> re.Match | None:
    """The local part that ends at ``at``, whatever its length: a window that grows until none of it, nor a dot, is cut."""
    size = 90
    while True:
        pos = max(low, at - size)
        left = LOCAL.search(t, pos, at)
        if pos == low or left is None or left.start() - pos > LONGEST_DOT:
            return left
        size *= 4


def _numbers(t: str) -> list[tuple[int, int, str]]:
    out = []
    for chunk in DIGITS.finditer(t):
        a, b = chunk.span()
        at = a
        for m in IDENT.finditer(t, a, b):
            mm, dd = (m[1], m[2]) if m[1] else (m[3], m[4])
            day = int(dd)
            if 1 <= int(mm) <= 12 and (1 <= day <= 31 or 61 <= day <= 91) and not _other(t, m.start()):
                out.append((*m.span(), "id_number"))
                at = m.end()
        for m in PHONE.finditer(t, at, b):
            n = sum(c.isdigit() for c in m.group())
            if 8 <= n <= 14 and not _other(t, m.start()) and not any(s < m.end() and m.start() < e for s, e, _ in out[-3:]):
                out.append((*m.span(), "phone"))
    for m in PASSPORT.finditer(t):
        if not _other(t, m.start()):
            out.append((*m.span(), "id_number"))
    return out


def _other(t: str, at: int) -> bool:
    """Whether the words before say that the number belongs to a thing or an organisation."""
    before = t[max(0, at - LONGEST_MARK) : at]
    return bool(NOT_PERSONAL.search(before)) and not PERSONAL.search(before)


def _streets(t: str) -> list[tuple[int, int, str]]:
    out = []
    for m in HOUSE.finditer(t):
        if not t[max(0, m.start() - LONGEST_WAY) : m.start()].lower().endswith(_WAY_ENDS):
            continue
        pos = m.start()
        for _ in range(4):  # a head has three words at most
            pos = max(0, t.rfind(" ", 0, pos))
        head = STREET_HEAD.search(t, pos, m.start())
        if head and (head.start() == 0 or not (t[head.start() - 1].isalnum() or t[head.start() - 1] in "-_")):
            out.append((head.start(), m.end(1), "street"))
    return out


def _persons(t: str, names: Names, lower) -> list[tuple[int, int, str]]:
    out = []
    kind = names.kind
    for run in RUN.finditer(t):
        body = run.group()
        if len(body) < 2:
            continue
        base = run.start()
        toks = [(m.start(3) + base, m.end(3) + base, m[3], m[1], m[2], m.start(2) + base) for m in TOKEN.finditer(body)]
        n, i = len(toks), 0
        while i < n:
            s, e, w, _, part, ps = toks[i]
            initial = len(w) == 2 and w[1] == "."
            bare = w[:-1] if w[-1] == "." and not initial else w
            k = 0 if initial else kind(bare)
            if k == 1 or initial:
                j, end, given_at = i, s + len(w if initial else bare), i
                stop = not initial and bare is not w
                while not stop and j + 1 < n and toks[j + 1][3] == " " and not toks[j + 1][4]:
                    w2 = toks[j + 1][2]
                    init2 = len(w2) == 2 and w2[1] == "."
                    b2 = w2 if init2 else w2.rstrip(".")
                    if init2 or kind(b2) == 1:
                        j += 1
                        end = toks[j][0] + len(b2)
                        stop = not init2 and b2 is not w2 and w2[-1] == "."
                    else:
                        break
                surname = False
                if not stop and j + 1 < n and toks[j + 1][3] == " ":
                    w2 = toks[j + 1][2]
                    b2 = w2.rstrip(".")
                    k2 = kind(b2)
                    like = len(b2) > 3 and (b2.isupper() == bare.isupper()) and b2[1:].islower() == bare[1:].islower()
                    if k2 == 2 or (toks[j + 1][4] and len(b2) > 2) or (k2 == 0 and not initial and like and len(w2) != 2):
                        j += 1
                        end = toks[j][0] + len(b2)
                        surname = True
                if all(len(x[2]) == 2 and x[2][1] == "." for x in toks[i : j + (not surname)]) and not surname:
                    i += 1  # initials alone
                    continue
                if not surname and j == i and _noun(t, s, end):
                    i += 1
                    continue
                out.append((s, end, "person"))
                i = j + 1
                continue
            if k == 2 and bare is w:
                if i + 1 < n and toks[i + 1][3] == ", " and not toks[i + 1][4]:
                    w2 = toks[i + 1][2]
                    init2 = len(w2) == 2 and w2[1] == "."
                    b2 = w2 if init2 else w2.rstrip(".")
                    if init2 or kind(b2) == 1:
                        j = i + 1
                        end = toks[j][0] + len(b2)
                        while j + 1 < n and toks[j + 1][3] == " " and not toks[j + 1][4] and b2 is toks[j][2] and kind(toks[j + 1][2].rstrip(".")) == 1:
                            j += 1
                            b2 = toks[j][2].rstrip(".")
                            end = toks[j][0] + len(b2)
                        out.append((_particle(t, ps if part else s), end, "person"))
                        i = j + 1
                        continue
                if _word_before(t, s) in TITLES:
                    out.append((_particle(t, ps if part else s), e, "person"))
            elif k == 2:
                if _word_before(t, s) in TITLES:
                    out.append((_particle(t, ps if part else s), s + len(bare), "person"))
            i += 1
    for end, key in lower.iter(t):  # names in lower case: a given name with a surname on either side
        s = end - len(key) + 1
        if s and (t[s - 1].isalnum() or t[s - 1] in "@._-+"):
            continue
        m = LOWER_TAIL.match(t, s)
        if m:
            words = m.group().split(" ")
            last = 1
            while last < len(words) and (kind(words[last]) == 1 or words[last] in PARTICLES):
                last += 1
            if last < len(words) and kind(words[last]) == 2:
                out.append((s, s + len(" ".join(words[: last + 1])), "person"))
                continue
        g = s + len(key) - 1
        m = LOWER_HEAD.search(t, _words_back(t, s), s) if t[max(0, s - 2) : s] == ", " else None
        if m and kind(m.group(2)) == 2:
            out.append((m.start(), g, "person"))
    return out


def _word_before(t: str, s: int) -> str:
    """The word before a position in lower case; of words longer than any title only the end."""
    while s and t[s - 1].isspace():
        s -= 1
    b = s
    while b and not t[b - 1].isspace() and s - b <= LONGEST_TITLE:
        b -= 1
    return t[b:s].lower()


def _words_back(t: str, s: int) -> int:
    """Where a surname with its particle, a comma and a space begins at the earliest."""
    for _ in range(3):
        s = max(0, t.rfind(" ", 0, s))
    return s


def _noun(t: str, s: int, end: int) -> bool:
    """A given name that is also a noun: "Sten i vänster njure", "Maj månads kontroll"."""
    if t[end : end + 7] in (" månads", " mƣnads"):
        return True
    return t[end : end + 3] == " i " and t[end + 3 : end + 10].startswith(("vänster", "höger")) and t[:s].rstrip(" ")[-1:] in ("", ".", "\n", "\r", ":", "?", "!")


PARTICLES = frozenset("af von de van der la di du el al".split())
LOWER_TAIL = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*(?: [^\W\d_]+(?:-[^\W\d_]+)*){1,4}")
LOWER_HEAD = re.compile(r"(?<!\w)((?:af |von |de )?)([^\W\d_A-ZÅÄÖ]+(?:-[^\W\d_]+)*), $")
_BEFORE = re.compile(r"(?<!\w)(?:af|von|de|van|der|la|di) $")


def _particle(t: str, s: int) -> int:
    """Where the particles before a surname begin, however many."""
    while m := _BEFORE.search(t, max(0, s - len(" von ")), s):
        s = m.start()
    return s


class Detector:
    def __init__(self, names: Names):
        import ahocorasick

        self.names = names
        self.lower = ahocorasick.Automaton()
        for g in names.given:
            for end in " ,.":
                self.lower.add_word(g + end, g + end)
        if not names.given:
            self.lower.add_word("\0\0", "\0\0")
        self.lower.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Non-overlapping (start, end, kind) of the stored text, by position."""
        t, mapper = normal_form(text)
        taken: list[tuple[int, int, str]] = []
        for found in (_emails(t), _numbers(t), _streets(t), _persons(t, self.names, self.lower)):
            base = sorted(taken)
            starts = [x[0] for x in base]
            for x in sorted(found, key=lambda x: (x[0], -x[1])):
                i = bisect_right(starts, x[0])
                if (i and base[i - 1][1] > x[0]) or (i < len(base) and base[i][0] < x[1]):
                    continue
                if len(taken) > len(base) and taken[-1][1] > x[0]:
                    continue
                taken.append(x)
        taken.sort()
        if mapper.layers:
            return [(mapper.back(s, False), mapper.back(e, True), k) for s, e, k in taken]
        return taken


def _detect(texts: DataFrame, names: Names, schema: str, shape) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast((names.given, names.surnames))  # bounded by LABELLED_ROWS

    def make():
        detector = Detector(Names(*shared.value))

        def step(batch):
            return shape(detector, *(batch.column(i).to_pylist() for i in range(3)))

        return step

    return map_batches(texts.select("tbl", "row_id", "text"), make, schema)


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each span: tbl, row_id, start_pos, end_pos, kind."""

    def shape(detector, tbl, row, text):
        rows = [(t, r, *x) for t, r, s in zip(tbl, row, text) for x in detector.spans(s)]
        return {k: [x[i] for x in rows] for i, k in enumerate(("tbl", "row_id", "start_pos", "end_pos", "kind"))}

    schema = "tbl string, row_id long, start_pos long, end_pos long, kind string"
    return _detect(note_texts(spark, sf_dir), learn_names(spark, sf_dir), schema, shape)


def redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id, n_spans and the text with placeholders; everything outside the spans is unchanged."""

    def shape(detector, tbl, row, text):
        counts, out = [], []
        for s in text:
            spans = detector.spans(s)
            counts.append(len(spans))
            out.append(codecs.splice(s, [(a, b, PLACEHOLDERS[k]) for a, b, k in spans])[0])
        return {"tbl": tbl, "row_id": row, "n_spans": counts, "redacted": out}

    schema = "tbl string, row_id long, n_spans int, redacted string"
    return _detect(note_texts(spark, sf_dir), learn_names(spark, sf_dir), schema, shape)
