"""Text that looks the same but differs in its characters: one plain form for each.

Compiled longest-match transducer over grapheme clusters
---------------------------------------------------------
One pass cuts a text into grapheme clusters (a base character with its marks and joiners, taken as long
as they go, over invisible characters between them) and looks each up as a whole in a compiled table.
An entry holds the plain form - accents composed, full-width forms narrowed, every space the ordinary
one, invisible characters dropped - and, for a letter, its script and its look-alikes in other scripts.
Letters gather in a run; where the run ends, one that mixes scripts takes each letter's look-alike in
one script: the one into which all others have a look-alike, preferring the script of most letters, then
Latin.  Words wholly in another script stay.

``Transducer.compile`` checks every entry before it is used, those of the precomputed table and those
of clusters first met in the data alike: a form and each look-alike must be forms of themselves, so
applying the transducer twice changes nothing.

Defined results: null gives null; the empty string is plain; a text of invisible characters only
becomes empty; trailing ordinary spaces stay (they are plain), so matching trims them; a run with a
letter that looks like none of the other script's is never plain, and becomes as much Latin as it can.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import NamedTuple

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimskog.llm.corpus import map_batches
from dimskog.runtime import table

# Letters of other scripts that look like a Latin one.
_CYRILLIC = dict(zip("аеорсухіјѕһԁԛԝьАВЕКМНОРСТУХІЈЅԌԚԜЬ", "aeopcyxijshdqwbABEKMHOPCTYXIJSGQWb"))
_GREEK = dict(zip("οναρικυχγηωΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϳ", "ovapikuxynwABEZHIKMNOPTYXcj"))
_ARMENIAN = dict(zip("զհյոսցօԼՍՏՕ", "qhjnugoLUSO"))
_CHEROKEE = dict(zip("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏃᏏᏕᏙᏞᏟᏢᏦᏧᏴ", "DRTiYAJEWMHYGZbSVLCPKdB"))
_BASE = _CYRILLIC | _GREEK | _ARMENIAN | _CHEROKEE


def _lookalikes() -> dict[str, str]:
    """The base list and every composed letter whose base is in it (ӓ as ä)."""
    out = dict(_BASE)
    for lo, hi in ((0x370, 0x400), (0x400, 0x530)):
        for c in map(chr, range(lo, hi)):
            parts = unicodedata.normalize("NFD", c)
            if len(parts) > 1 and parts[0] in _BASE:
                latin = unicodedata.normalize("NFC", _BASE[parts[0]] + parts[1:])
                if len(latin) == 1:
                    out[c] = latin
    return out


LOOKALIKE = _lookalikes()

# Invisible characters that are not format or control characters.
_UNSEEN = frozenset("͏ᅟᅠㅤﾠ឴឵") | {chr(c) for c in range(0xFE00, 0xFE10)} | {chr(c) for c in range(0xE0100, 0xE01F0)}
# A cluster goes on over invisible characters to the marks, and a syllable to the vowels, that join it once those are gone.
_HIDDEN = r"[\p{Cf}\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0]"
_UNIT = regex.compile(rf"[\u1100-\u115e\ua960-\ua97c\uac00-\ud7a3](?:{_HIDDEN}*[\u1161-\u11ff\p{{M}}])+|\X(?:{_HIDDEN}+\p{{M}}+)*")
_LETTER, _NEUTRAL = regex.compile(r"[\p{L}\p{M}]"), regex.compile(r"[\p{Script=Common}\p{Script=Inherited}]")
#: Scripts that one language writes together count as one.
_TOGETHER = dict.fromkeys(("HIRAGANA", "KATAKANA", "HANGUL", "BOPOMOFO", "KATAKANA-HIRAGANA"), "CJK")


def _char(c: str) -> str:
    if c.isascii() and c.isprintable():
        return c
    kind = unicodedata.category(c)
    if kind in ("Zs", "Zl", "Zp") or c in "\t\n\r\v\f\x85":
        return " "
    if kind in ("Cf", "Cc") or c in _UNSEEN:
        return ""
    if 0xFF00 <= ord(c) <= 0xFFEF and unicodedata.east_asian_width(c) == "F":
        return unicodedata.normalize("NFKC", c)
    return c


def _form(cluster: str) -> str:
    return unicodedata.normalize("NFC", "".join(map(_char, unicodedata.normalize("NFC", cluster))))


@lru_cache(maxsize=10_000)
def script(c: str) -> str:
    """The script of a letter, by its Unicode name; '' for letters that go with any."""
    if _NEUTRAL.match(c):
        return ""
    name = unicodedata.name(c, "").split(" ")[0]
    return _TOGETHER.get(name, name)


class Entry(NamedTuple):
    """What a cluster becomes; ``script`` is None for all but letters, ``alike`` has its look-alike by script."""

    form: str
    script: str | None = None
    alike: dict[str, str] = {}


class Transducer:
    """A table of clusters and the pass that applies it; unknown clusters are compiled when first met."""

    #: Entries kept beyond the precomputed ones; more only cost their compilation again.
    KEPT = 500_000

    def __init__(self, clusters=()):
        self.back: dict[str, dict[str, str]] = {}
        for c, latin in LOOKALIKE.items():
            self.back.setdefault(script(c), {}).setdefault(latin, c)
        self.table: dict[str, Entry] = {}
        for c in clusters:
            if self.compile(c) is None:
                raise ValueError(f"conflicting forms of {c!r}")

    def entry(self, cluster: str) -> Entry:
        form = _form(cluster)
        if not form or not _LETTER.match(form):
            return Entry(form)
        own = script(form[0])
        base, marks = unicodedata.normalize("NFD", form)[0], unicodedata.normalize("NFD", form)[1:]
        alike = {}
        for other, swap in ({"LATIN": LOOKALIKE} if own != "LATIN" else self.back).items():
            whole = swap.get(form)
            if whole is None and base in swap:
                whole = unicodedata.normalize("NFC", swap[base] + marks)
            if whole is not None and other != own:
                alike[other] = whole
        return Entry(form, own, alike)

    def compile(self, cluster: str) -> Entry | None:
        """The checked entry of a cluster; None if its form or a look-alike would change again."""
        made = self.entry(cluster)
        for form in (made.form, *made.alike.values()):
            if "".join(self.entry(x).form for x in _UNIT.findall(form)) != form:
                return None
        if any(script(x[0]) != other for other, x in made.alike.items()):
            return None
        if len(self.table) < self.KEPT:
            self.table[cluster] = made
        return made

    def __call__(self, text: str) -> tuple[str, bool]:
        """(plain form, whether every run of its letters has one script)."""
        out: list[str] = []
        run: list[Entry] = []
        pure = True
        for cluster in _UNIT.findall(text):
            e = self.table.get(cluster) or self.compile(cluster) or Entry(cluster)
            if e.script is not None:
                run.append(e)
            elif e.form:
                if run:
                    pure &= self._close(run, out)
                    run = []
                out.append(e.form)
        if run:
            pure &= self._close(run, out)
        return "".join(out), pure

    @staticmethod
    def _close(run: list[Entry], out: list[str]) -> bool:
        """Writes a run of letters in one script if there is one; whether there is."""
        count: dict[str, int] = {}
        for e in run:
            if e.script:
                count[e.script] = count.get(e.script, 0) + 1
        if len(count) < 2:
            out.extend(e.form for e in run)
            return True
        for target in sorted(count, key=lambda s: (-count[s], s != "LATIN")):
            if all(e.script in (target, "") or target in e.alike for e in run):
                out.extend(e.form if e.script in (target, "") else e.alike[target] for e in run)
                return True
        out.extend(e.alike.get("LATIN", e.form) for e in run)
        return False


#: Precomputed and checked: ASCII, full-width forms, spaces, decomposed letters, and every look-alike with its letter.
TRANSDUCER = Transducer(
    [chr(c) for c in range(0x20, 0x7F)]
    + [chr(c) for c in range(0xFF01, 0xFF5F)]
    + [f(chr(c)) for c in range(0xC0, 0x250) for f in (str, lambda c: unicodedata.normalize("NFD", c))]
    + [f(c) for pair in LOOKALIKE.items() for c in pair for f in (str, lambda c: unicodedata.normalize("NFD", c))]
    + ["\xa0", "\u2009", "\u202f", "\u3000"]
)


def plain(text: str) -> str:
    """The plain form of a text."""
    return text if text.isascii() and text.isprintable() else TRANSDUCER(text)[0]


def is_plain(text: str) -> bool:
    """Whether a text is in plain form already (mixed runs that no look-alike resolves are not plain)."""
    return text.isascii() and text.isprintable() or TRANSDUCER(text) == (text, True)


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = table(spark, sf_dir, "audit").select(F.lit("audit").alias("tbl"), F.col("audit_id").alias("row_id"), "note", F.col("original").alias("value"))
    key = (
        table(spark, sf_dir, "synthetic_notes_key")
        .where("item_group = 'should_redact'")
        .select(F.lit("synthetic_notes_key").alias("tbl"), F.col("item_id").alias("row_id"), "note", F.col("text").alias("value"))
    )
    return audit.unionByName(key)


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id of the values that are not in plain form."""

    def make():
        def step(batch):
            rows = [(t, r) for t, r, v in zip(*(batch.column(i).to_pylist() for i in range(3))) if not is_plain(v)]
            return {"tbl": [t for t, _ in rows], "row_id": [r for _, r in rows]}

        return step

    odd = _values(spark, sf_dir).where(F.col("value").rlike(r"[^\x20-\x7e]")).select("tbl", "row_id", "value")
    return map_batches(odd, make, "tbl string, row_id long")


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id, note, value and its plain form for every value."""

    def make():
        def step(batch):
            tbl, row, note, value = (batch.column(i).to_pylist() for i in range(4))
            return {"tbl": tbl, "row_id": row, "note": note, "value": value, "plain": [None if v is None else plain(v) for v in value]}

        return step

    return map_batches(_values(spark, sf_dir), make, "tbl string, row_id long, note string, value string, plain string")


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold items with the number of findings on their note that have the same plain form (trimmed, case folded).

    Pre-aggregated on both sides before the join, so a note that was run every night is one row a form.
    """
    forms = canonical(spark, sf_dir).select("tbl", "row_id", "note", F.lower(F.trim("plain")).alias("form"), F.lower(F.trim("value")).alias("raw"))
    audit = forms.where("tbl = 'audit' and form is not null").groupBy("note", "form").agg(F.count("*").alias("findings"))
    asis = forms.where("tbl = 'audit' and raw is not null").groupBy("note", "raw").agg(F.count("*").alias("findings_as_is"))
    gold = forms.where("tbl = 'synthetic_notes_key'").select(F.col("row_id").alias("item_id"), "note", "form", "raw")
    return (
        gold.join(audit, ["note", "form"], "left")
        .join(asis, ["note", "raw"], "left")
        .select("item_id", "note", "form", F.coalesce("findings", F.lit(0)).alias("findings"), F.coalesce("findings_as_is", F.lit(0)).alias("findings_as_is"))
    )
