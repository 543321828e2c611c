"""Reading level of each document, in any of its languages.

Sentence lengths, word lengths and syllables (words hyphenated by rules of each language) feed six
classic formulas - Flesch-Kincaid, Gunning fog, SMOG, automated readability, Coleman-Liau and the
Anderson grade of Bjoernsson's long-word rate.  The median of these grades is the estimate; a formula
that a layout misleads (a list without full stops, a text in capitals) is outvoted.  The language comes
from function words, not from the ``lang`` column, which may be wrong.

A level on the graders' scale is read off a line fitted to the median grade of at most ``LABELLED``
graded documents of a language (of all languages where it has under ``FEW``).

Defined results: null, empty and blank texts and texts without words have null measures; repeated
texts get equal measures under each id; long texts are measured whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from statistics import median

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimskog.llm.corpus import map_batches
from dimskog.runtime import table

#: At most so many graded documents fit the lines; below FEW a language uses the common one.
LABELLED, FEW = 5_000, 20

# Frequent function words of each language.
FUNCTION_WORDS = {
    "sv": "och att det som är för inte på med till av den har du en ett om vid kan när så från eller din ditt han hon hen sedan utan under efter vi jag sig mot även",
    "en": "the and of to in is that for it with as was on are be this you your at or not have from when they which can if a an we he she his her after",
    "no": "og ikke jeg som er av på å det til med har ble fra etter hos eller når du kan deg meg hun han dette også nå noe dere uten hvis ut før vært bli blir",
    "fi": "ja on ei se että hän oli sen kun tai mutta myös ovat jos niin kuin sinä sinun voi ole joka mitä olla ennen jälkeen saa sitten hyvin tämä ole minun",
}
_WORDS_OF = {lang: frozenset(w.split()) for lang, w in FUNCTION_WORDS.items()}
# Long words a sentence at which a grade begins (Anderson 1983).
LONG_WORD_GRADES = (0.2, 0.5, 0.8, 1.3, 1.8, 2.4, 3.0, 3.7, 4.5, 5.3, 6.2, 7.2)

WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
LETTER = re.compile(r"[^\W\d_]")
STOPS = re.compile(r"[.!?…]")
STOP = re.compile(r"[.!?…]+[\"”’)\]]*(?=\s|$)")
ABBREVIATION = re.compile(r"\b(?:t\.ex|bl\.a|d\.v\.s|m\.m|o\.s\.v|ca|kl|dr|prof|mr|mrs|e\.g|i\.e|nr|tel|jfr|f\.ö|s\.k)\.$", re.I)

#: Vowels that are one nucleus; a run of vowels is cut into as many as the language speaks.
_NUCLEUS = {
    "sv": re.compile(r"[ae]u(?=[a-zåäö])|(?<=[st])io(?=n)|(?<!q)u|[aeioyåäöéüà]"),
    "no": re.compile(r"ei|øy|au|ai|oi|[aeiouyæøåéü]"),
    "fi": re.compile(r"aa|ee|ii|oo|uu|yy|ää|öö|ai|ei|oi|ui|yi|äi|öi|au|eu|iu|ou|ey|iy|äy|öy|ie|uo|yö|[aeiouyäöå]"),
    "en": re.compile(r"(?:(?!ia|io(?!u|n)|eo|iu|uo|ua(?!r)|ying)[aeiouy])*[aeiouy]"),
}
_EN_SILENT = re.compile(r"(?:[^aeiouyl]e|[^aeiouy]le(?<!.[^aeiouy]le)|[^aeioudt]ed|[^aeiouscxz]es)$")
#: Consonants that may begin a syllable together; Finnish syllables begin with one.
_ONSET = re.compile(r"(?:s?(?:[ptk][rlvj]?|ch|[mnlv])|[bdfgv][rlj]?|[tpswgc]h|sj|ck|[^\W\d_])$")

#: Words of a language whose measures are kept a process; a fuller memory only saves work.
_KEPT = 200_000
_KNOWN: dict[str, dict[str, tuple]] = {lang: {} for lang in _WORDS_OF}


def hyphenated(word: str, lang: str) -> list[str]:
    """The syllables of a word in lower case: one a nucleus, consonants between two going to the later as far as they can begin it."""
    nuclei = [m.span() for m in _NUCLEUS[lang].finditer(word)]
    if lang == "en" and len(nuclei) > 1 and _EN_SILENT.search(word):
        nuclei.pop()
    cuts = [0]
    for (_, a), (b, _) in zip(nuclei, nuclei[1:]):
        cluster = word[a:b]
        onset = (cluster[-1:] if lang == "fi" else m.group() if (m := _ONSET.search(cluster)) else "")
        cuts.append(b - len(onset))
    return [word[a:b] for a, b in zip(cuts, [*cuts[1:], len(word)])]


def syllables(word: str, lang: str) -> int:
    return len(hyphenated(word.lower(), lang))


def language(words: dict[str, int]) -> str:
    """The language with most function words of counted words; ties and none go to Swedish, then in listed order."""
    return max(_WORDS_OF, key=lambda lang: (sum(map(words.get, _WORDS_OF[lang] & words.keys())), lang == "sv"))


def count_sentences(text: str) -> int:
    """Stretches with a letter between full stops and line ends; an abbreviation's stop ends none."""
    n = 0
    for line in text.split("\n"):
        at = 0
        if STOPS.search(line):
            for m in STOP.finditer(line):
                end = m.end()
                if line[end - 1] == "." and ABBREVIATION.search(line, max(0, end - 12), end):
                    continue
                n += LETTER.search(line, at, end) is not None
                at = end
        n += LETTER.search(line, at) is not None
    return n


def _measured_word(word: str, lang: str) -> tuple[int, int, bool, bool]:
    """(syllables, letters, long, of many syllables); an unbroken run of letters is one long word, not a measure of its own."""
    n = syllables(word[:200], lang)
    out = min(n, 12), min(len(word), 30), len(word) > 6, n > 2
    if len(_KNOWN[lang]) < _KEPT:
        _KNOWN[lang][word] = out
    return out


def measures(text: str | None) -> tuple | None:
    """(language, sentences, words, lix, flesch, fk, fog, smog, ari, coleman_liau, rix_grade, grade)."""
    words = Counter(WORD.findall(text.lower())) if text else {}
    if not words:
        return None
    lang = language(words)
    known = _KNOWN[lang]
    w, s = words.total(), max(1, count_sentences(text))
    syl = long = many = letters = 0
    for x, k in words.items():
        a, b, c, d = known.get(x) or _measured_word(x, lang)
        syl += a * k
        letters += b * k
        long += c * k
        many += d * k
    fk = 0.39 * w / s + 11.8 * syl / w - 15.59
    fog = 0.4 * (w / s + 100 * many / w)
    smog = 1.043 * math.sqrt(many * 30 / s) + 3.1291
    ari = 4.71 * letters / w + 0.5 * w / s - 21.43
    cli = 5.88 * letters / w - 29.6 * s / w - 15.8
    rix = float(sum(long / s >= edge for edge in LONG_WORD_GRADES))
    grade = min(30.0, max(-3.0, median((fk, fog, smog, ari, cli, rix))))
    return (lang, s, w, w / s + 100 * long / w, 206.835 - 1.015 * w / s - 84.6 * syl / w, fk, fog, smog, ari, cli, rix, grade)


NAMES = ("language", "n_sentences", "n_words", "lix", "flesch", "fk", "fog", "smog", "ari", "coleman_liau", "rix_grade", "grade")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and all measures of (doc_id, text)."""

    def make():
        def step(batch):
            rows = [measures(t) or (None,) * len(NAMES) for t in batch.column(1).to_pylist()]
            return {"doc_id": batch.column(0)} | {k: [r[i] for r in rows] for i, k in enumerate(NAMES)}

        return step

    numbers = ", ".join(f"{k} double" for k in NAMES[3:])
    return map_batches(docs.select("doc_id", "text"), make, f"doc_id long, language string, n_sentences int, n_words int, {numbers}")


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, reading_level): the median of the distinct grades of distinct graders."""
    labels = table(spark, sf_dir, "reading_labels").where("reading_level is not null").select("doc_id", "grader", "reading_level").distinct()
    return labels.groupBy("doc_id").agg(F.median("reading_level").alias("reading_level"))


def fit(rows: list[tuple[str, float, float]]) -> dict[str | None, tuple[float, float]]:
    """language -> (slope, offset) of level on grade; None for all languages."""
    out = {}
    for lang in (None, *_WORDS_OF):
        own = [(g, y) for k, g, y in rows if lang is None or k == lang]
        if len(own) >= (2 if lang is None else FEW):
            x, y = np.array(own).T
            slope = np.cov(x, y)[0, 1] / max(1e-9, x.var(ddof=1)) if len(own) > 1 else 0.0
            out[lang] = (float(slope), float(y.mean() - slope * x.mean()))
    out.setdefault(None, (0.25, 0.5))
    return out


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, all measures and ``level`` from 1 (easiest) to 5."""
    docs = table(spark, sf_dir, "documents")
    sample = docs.join(_graded(spark, sf_dir).orderBy(F.xxhash64("doc_id")).limit(LABELLED), "doc_id")
    levels_of = sample.select("doc_id", "reading_level")
    known = measured(sample.select("doc_id", "text")).join(levels_of, "doc_id").where("grade is not null")
    lines = fit([(r.language, r.grade, r.reading_level) for r in known.select("language", "grade", "reading_level").collect()])  # bounded by LABELLED
    slope, offset = F.lit(lines[None][0]), F.lit(lines[None][1])
    for lang, (a, b) in lines.items():
        if lang:
            slope = F.when(F.col("language") == lang, a).otherwise(slope)
            offset = F.when(F.col("language") == lang, b).otherwise(offset)
    level = F.greatest(F.lit(1.0), F.least(F.lit(5.0), F.col("grade") * slope + offset))
    return measured(docs).withColumn("level", F.when(F.col("grade").isNotNull(), level))


def agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: graded documents, correlation of grade and of level with the grades, mean error."""
    rows = levels(spark, sf_dir).join(_graded(spark, sf_dir), "doc_id").where("grade is not null")
    return rows.groupBy("language").agg(
        F.count("*").alias("documents"),
        F.corr("grade", "reading_level").alias("corr_grade"),
        F.corr("level", "reading_level").alias("corr_level"),
        F.avg(F.abs(F.col("level") - F.col("reading_level"))).alias("mean_error"),
    )
