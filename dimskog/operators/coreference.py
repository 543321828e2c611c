"""Propagation: further mentions of what has been found, by exact phrase or by part of a name.

Each document is one row (its text and its findings), so the order of discovery is kept inside an Arrow
UDF; the only shuffle gathers a document's findings.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimskog.functions.scan import array_of, lists

# Titles that are no part of a name, and the length of the shortest part.
TITLES = frozenset(("dr", "dr.", "professor", "prof", "prof."))
SHORTEST = 3


def needles(text: str, label: str) -> list[str]:
    """The phrases to look for: the text itself and, for persons, its name parts without titles."""
    parts = (w.strip(".,") for w in text.split()) if label == "private_person" else ()
    return [text, *(p for p in parts if len(p) >= SHORTEST and p[0].isupper() and p.lower() not in TITLES)]


def mentions(text: str, entities: list[tuple[int, str, str, int, int]]) -> list[tuple[int, int, int]]:
    """(seq, start, end) of the new mentions in order of discovery; ``entities`` (seq, text, label, start, end) in list order.

    An occurrence counts as a whole word, case-sensitive, if it overlaps nothing covered so far.  Covered
    stretches are marks on the text, so each test costs the length of the phrase.
    """
    covered = bytearray(len(text))
    for _, _, _, s, e in entities:
        covered[s:e] = b"\1" * max(0, min(e, len(text)) - max(0, s))
    out, tried = [], set()
    for seq, phrase, label, _, _ in entities:
        for n in needles(phrase, label) if phrase else ():
            if n in tried or n not in text:
                continue
            tried.add(n)  # a phrase finds all its places the first time
            new = [(seq, *m.span()) for m in re.finditer(rf"\b{re.escape(n)}\b", text) if not any(covered[m.start() : m.end()])]
            for _, s, e in new:
                covered[s:e] = b"\1" * (e - s)
            out += new
    return out


_FOUND = {"seq": "bigint", "start": "int", "end": "int"}


@F.arrow_udf(array_of(_FOUND))
def _mentions(texts: pa.Array, entities: pa.Array) -> pa.Array:
    rows = []
    for t, es in zip(texts.to_pylist(), entities.to_pylist()):
        if t is None or es is None:
            rows.append(None)
            continue
        known = sorted((e["seq"], e["text"], e["label"], e["start"], e["end"]) for e in es)
        rows.append(mentions(t, known))
    return lists(rows, _FOUND)


def new_mentions(text: Column, entities: Column) -> Column:
    """``mentions`` as an array over an array of (seq, text, label, start, end); null text or entities give null."""
    one = lambda e: F.struct(e["seq"].alias("seq"), F.coalesce(e["text"], F.lit("")).alias("text"), F.coalesce(e["label"], F.lit("")).alias("label"), e["start"].alias("start"), e["end"].alias("end"))
    return F.when(text.isNotNull() & entities.isNotNull(), _mentions(text, F.transform(entities, one)))


def propagate(docs: DataFrame, entities: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, seq, start, end, text) of the new mentions, in order of discovery; seq is the entity cloned.

    Null or empty phrases find nothing; documents without text are left out.
    """
    one = F.struct("seq", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("label", F.lit("")).alias("label"), "start", "end")
    per_doc = entities.where("start is not null and end is not null and seq is not null").groupBy(*keys).agg(F.collect_list(one).alias("es_"))
    texts = docs.where("text is not null").select(*keys, F.col("text").alias("body_"))
    new = texts.join(per_doc, keys).select(*keys, "body_", F.posexplode(_mentions(F.col("body_"), F.col("es_"))).alias("n", "x_"))
    return new.select(
        *keys, F.col("n").cast("long").alias("n"), "x_.seq", F.col("x_.start").cast("long").alias("start"), F.col("x_.end").cast("long").alias("end"),
        F.expr("substring(body_, x_.start + 1, x_.end - x_.start)").alias("text"),
    )
