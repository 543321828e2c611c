"""Structured patterns: direct identifiers with an unambiguous form."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimskog.functions.scan import array_of, lists, scanner
from dimskog.operators.conflicts import ENTITY_FIELDS, standing
from dimskog.schema import CONFIDENCE

# Label and pattern, in the order of evaluation.
PATTERNS = (
    ("private_email", r"[\w.+-]+@[\w-]+\.[a-zA-Z]{2,}"),
    ("private_phone", r"(\+46|0046|0)[\s\-]?[0-9]{1,4}[\s\-]?[0-9]{3}[\s\-]?[0-9]{2}[\s\-]?[0-9]{2}"),
    ("private_phone", r"\b07[0-9][\s\-]?\d{3}[\s\-]?\d{2}[\s\-]?\d{2}\b"),
    ("account_number", r"\b(19|20)?\d{6}[\s\-]\d{4}\b"),
    ("account_number", r"\b[A-Z]{2}\d{7}\b"),
    ("private_date", r"\b\d{4}[-/]\d{2}[-/]\d{2}\b"),
    ("private_date", r"\b\d{1,2}\s+\w+\s+\d{4}\b"),
    ("private_date", r"\b\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\b"),
    ("private_address", r"\b\d{3}\s?\d{2}\b"),
)


_scan = scanner(PATTERNS, re.IGNORECASE)


@F.arrow_udf(array_of(ENTITY_FIELDS))
def accepted(texts: pa.Array) -> pa.Array:
    """Accepted rule entities of each text in priority order, in one pass; null text gives null."""
    compiled = [(label, re.compile(p, re.IGNORECASE)) for label, p in PATTERNS]
    out = []
    for t in texts.to_pylist():
        found = [(*m.span(), m.group(), label) for label, p in compiled for m in p.finditer(t)] if t else []
        kept = standing([{"seq": i, "text": x, "label": label, "start": s, "end": e, "source": "rule", "generalized": None} for i, (s, e, x, label) in enumerate(found)])
        out.append(None if t is None else [(i, x["text"], x["label"], x["start"], x["end"], "rule", CONFIDENCE["rule"], None, "high") for i, x in enumerate(kept)])
    return lists(out, ENTITY_FIELDS)


def rule_spans(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, pattern_no, label, start, end, text): one row a raw match."""
    each = docs.where(F.col(text).isNotNull()).select(key, F.explode(_scan(F.col(text))).alias("m_"))
    return each.select(key, F.col("m_.n").alias("pattern_no"), "m_.label", "m_.start", "m_.end", "m_.text")
