"""Regex spans against Python's own engine, on awkward text."""

import re

import pytest
from pyspark.sql import functions as F

from dimskog.functions.text import norm, overlaps, present, spans
from dimskog.operators import rules
from dimskog.plans.pipeline import redact_by_rules

TEXTS = [
    "Ring 070-123 45 67 eller +46 8 123 45 67, mejla a.b+c@exempel.test. Född 19811212-3456, pass AB1234567.",
    "å15 mars 2024 och 15 mars 2024, 2024-03-15, 15/03/24; 123 45 Ort, ²123 45, ١٢٣ ٤٥",
    "", " ", "inga träffar här", "😀 a@b.se 😀 0701234567", "0701234567890123456789", "a@mail.exempel.test\r\n2024/01/02 12 maj 2020",
    "x" * 5000 + " 811212-3456 " + "9" * 300, None,
]


def test_spans_equal_python_matches(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = {(r.id, r.pattern_no, r.start, r.end, r.text) for r in rules.rule_spans(df, "id").collect()}
    want = {(i, n, m.start(), m.end(), m.group()) for i, t in enumerate(TEXTS) if t for n, (_, p) in enumerate(rules.PATTERNS) for m in re.finditer(p, t, re.I)}
    assert got == want


def test_redaction_keeps_everything_else(spark):
    df = spark.createDataFrame([("Ring 0701234567 i morgon, 811212-3456.",), ("Inget.",), (None,), ("",)], "text string")
    assert [r[0] for r in df.select(redact_by_rules(F.col("text"))).collect()] == ["Ring [TELEFON] i morgon, [ID-NUMMER].", "Inget.", None, ""]


def test_spans_of_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("ab",)], "t string")
    assert [r[0] for r in df.select(spans(F.col("t"), "[a-z]")).collect()] == [None, [], [(0, 1, "a"), (1, 2, "b")]]


@pytest.mark.parametrize("raw", ["  Straße \n\t9 ", " ÅÄÖ x ", None, ""])
def test_norm(spark, raw):
    want = re.sub(r"\s+", " ", (raw or "").strip().casefold())
    assert spark.createDataFrame([(raw,)], "t string").select(norm(F.col("t"))).first()[0] == want


def test_containment_of_normal_forms(spark):
    df = spark.createDataFrame([("Straße 9", "vid strasse  9 b"), ("", "x"), (None, "x"), ("x", None)], "a string, b string")
    assert [tuple(r) for r in df.select(present(F.col("a"), norm(F.col("b"))), overlaps(F.col("a"), F.col("b"))).collect()] == [(True, True), (False, False), (False, False), (False, False)]
