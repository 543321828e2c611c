"""Text functions as native expressions: regex spans with offsets, normal form, word classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,text:string>>"


def spans(text: Column, pattern: Column | str) -> Column:
    """All non-overlapping matches as (start, end, text), in code points, half-open.

    The gaps of ``split`` and the matches of ``regexp_extract_all`` alternate, so running lengths give
    the offsets.  Null text gives null; the pattern must not match the empty string.
    """
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, p, F.lit(0))
    gaps = F.slice(F.split(text, p, -1), F.lit(1), F.size(found))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("text"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.aggregate(F.arrays_zip(gaps.alias("g"), found.alias("m")), zero, step, lambda acc: acc["out"])


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def norm(text: Column) -> Column:
    """Case folded (with sharp s as ss), trimmed, white space collapsed; null as the empty string."""
    folded = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "ß", "ss")
    return F.regexp_replace(strip(folded), r"(?U)\s+", " ")


def present(needle: Column, haystack_norm: Column) -> Column:
    n = norm(needle)
    return (n != "") & F.contains(haystack_norm, n)


def overlaps(a: Column, b: Column) -> Column:
    """Whether one of two normal forms contains the other."""
    x, y = norm(a), norm(b)
    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x))
