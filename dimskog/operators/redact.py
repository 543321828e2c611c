"""From spans to text: the replacement of each span and the rewritten document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimskog.functions.text import strip
from dimskog.schema import PLACEHOLDERS, VERBATIM, is_direct, placeholder_of

# The open band and the unit of an age range.
OLDEST, UNIT = "90 år eller äldre", "år"


def age_range(text: Column) -> Column:
    """The decade of the first number of one to three digits; the open band from 90; null for 0 or none."""
    age = F.regexp_extract(text, r"[0-9]{1,3}", 0).try_cast("int")
    low = (F.floor(age / 10) * 10).cast("int")
    return F.when(age >= 90, F.lit(OLDEST)).when(age > 0, F.concat(low.cast("string"), F.lit("-"), (low + 10).cast("string"), F.lit(f" {UNIT}")))


def not_a_generalization(text: Column, generalized: Column) -> Column:
    """Whether the original still stands in its generalization."""
    return F.contains(F.lower(strip(generalized)), F.lower(strip(text)))


def replacement(text: Column, label: Column, generalized: Column, no_generalize: bool = False) -> Column:
    """What is written in place of a span.

    Labels kept verbatim give the text itself; a trusted generalization of a known label that is not
    direct stands; an age gives its decade; everything else its placeholder.  Null text counts as empty,
    which every generalization contains, so it is never trusted.
    """
    t = F.coalesce(text, F.lit(""))
    known = F.coalesce(label.isin(*PLACEHOLDERS), F.lit(False))
    trusted = F.coalesce(generalized != "", F.lit(False)) & known & ~is_direct(label) & ~not_a_generalization(t, generalized)
    out = F.when(label.isin(*VERBATIM), t)
    if not no_generalize:
        out = out.when(trusted, generalized).when((label == "age") & age_range(t).isNotNull(), age_range(t))
    return out.otherwise(placeholder_of(label))


def splice(text: Column, spans: Column) -> Column:
    """The text with sorted, disjoint (start, end, replacement) spans rewritten; touching equal ones merge.

    A fold from the left, so no offset goes stale.  Null text stays null; no spans give the text back.
    """
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.lit(None).cast("string").alias("last"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        again = (s["start"] == acc["at"]) & acc["last"].eqNullSafe(s["replacement"])
        out = F.when(again, acc["out"]).otherwise(F.concat(acc["out"], gap, s["replacement"]))
        return F.struct(s["end"].alias("at"), out.alias("out"), s["replacement"].alias("last"))

    return F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def replacements(fragments: Column, no_generalize: bool = False) -> Column:
    """The (start, end, replacement) spans of an array of fragments, by position."""
    one = lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"), replacement(f["text"], f["label"], f["generalized"], no_generalize).alias("replacement"))
    return F.array_sort(F.transform(fragments, one))


def rewritten(text: Column, fragments: Column, no_generalize: bool = False) -> Column:
    """A text by its plan; without fragments it stays as it is."""
    return F.when(fragments.isNull(), text).otherwise(splice(text, replacements(fragments, no_generalize)))


def redacted(docs: DataFrame, fragments: DataFrame, keys: list[str], no_generalize: bool = False) -> DataFrame:
    """(keys, text, redacted) of documents (keys, text) by their plan; documents without fragments stay as they are."""
    spans = fragments.groupBy(*keys).agg(F.collect_list(F.struct("start", "end", "text", "label", "generalized")).alias("spans"))
    return docs.join(spans, keys, "left").select(*keys, "text", rewritten(F.col("text"), F.col("spans"), no_generalize).alias("redacted"))


def redact_all(docs: DataFrame, entities: DataFrame, keys: list[str], no_generalize: bool = False) -> DataFrame:
    """(keys, text, redacted) of documents and their entities: one shuffle of the entities, one join."""
    from dimskog.operators.conflicts import collected, fragments

    joined = docs.join(collected(entities.where("start < end"), keys), keys, "left")
    return joined.select(*keys, "text", rewritten(F.col("text"), fragments(F.col("entities")), no_generalize).alias("redacted"))


def audit(entities: DataFrame, keys: list[str], no_generalize: bool = False) -> DataFrame:
    """The audit rows of all entities (not of the plan), numbered by position and list order."""
    from pyspark.sql import Window as W

    position = F.row_number().over(W.partitionBy(*keys).orderBy("start", "seq")).cast("long")
    return entities.select(
        *keys, position.alias("position"), F.col("text").alias("original"), "label", F.col("start").cast("long").alias("start_pos"), F.col("end").cast("long").alias("end_pos"),
        "source", "risk", replacement(F.col("text"), F.col("label"), F.col("generalized"), no_generalize).alias("generalized_to"),
    )
