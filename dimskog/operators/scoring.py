"""Scores of runs against the gold key: per note, in total, as an ensemble, by seed and side by side.

Gold items meet a run's redacted text and its findings by containment.  The containment itself cannot
hash, but it always has the note as an equality.  The items of a note travel as one array, once for each
of SALTS parts of the other side, so a note that was run every night is split; findings are reduced to
distinct texts first, and containment is an expression over arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimskog.functions.text import norm

KEYS = ["run_label", "note"]
#: Parts that the runs or findings of one note are split into.
SALTS = 16


def _items(gold: DataFrame, *fields: str) -> DataFrame:
    """(note, salt, items): the gold items of a note as one array, once a salt."""
    one = gold.groupBy("note").agg(F.collect_list(F.struct(*fields)).alias("items"))
    return one.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salted(df: DataFrame, *by: str) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))


def item_outcomes(gold: DataFrame, redacted: DataFrame, findings: DataFrame) -> DataFrame:
    """One row a gold item and run: item_id, run_label, note, kind, hit (kept or removed as wished), detected.

    ``gold`` (item_id, note, item_group, text, pii_type), ``redacted`` (run_label, note, redacted),
    ``findings`` (run_label, note, original, label).  Only notes that a run has are scored.  Null or blank
    items count as absent from the text.
    """
    g = gold.select("item_id", "note", "item_group", "pii_type", norm(F.col("text")).alias("n"))
    r = redacted.select(*KEYS, norm(F.col("redacted")).alias("red"))
    f = findings.select(*KEYS, norm(F.col("original")).alias("o"), (F.coalesce(F.col("label"), F.lit("")) == "medication").alias("med")).where("o <> ''").groupBy(*KEYS).agg(
        F.collect_set("o").alias("all"), F.collect_set(F.when(F.col("med"), F.col("o"))).alias("meds")
    )
    met = _salted(r.join(f, KEYS, "left"), "run_label").join(_items(g, "item_id", "item_group", "pii_type", "n"), ["note", "salt"])
    j = met.select(*KEYS, "red", "all", "meds", F.explode("items").alias("i")).select(*KEYS, "red", "all", "meds", "i.*")
    kept = (F.col("n") != "") & F.contains("red", "n")
    near = lambda xs: F.coalesce(F.exists(xs, lambda o: F.contains(o, F.col("n")) | F.contains(F.col("n"), o)), F.lit(False)) & (F.col("n") != "")
    kind = F.when(F.col("item_group") == "should_redact", F.col("pii_type")).when(F.col("item_group") == "should_not_flag", "decoy").otherwise("med")
    detected = F.when(F.col("item_group") == "medications_flag_keep", near("meds")).otherwise(near("all"))
    base = j.select("item_id", *KEYS, kind.alias("kind"), kept.alias("kept"), detected.alias("detected"))
    hit = F.when(F.col("kind").isin("direct", "quasi"), ~F.col("kept")).when(F.col("kind") == "decoy", F.col("kept")).otherwise(F.col("kept") & F.col("detected"))
    return base.withColumn("hit", hit)


def per_note(outcomes: DataFrame) -> DataFrame:
    """run_label, note, kind, total, hits, detected; note TOTAL holds the sums of the run."""
    out = outcomes.groupBy("run_label", "kind", F.col("note")).agg(F.count("*").alias("total"), F.count_if("hit").alias("hits"), F.count_if("detected").alias("detected"))
    total = out.groupBy("run_label", "kind").agg(F.sum("total").alias("total"), F.sum("hits").alias("hits"), F.sum("detected").alias("detected")).withColumn("note", F.lit("TOTAL"))
    return out.unionByName(total)


def compare(outcomes: DataFrame) -> DataFrame:
    """One row a run: the rate of each kind in percent, null without items."""
    def rate(k: str):
        return F.round(F.try_divide(100.0 * F.count_if((F.col("kind") == k) & F.col("hit")), F.count_if(F.col("kind") == k)), 6)

    return outcomes.groupBy("run_label").agg(rate("direct").alias("direct"), rate("quasi").alias("quasi"), rate("decoy").alias("decoys"), rate("med").alias("meds"))


def seeds(outcomes: DataFrame) -> DataFrame:
    """Mean, least and most of each rate over the runs of a model (its label without seed)."""
    model = F.regexp_replace("run_label", "_s(eed)?[0-9]+$", "")
    c = compare(outcomes).na.fill(0.0).withColumn("model", model)
    aggs = [f(k).alias(f"{k}_{n}") for k in ("direct", "quasi", "decoys", "meds") for n, f in (("mean", lambda x: F.round(F.avg(x), 4)), ("min", F.min), ("max", F.max))]
    return c.groupBy("model").agg(F.count("*").alias("n"), *aggs)


def ensemble(outcomes: DataFrame, runs: list[str]) -> DataFrame:
    """kind, total, hits of the union of runs, over the notes that all of them have.

    An item is removed if any run removes it, a decoy kept if all keep it, a medication right if any flags
    and all keep it.
    """
    o = outcomes.where(F.col("run_label").isin(*runs))
    full = o.groupBy("note").agg(F.countDistinct("run_label").alias("r")).where(F.col("r") == len(runs)).select("note")
    by = o.join(full, "note", "left_semi").groupBy("item_id", "kind").agg(F.bool_or("hit").alias("any"), F.bool_and("kept").alias("all_kept"), F.bool_or("detected").alias("flagged"))
    hit = F.when(F.col("kind").isin("direct", "quasi"), F.col("any")).when(F.col("kind") == "decoy", F.col("all_kept")).otherwise(F.col("all_kept") & F.col("flagged"))
    return by.groupBy("kind").agg(F.count("*").alias("total"), F.count_if(hit).alias("hits"))


def misses(outcomes: DataFrame, gold: DataFrame) -> DataFrame:
    """(run_label, note, kind, items): the texts of the items a run missed on a note, sorted, each as often as it was missed."""
    missed = outcomes.where(~F.col("hit")).join(gold.select("item_id", F.coalesce("text", F.lit("")).alias("text")), "item_id")
    return missed.groupBy(*KEYS, "kind").agg(F.array_sort(F.collect_list("text")).alias("items"))


def detector_compare(gold: DataFrame, findings: DataFrame) -> DataFrame:
    """Per detector: direct items covered, decoys left alone, and findings."""
    g = gold.where("(item_group = 'should_redact' and pii_type = 'direct') or item_group = 'should_not_flag'").select("item_id", "note", "item_group", norm(F.col("text")).alias("n"))
    f = findings.select("source", "note", norm(F.col("original")).alias("o")).where("o <> ''").distinct()
    near = F.filter("items", lambda i: (i["n"] != "") & (F.contains(i["n"], F.col("o")) | F.contains(F.col("o"), i["n"])))
    met = _salted(f, "source", "o").join(_items(g, "item_id", "item_group", "n"), ["note", "salt"]).select("source", F.explode(near).alias("i"))
    met = met.select("source", "i.item_id", "i.item_group").distinct()
    sources = findings.groupBy("source").agg(F.count("*").alias("findings"))
    counts = met.groupBy("source").agg(F.count_if(F.col("item_group") == "should_redact").alias("covered"), F.count_if(F.col("item_group") == "should_not_flag").alias("flagged"))
    totals = g.agg(F.count_if(F.col("item_group") == "should_redact").alias("direct"), F.count_if(F.col("item_group") == "should_not_flag").alias("decoys"))
    j = sources.join(counts, "source", "left").crossJoin(totals)  # one row of totals
    return j.select("source", "findings", "direct", F.coalesce("covered", F.lit(0)).cast("long").alias("covered"), "decoys", (F.col("decoys") - F.coalesce("flagged", F.lit(0))).cast("long").alias("decoys_kept"))
