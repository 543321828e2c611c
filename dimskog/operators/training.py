"""Training data and its metrics: tuning rows, deterministic splits, label counts and F scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimskog.functions.text import strip

# Labels whose tuning rows are of high risk.
HIGH_RISK = ("private_person", "private_email", "private_phone", "account_number", "private_address", "private_date", "secret")


def tuning_rows(docs: DataFrame, entities: DataFrame, keys: list[str], system_prompt: str) -> DataFrame:
    """(keys, system_prompt, user_input, assistant_output): findings with text and label as JSON, in order."""
    text = strip(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" ")))
    risk = F.when(F.col("label").isin(*HIGH_RISK), "high").otherwise("medium")
    one = F.struct("seq", F.struct(text.alias("text"), "label", risk.alias("risk"), F.nullif("generalized", F.lit("")).alias("generalized")).alias("x"))
    rows = entities.where(text != "").where("label is not null").groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(one)), lambda s: s["x"]).alias("found"))
    out = docs.join(rows, keys, "left")
    return out.select(*keys, F.lit(system_prompt).alias("system_prompt"), F.col("text").alias("user_input"), F.coalesce(F.to_json("found"), F.lit("[]")).alias("assistant_output"))


def split_part(key: Column, seed: int, ratio: float) -> Column:
    """train or validation by the hash of a key: stable, without a global order, so it needs no shuffle."""
    bucket = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("bigint")
    return F.when(bucket < int(ratio * 2**32), "train").otherwise("validation")


def exact_split(rows: DataFrame, key: str, seed: int, ratio: float) -> DataFrame:
    """(key, part) with exactly floor(n * ratio) training rows: hash order by distributed ranges.

    Hash buckets are counted first; only the bucket in which the border falls is ranked by a window.
    """
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    b = rows.select(key, h.alias("h"), F.substring(h, 1, 4).alias("bucket"))
    sums = b.groupBy("bucket").count()  # at most 65,536 rows
    before = F.coalesce(F.sum("count").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("bucket", before.alias("before"), F.sum("count").over(W.partitionBy(F.lit(1))).alias("n"))
    ranked = b.join(sums, "bucket").withColumn("rank", F.col("before") + F.row_number().over(W.partitionBy("bucket").orderBy("h", key)))
    return ranked.select(key, F.when(F.col("rank") <= F.floor(F.col("n") * ratio), "train").otherwise("validation").alias("part"))


def label_counts(rows: DataFrame, table: dict[str, str]) -> DataFrame:
    """(label, n, category) of the masks; category null for labels that are dropped."""
    from dimskog.operators.tagging import mapped

    m = rows.where("privacy_mask is not null").select(F.explode("privacy_mask").alias("m")).groupBy(F.col("m.label").alias("label")).agg(F.count("*").alias("n"))
    return m.withColumn("category", mapped(F.col("label"), table))


def require_labels(counts: DataFrame) -> DataFrame:
    """Label counts unless nothing is left to train on: no label that has a category."""
    if counts.where("category is not null").isEmpty():
        raise ValueError("no label of the rows has a category")
    return counts


def export_rows(tasks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, source_text, privacy_mask) of review tasks: the spans of the first result that has any, annotations before predictions.

    Cancelled annotations count like others here; tasks without text are left out, without spans they have an empty mask.
    """
    results = F.concat(*[F.coalesce(F.transform(f"task.{layer}", lambda x: x["result"]), F.array()) for layer in ("annotations", "predictions")])
    spans = lambda r: F.filter(r, lambda i: (F.coalesce(F.size(i["value"]["labels"]), F.lit(0)) > 0) & i["value"]["start"].isNotNull() & i["value"]["end"].isNotNull())
    first = F.get(F.filter(F.transform(results, lambda r: spans(F.coalesce(r, F.array()))), lambda r: F.size(r) > 0), F.lit(0))
    one = lambda i: F.struct(i["value"]["start"].alias("start_pos"), i["value"]["end"].alias("end_pos"), F.get(i["value"]["labels"], F.lit(0)).alias("label"))
    mask = F.coalesce(F.transform(first, one), F.array().cast("array<struct<start_pos:int,end_pos:int,label:string>>"))
    return tasks.where("task.data.text is not null").select(*keys, F.col("task.data.text").alias("source_text"), mask.alias("privacy_mask"))


def export_tuning(tasks: DataFrame, keys: list[str], system_prompt: str) -> DataFrame:
    """Tuning rows (as ``tuning_rows``) of review tasks by their chosen layer."""
    from dimskog.operators import review

    texts = tasks.where("task.data.text is not null").select(*keys, F.col("task.data.text").alias("text"))
    found = review.decoded(tasks.select(*keys, review.chosen(F.col("task")).alias("result")), keys)
    return tuning_rows(texts, found, keys, system_prompt)


def report(by_label: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, f2, support): the rows of ``f_scores`` by label with their micro, macro and weighted means."""
    own = by_label.select("label", "precision", "recall", "f1", "f2", F.col("gold").alias("support"))
    mean = lambda name, w: own.groupBy().agg(*[F.round(F.coalesce(F.try_divide(F.sum(F.col(c) * w), F.sum(w)), F.lit(0.0)), 9).alias(c) for c in ("precision", "recall", "f1", "f2")], F.coalesce(F.sum("support"), F.lit(0)).alias("support")).select(F.lit(name).alias("label"), "precision", "recall", "f1", "f2", "support")
    c = by_label.groupBy().agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("gold", "predicted", "correct")])
    micro = _rated(c).select(F.lit("micro").alias("label"), "precision", "recall", "f1", "f2", F.col("gold").alias("support"))
    return own.unionByName(micro).unionByName(mean("macro", F.lit(1.0))).unionByName(mean("weighted", F.col("support").cast("double")))


def _rated(c: DataFrame) -> DataFrame:
    """Precision, recall, F1 and F2 of counts gold, predicted and correct; 0 where undefined."""
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    c = c.withColumn("precision", zero(F.try_divide(F.col("correct").cast("double"), F.col("predicted")))).withColumn("recall", zero(F.try_divide(F.col("correct").cast("double"), F.col("gold"))))
    pr = F.col("precision") * F.col("recall")
    f1, f2 = F.try_divide(2 * pr, F.col("precision") + F.col("recall")), F.try_divide(5 * pr, 4 * F.col("precision") + F.col("recall"))
    return c.withColumns({"f1": F.round(zero(f1), 9), "f2": F.round(zero(f2), 9), "precision": F.round("precision", 9), "recall": F.round("recall", 9)})


def f_scores(gold: DataFrame, predicted: DataFrame, keys: list[str], by_label: bool = False) -> DataFrame:
    """Entity-level precision, recall, F1 and F2 by exact (document, start, end, label); 0 where undefined."""
    same = [*keys, "start", "end", "label"]
    g = gold.select(*same).distinct().withColumn("g", F.lit(1))
    p = predicted.select(*same).distinct().withColumn("p", F.lit(1))
    both = g.join(p, same, "full")
    grouped = both.groupBy("label") if by_label else both.groupBy()
    c = grouped.agg(F.count("g").alias("gold"), F.count("p").alias("predicted"), F.count(F.when(F.col("g").isNotNull() & F.col("p").isNotNull(), 1)).alias("correct"))
    return _rated(c)
