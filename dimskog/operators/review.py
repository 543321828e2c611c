"""The human-review round trip: tasks out, regions back, clusters of overlapping spans rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimskog.functions.text import strip
from dimskog.operators.redact import replacement
from dimskog.schema import PLACEHOLDERS, SOURCES, VERBATIM, is_direct, placeholder_of

# Label and risk colours of the labeling page.
PALETTE = (
    "#e6194b", "#3cb44b", "#ffe119", "#4363d8", "#f58231", "#911eb4", "#46f0f0", "#f032e6", "#bcf60c",
    "#fabebe", "#008080", "#e6beff", "#9a6324", "#fffac8", "#800000", "#aaffc3", "#808000", "#000075",
)
RISK_COLORS = {"high": "#e74c3c", "medium": "#f39c12", "low": "#2ecc71"}
ITEM = "struct<id:string,from_name:string,to_name:string,type:string,value:struct<start:int,end:int,text:string,labels:array<string>,choices:array<string>>,meta:struct<text:array<string>>>"


def labeling_page() -> str:
    """The labeling interface, generated from the taxonomy."""
    def tag(name: str, value: str, color: str | None = None) -> str:
        return f'    <{name} value="{value}"' + (f' background="{color}"' if color else "") + "/>"

    labels = [tag("Label", x, PALETTE[i % len(PALETTE)]) for i, x in enumerate(sorted({*PLACEHOLDERS, *VERBATIM}))]
    facets = {"risk": [tag("Choice", r, c) for r, c in RISK_COLORS.items()], "source": [tag("Choice", s) for s in SOURCES]}
    out = ["<View>", '  <Text name="text" value="$text"/>', '  <Labels name="label" toName="text">', *labels, "  </Labels>"]
    for name, tags in facets.items():
        out += [f'  <Choices name="{name}" toName="text" perRegion="true" required="false" showInline="true">', *tags, "  </Choices>"]
    return "\n".join([*out, "</View>", ""])


def regions(entities: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, region, item, id, from_name, type, start, end, text, value, meta): two or three items an entity.

    Regions are numbered by position; the source item only for known sources.
    """
    n = F.row_number().over(W.partitionBy(*keys).orderBy("start", "seq")) - 1
    meta = F.array_compact(F.array(
        F.concat(F.lit("source: "), "source"), F.concat(F.lit("confidence: "), F.format_string("%.2f", F.col("confidence"))),
        F.when(F.coalesce("generalized", F.lit("")) != "", F.concat(F.lit("generalized: "), "generalized")),
    ))
    items = F.array_compact(F.array(
        F.struct(F.lit("label").alias("from_name"), F.lit("labels").alias("type"), F.col("label").alias("value"), F.array_join(meta, "|").alias("meta")),
        F.struct(F.lit("risk").alias("from_name"), F.lit("choices").alias("type"), F.col("risk").alias("value"), F.lit(None).cast("string").alias("meta")),
        F.when(F.col("source").isin(*SOURCES), F.struct(F.lit("source").alias("from_name"), F.lit("choices").alias("type"), F.col("source").alias("value"), F.lit(None).cast("string").alias("meta"))),
    ))
    numbered = entities.withColumn("region", n.cast("long"))
    each = numbered.select(*keys, "region", "start", "end", "text", F.posexplode(items).alias("item", "x"))
    return each.select(
        *keys, "region", F.col("item").cast("long").alias("item"), F.concat(F.lit("ent_"), F.col("region").cast("string")).alias("id"),
        "x.from_name", "x.type", F.col("start").cast("long").alias("start_pos"), F.col("end").cast("long").alias("end_pos"), "text", "x.value", "x.meta",
    )


def tasks(docs: DataFrame, items: DataFrame, keys: list[str], data: list[str] = []) -> DataFrame:
    """One JSON task a document (keys, task): its text with further ``data`` columns, and a single prediction with all items in order."""
    value = F.struct(
        F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "text",
        F.when(F.col("type") == "labels", F.array("value")).alias("labels"), F.when(F.col("type") == "choices", F.array("value")).alias("choices"),
    )
    meta = F.when(F.col("meta").isNotNull(), F.struct(F.split("meta", r"\|").alias("text")))
    one = F.struct("region", "item", F.struct("id", "from_name", F.lit("text").alias("to_name"), "type", value.alias("value"), meta.alias("meta")).alias("r"))
    result = items.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["r"]).alias("result"))
    joined = docs.join(result, keys, "left")
    task = F.struct(F.struct("text", *data).alias("data"), F.array(F.struct(F.lit("dimskog").alias("model_version"), F.coalesce("result", F.array()).alias("result"))).alias("predictions"))
    return joined.select(*keys, F.to_json(task).alias("task"))


TASK = f"data STRUCT<text: STRING, output_file: STRING>, predictions ARRAY<STRUCT<result: ARRAY<{ITEM}>>>, annotations ARRAY<STRUCT<was_cancelled: BOOLEAN, result: ARRAY<{ITEM}>>>"


def chosen(task: Column, layer: str = "auto") -> Column:
    """The result list of a task: the first annotation that is not cancelled and has a result (an empty one
    counts), else the first prediction; ``layer`` may restrict to either."""
    annotated = F.get(F.filter(task["annotations"], lambda a: ~F.coalesce(a["was_cancelled"], F.lit(False)) & a["result"].isNotNull()), F.lit(0))["result"]
    predicted = F.get(task["predictions"], F.lit(0))["result"]
    none = F.array().cast(f"array<{ITEM}>")
    return {"auto": F.coalesce(annotated, predicted, none), "annotations": F.coalesce(annotated, none), "predictions": F.coalesce(predicted, none)}[layer]


def decoded(results: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, seq, text, label, start, end, source, generalized, risk) of (keys, result).

    Items of one id form a region; the last item of each facet counts; regions without a label are left
    out; risk defaults to low and source to manual; order is first appearance.
    """
    each = results.select(*keys, F.posexplode("result").alias("pos", "i"))
    facet = each.groupBy(*keys, F.col("i.id").alias("region_")).agg(
        F.min("pos").alias("first"),
        *[F.max_by("i", F.when(F.col("i.from_name") == f, F.col("pos"))).alias(f) for f in ("label", "risk", "source")],
    )
    line = F.get(F.filter("label.meta.text", lambda t: t.startswith("generalized:")), F.lit(0))
    generalized = F.nullif(strip(F.expr("substring(g_line, 13)")), F.lit(""))
    has = {f: F.col(f"{f}.from_name") == f for f in ("label", "risk", "source")}
    ok = facet.where(has["label"] & (F.size("label.value.labels") > 0)).withColumn("g_line", line)
    return ok.select(
        *keys, F.col("first").cast("long").alias("seq"), F.coalesce("label.value.text", F.lit("")).alias("text"), F.get("label.value.labels", F.lit(0)).alias("label"),
        F.col("label.value.start").alias("start"), F.col("label.value.end").alias("end"),
        F.coalesce(F.when(has["source"], F.get("source.value.choices", F.lit(0))), F.lit("manual")).alias("source"), generalized.alias("generalized"),
        F.coalesce(F.when(has["risk"], F.get("risk.value.choices", F.lit(0))), F.lit("low")).alias("risk"),
    )


def clusters(entities: DataFrame, keys: list[str], no_generalize: bool = False) -> DataFrame:
    """(keys, start, end, members, replacement): one replacement for each run of overlapping spans.

    Touching spans do not overlap; blank or empty spans are left out.  The longest span rules, a direct one
    on ties, medication only alone.  Its generalization stands only if it spans the whole run, is no
    placeholder and repeats no other member's text (also without a genitive s).
    """
    e = entities.where("end > start").where(strip(F.col("text")) != "")
    by = W.partitionBy(*keys).orderBy("start", F.col("start") - F.col("end"), "seq")
    reach = F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1))
    e = e.withColumn("island", F.sum(F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1))).over(by.rowsBetween(W.unboundedPreceding, 0)))
    member = F.struct("seq", "start", "end", "text", "label", "generalized")
    order = F.struct((~F.coalesce(F.col("label").isin(*VERBATIM), F.lit(False))).cast("int"), F.col("end") - F.col("start"), is_direct(F.col("label")).cast("int"), -F.col("start"), -F.col("seq"))
    c = e.groupBy(*keys, "island").agg(F.min("start").alias("lo"), F.max("end").alias("hi"), F.count("*").alias("members"), F.max_by(member, order).alias("d"), F.collect_list(member).alias("all"))
    own = replacement(F.col("d.text"), F.col("d.label"), F.col("d.generalized"), no_generalize)

    def leak(m: Column) -> Column:
        t, g = F.lower(strip(m["text"])), F.lower(F.col("own"))
        short = F.when((F.length(t) > 3) & t.endswith("s"), F.substring(t, F.lit(1), F.length(t) - 1))
        return (m["seq"] != F.col("d.seq")) & (F.contains(g, t) | F.coalesce(F.contains(g, short), F.lit(False)))

    c = c.withColumn("own", own)
    safe = (F.col("d.start") == F.col("lo")) & (F.col("d.end") == F.col("hi")) & ~F.col("own").startswith("[") & ~F.exists("all", leak) & ~is_direct(F.col("d.label"))
    text = F.when((F.col("members") == 1) | safe, F.col("own")).otherwise(placeholder_of(F.col("d.label")))
    return c.select(*keys, F.col("lo").cast("long").alias("start_pos"), F.col("hi").cast("long").alias("end_pos"), "members", text.alias("replacement"))


def stem(output_file: Column, position: Column) -> Column:
    """The name of a reviewed file without folder, suffix and redaction marker; task<n> without one."""
    name = F.regexp_extract(output_file, r"([^/\\]+?)(?:\.redacted)?(?:\.[^./\\]*)?$", 1)
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit("task"), position.cast("string")))
