"""File sources and sinks: notes, gold keys, runs, gazetteers and review exports."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimskog.operators.review import TASK


def _stem(path):
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1)


def notes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(doc_id, text, source_file): each file one document."""
    read = spark.read.text(paths, wholetext=True)
    return read.select(_stem(F.input_file_name()).alias("doc_id"), F.col("value").alias("text"), F.input_file_name().alias("source_file"))


def gold_key(spark: SparkSession, path: str) -> DataFrame:
    """(note, item_group, text, label, pii_type, risk) of a JSON key; names that start with _ are metadata."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    entries = raw.select(F.explode("m").alias("note", "entry")).where(~F.col("note").startswith("_"))
    item = "should_redact array<struct<text:string,label:string,type:string,risk:string>>, medications_flag_keep array<string>, should_not_flag array<string>"
    e = entries.select(F.regexp_replace("note", r"\.txt$", "").alias("note"), F.from_json("entry", item).alias("e"))
    redact = e.select("note", F.lit("should_redact").alias("item_group"), F.explode("e.should_redact").alias("i")).select("note", "item_group", "i.text", "i.label", F.col("i.type").alias("pii_type"), "i.risk")
    none = F.lit(None).cast("string")
    plain = [e.select("note", F.lit(g).alias("item_group"), F.explode(f"e.{g}").alias("text"), none.alias("label"), none.alias("pii_type"), none.alias("risk")) for g in ("medications_flag_keep", "should_not_flag")]
    return redact.unionByName(plain[0]).unionByName(plain[1])


AUDIT = "timestamp string, original string, label string, start long, end long, source string, risk string, generalized_to string"


def run_folder(spark: SparkSession, folder: str, run_label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(redacted texts, audit rows, stems that lack one of the two) of a run's folder."""
    texts = spark.read.text(f"{folder}/*.redacted.txt", wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.redacted\.txt$", 1).alias("note"), F.col("value").alias("redacted"))
    audits = spark.read.schema(AUDIT).json(f"{folder}/*.audit.json", multiLine=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.audit\.json$", 1).alias("note"), "*")
    stems = audits.select("note").distinct()
    missing = texts.select("note").join(stems, "note", "left_anti").unionByName(stems.join(texts.select("note"), "note", "left_anti"))
    tag = F.lit(run_label).alias("run_label")
    return texts.join(stems, "note", "left_semi").select(tag, "*"), audits.join(texts.select("note"), "note", "left_semi").select(tag, "*"), missing


def gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """(wikidata_id, label_en, label_sv, category) of a CSV; blank cells are null."""
    return spark.read.csv(path, header=True, schema="wikidata_id string, label_en string, label_sv string, category string", escape='"', multiLine=True)


def review_export(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, task) of exports that hold one task or a list each; position counts in its file.

    Corrupt files and tasks without data or results give no rows.
    """
    read = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    many, one = F.from_json("value", f"array<struct<{_typed(TASK)}>>"), F.from_json("value", TASK)
    found = read.select("file", F.posexplode(F.coalesce(F.when(F.col("value").rlike(r"^\s*\["), many), F.array(one))).alias("position", "task"))
    good = F.col("task.data").isNotNull() | F.col("task.predictions").isNotNull() | F.col("task.annotations").isNotNull()
    return found.where(good).select("file", F.col("position").cast("long").alias("position"), "task")


def _typed(fields: str) -> str:
    """Column definitions ("name TYPE, ...") as fields of a struct ("name: TYPE, ...")."""
    import re

    return re.sub(r"(^|, )(data|predictions|annotations) ", r"\1\2: ", fields)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def split_rows(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Training rows of a folder partitioned by ``split``; one split reads only its partition."""
    rows = spark.read.parquet(path)
    return rows if split is None else rows.where(F.col("split") == split)


# ---------------------------------------------------------------- sinks


def write_redacted(redacted: DataFrame, path: str) -> None:
    """Redacted texts as Parquet, one folder a run."""
    redacted.write.mode("overwrite").partitionBy("run_label").parquet(path)


def write_audit(audit: DataFrame, path: str) -> None:
    """Audit rows as JSON lines, stamped with the time of writing; non-ASCII letters stay."""
    audit.withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).write.mode("overwrite").json(path, ignoreNullFields=False)


def write_reasoning(rows: DataFrame, path: str) -> bool:
    """Reasoning rows as JSON, only where there are any; returns whether anything was written."""
    kept = rows.where("reasoning is not null and reasoning <> ''")
    if kept.isEmpty():
        return False
    kept.write.mode("overwrite").json(path)
    return True


def write_tasks(tasks: DataFrame, path: str, append: bool = False) -> None:
    """Review tasks as JSON arrays, one a part file, so that each file can be imported; appending adds files.

    What stands in the folder is never read, so a corrupt file does not stop an append.
    """

    def arrays(batches):
        yield pa.RecordBatch.from_arrays([pa.array(["["])], names=["value"])
        first = True
        for b in batches:
            rows = [t for t in b.column(0).to_pylist() if t is not None]
            if rows:
                rows = [r if first and not i else f",{r}" for i, r in enumerate(rows)]
                first = False
                yield pa.RecordBatch.from_arrays([pa.array(rows)], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])

    tasks.select("task").mapInArrow(arrays, "value string").write.mode("append" if append else "overwrite").text(path)


def write_reviewed(reviewed: DataFrame, audit: DataFrame, path: str) -> DataFrame:
    """Reviewed texts and their audit rows by stem; returns stems that several tasks share (the first task of each is written).

    ``reviewed`` has (file, position, stem, text), ``audit`` (file, position, audit columns).
    """
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy("stem").orderBy("file", "position"))
    kept = reviewed.withColumn("n_", n).where("n_ = 1").drop("n_")
    kept.write.mode("overwrite").parquet(f"{path}/texts")
    write_audit(audit.join(kept.select("file", "position", "stem"), ["file", "position"]).drop("file", "position"), f"{path}/audit")
    return reviewed.groupBy("stem").count().where("count > 1").select("stem")


def write_summary(scores: DataFrame, path: str) -> None:
    """A training summary as text: a line a model (few rows), best F2 first."""
    line = F.format_string("%-40s precision %.4f  recall %.4f  F1 %.4f  F2 %.4f", "model", "precision", "recall", "f1", "f2")
    scores.orderBy(F.desc("f2"), "model").coalesce(1).select(line.alias("value")).write.mode("overwrite").text(path)


def write_tuning(rows: DataFrame, base: str) -> None:
    """<base>_train and <base>_validation as CSV with a header, by the column ``part``; white space at the ends stays."""
    for part in ("train", "validation"):
        rows.where(F.col("part") == part).drop("part").write.mode("overwrite").csv(f"{base}_{part}", header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_gazetteer(rows: DataFrame, path: str) -> None:
    rows.select("wikidata_id", "label_en", "label_sv", "category").write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
