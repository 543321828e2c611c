"""Streams of notes: redaction without state, and late-aware counts of what was found.

All per-document operators are expressions of one row, so the batch transformation runs on a stream as
it is; only the counts keep state, bounded by a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimskog.operators.rules import accepted
from dimskog.plans.pipeline import redact_by_rules


def read_notes(spark: SparkSession, folder: str, schema: StructType, files_a_trigger: int = 16) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)


def redacted(notes: DataFrame) -> DataFrame:
    """The notes with ``redacted`` text; null texts stay null.  Works on streams and on batches."""
    return notes.withColumn("redacted", redact_by_rules(F.col("text")))


def deduplicated(notes: DataFrame, delay: str = "30 days") -> DataFrame:
    """Notes delivered twice (same doc_id and text) once, as far back as the watermark reaches."""
    return notes.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["doc_id", "text"])


def label_counts(notes: DataFrame, window: str = "1 day", delay: str = "30 days") -> DataFrame:
    """Findings by label and window of receipt; rows later than ``delay`` are dropped by the watermark."""
    found = notes.withWatermark("received_at", delay).where("text is not null").select("received_at", F.explode(accepted(F.col("text"))).alias("e"))
    return found.groupBy(F.window("received_at", window).alias("w"), F.col("e.label").alias("label")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "label", "n")
