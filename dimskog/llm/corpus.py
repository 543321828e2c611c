"""The two note-like tables under one schema, and Arrow helpers for per-row text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimskog.runtime import table


#: Grapheme clusters: a base character with its marks and joiners, a flag, a syllable block.
CLUSTER = regex.compile(r"\X")
#: Arrow batches hold at most so many bytes, so that a run of very long texts does not fill a worker.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 32 * 2**20


def note_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``notes`` and ``sv_pure3`` as (tbl, row_id, source, text).

    Rows with null text are left out: they are no cases of any problem on these fields.
    """
    notes = table(spark, sf_dir, "notes").select(
        F.lit("notes").alias("tbl"), F.col("note_id").alias("row_id"), F.col("unit_code").alias("source"), "text"
    )
    rows = table(spark, sf_dir, "sv_pure3").select(
        F.lit("sv_pure3").alias("tbl"), "row_id", "source", F.col("source_text").alias("text")
    )
    return notes.unionByName(rows).where("text is not null")


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """``mapInArrow`` with a per-task function from a record batch to columns of the output schema.

    ``make`` runs once per task, so automata and tables are built once and not per batch.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF, None) in (None, str(2**31 - 1)):  # the default leaves batches of long texts unbounded
        conf.set(BATCH_CONF, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                out = step(batch)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in ((f, out[f.name]) for f in arrow)],
                    schema=arrow,
                )

    return df.mapInArrow(run, schema)
