"""Session helpers shared by every operator: table access and durable lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the data set directory ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; fall back to a temporary folder only where none is set.

    The fallback serves local tests and goes with the process.  A cluster always names a shared folder.
    What no plan refers to any more is removed while the job runs (``spark.cleaner.referenceTracking.cleanCheckpoints``
    of the session decides; the launcher of a cluster job sets it).
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="dimskog-checkpoints-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from there (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession) -> str:
    """A fresh path in the shared folder, for a table that is read again."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"


def remove_checkpoints(spark: SparkSession) -> None:
    """Deletes this application's checkpoints, once its results are written."""
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        path = spark._jvm.org.apache.hadoop.fs.Path(found.get())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly where a batch source is too small to give every task slot a split.

    A table of one small file would run on one core.  The decision takes the optimizer's size estimate;
    at scale a scan has more splits than slots, the plan stays as it is and nothing is shuffled.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df.repartition(slots) if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < slots * split else df
