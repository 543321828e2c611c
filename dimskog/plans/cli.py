"""spark-submit entry: de-identify a folder of notes, or a Parquet table, in one job.

    spark-submit dimskog/plans/cli.py --notes in/*.txt --out out --mode no_bert --backend mock
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimskog.operators import gazetteer, model, review
from dimskog.plans.pipeline import MODES, Options, deidentify
from dimskog.runtime import remove_checkpoints, spread
from dimskog.sources import files


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--notes", required=True, help="text files (one document each) or a Parquet table with --key and text")
    p.add_argument("--key", default="doc_id")
    p.add_argument("--out", required=True)
    p.add_argument("--run-label", default="run")
    p.add_argument("--mode", choices=MODES, default="full")
    p.add_argument("--backend", nargs="*", default=["mock"])
    p.add_argument("--judges", nargs="*", default=[])
    p.add_argument("--rounds", type=int, default=2, help="judge rounds before a document is left for review")
    p.add_argument("--min-votes", type=int, default=1, help="judges that must raise a quote")
    p.add_argument("--generalize-backend", help="a separate stage for generalizations")
    p.add_argument("--transport", help="module:function that gives a chat model's completion by checkpoint")
    p.add_argument("--model", help="factory of a token model, module:function")
    p.add_argument("--gazetteer", help="CSV; left out where the file is missing")
    for flag in ("quasi-only", "no-generalize", "no-gazetteer", "backstop", "thinking", "review"):
        p.add_argument(f"--{flag}", action="store_true")
    p.add_argument("--append-review", action="store_true")
    return p.parse_args(args)


def run(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    """Runs one job and writes redacted texts, audit, failed calls, reasoning where there is any and, if asked, review tasks with their page."""
    docs = spark.read.parquet(a.notes) if a.notes.endswith(".parquet") else files.notes(spark, a.notes)
    docs = spread(docs.select(a.key, "text"))
    names = gazetteer.patterns(files.gazetteer(spark, a.gazetteer)) if a.gazetteer and not a.no_gazetteer and files.exists(spark, a.gazetteer) else None
    detector = (lambda d, k: model.detect(d, k, a.model)) if a.model else None
    options = Options(
        a.mode, tuple(a.backend), a.quasi_only, a.no_generalize, a.backstop, names is not None, model=detector, judges=tuple(a.judges), rounds=a.rounds, min_votes=a.min_votes,
        generalize_backend=a.generalize_backend, thinking=a.thinking, transport=a.transport,
    )
    out = deidentify(docs, a.key, options, names)
    label = F.lit(a.run_label)
    files.write_redacted(out["redacted"].withColumn("run_label", label), f"{a.out}/redacted")
    files.write_audit(out["audit"].withColumn("run_label", label), f"{a.out}/audit")
    files.write_reasoning(out["reasoning"], f"{a.out}/reasoning")
    out["errors"].drop("raw").write.mode("overwrite").json(f"{a.out}/errors")
    out["flags"].write.mode("overwrite").json(f"{a.out}/flags")
    if a.review or a.append_review:
        tasks = review.tasks(docs.withColumn("output_file", F.concat(F.col(a.key).cast("string"), F.lit(".redacted.txt"))), review.regions(out["entities"], [a.key]), [a.key], ["output_file"])
        files.write_tasks(tasks, f"{a.out}/review", append=a.append_review)
        spark.createDataFrame([(review.labeling_page(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.out}/review_page")
    return out


def main() -> None:
    spark = SparkSession.builder.appName("dimskog").getOrCreate()
    run(spark, arguments())
    remove_checkpoints(spark)


if __name__ == "__main__":
    main()
