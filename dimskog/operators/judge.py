"""The quality gate: a panel's flags, deduplicated and freed of misread placeholders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimskog.schema import FALLBACK, PLACEHOLDERS

TOKENS = "|".join(rf"\Q{p}\E" for p in sorted({*PLACEHOLDERS.values(), FALLBACK}))


def misread(quote: Column) -> Column:
    """Whether a quote holds a placeholder and, without them, no digit and no capitalised word but the first."""
    rest = F.regexp_replace(quote, TOKENS, "")
    words = F.filter(F.split(rest, r"(?U)\s+"), lambda w: w != "")
    bare = F.transform(words, lambda w: F.regexp_replace(w, r"""^[,.():;"']+|[,.():;"']+$""", ""))
    later = F.exists(F.slice(bare, F.lit(2), F.greatest(F.size(bare), F.lit(1))), lambda w: w.rlike(r"^\p{Lu}"))
    return quote.rlike(TOKENS) & ~rest.rlike(r"\p{Nd}") & ~later


def panel(flags: DataFrame, key: str, min_votes: int = 1) -> DataFrame:
    """(key, quote, reason, judge, votes) of (key, seq, judge, quote, reason).

    Empty quotes never count; the first flag of a quote stands, if enough different judges raised it and
    it is no misreading.
    """
    f = flags.where("quote <> ''")
    votes = f.groupBy(key, "quote").agg(F.countDistinct("judge").alias("votes"), F.min_by(F.struct("reason", "judge"), "seq").alias("f"))
    return votes.where(F.col("votes") >= min_votes).where(~misread(F.col("quote"))).select(key, "quote", "f.reason", "f.judge", F.col("votes").cast("long").alias("votes"))


def needs_review(docs: DataFrame, survivors: DataFrame, key: str) -> DataFrame:
    """(key, needs_review): whether any flag survives."""
    hit = survivors.groupBy(key).agg(F.count("*").alias("n"))
    return docs.select(key).distinct().join(hit, key, "left").select(key, F.col("n").isNotNull().alias("needs_review"))


def first_flags(flags: DataFrame, key: str) -> DataFrame:
    """Flags without repeated quotes, the first kept."""
    n = F.row_number().over(W.partitionBy(key, "quote").orderBy("seq"))
    return flags.where("quote <> ''").withColumn("n_", n).where("n_ = 1").drop("n_")


def rounds(docs: DataFrame, review, retry, key: str, most: int = 2, min_votes: int = 1):
    """The bounded retry loop: (documents after the last round, surviving flags).

    ``review(docs)`` gives flags, ``retry(docs, flags)`` redacted documents.  Only flagged documents go on;
    each round's result is cut at a reliable checkpoint, so plans stay short.
    """
    from dimskog.runtime import cut

    done, open_ = [], docs
    for _ in range(most):
        flags = cut(panel(review(open_), key, min_votes))
        done.append(open_.join(flags.select(key).distinct(), key, "left_anti"))
        open_ = cut(open_.join(flags.select(key).distinct(), key, "left_semi"))
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done), flags.limit(0)
        open_ = cut(retry(open_, flags))
    return reduce(DataFrame.unionByName, done, open_), panel(review(open_), key, min_votes)
