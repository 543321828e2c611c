"""Splitting oversized texts at natural boundaries, with an exact overlap between consecutive pieces.

Pointer doubling
----------------
Every position of a text has at most one legal successor: the farthest cut that keeps the piece within
the limit, taken at the strongest break of the later half of the reach (blank line, line, sentence,
clause, word), else at the farthest word break of the reach, else at the limit itself (not inside a
grapheme cluster that fits).  The first cut leaves more than the overlap before it.  A piece starts ``overlap`` code points before the cut of the one before.  The
successor table of all positions is built with array operations; squaring it (table of 1, 2, 4, ...
steps) yields all greedy cuts from the start in log2(pieces) rounds instead of one after another.

Only rows above the limit reach Python; all others are one piece as they are.

Defined results: null texts give no row; empty texts are one empty piece; a limit not above the overlap
is refused; rows repeat as they do in the table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimskog.llm.corpus import CLUSTER, map_batches, note_texts
from dimskog.runtime import table

_SPACE = np.array(sorted({9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}), dtype=np.uint32)
_SENTENCE = np.array([ord(c) for c in ".!?…"], dtype=np.uint32)
_CLAUSE = np.array([ord(c) for c in ",;:–—)”"], dtype=np.uint32)


def strengths(codes: np.ndarray) -> np.ndarray:
    """Strength of a cut before each position 0..n: 5 blank line, 4 line, 3 sentence, 2 clause, 1 word, 0 none."""
    n = len(codes)
    out = np.zeros(n + 1, dtype=np.int8)
    if n < 2:
        return out
    space = np.isin(codes, _SPACE)
    newline = (codes == 10) | ((codes == 13) & ~np.append(codes[1:] == 10, False)) | (codes == 0x2029)
    at = np.flatnonzero(space[:-1] & ~space[1:]) + 1  # first character after a run of white space
    if len(at):
        last_solid = np.maximum.accumulate(np.where(space, -1, np.arange(n)))
        before = last_solid[at - 1]
        total = np.concatenate([[0], np.cumsum(newline)])
        lines = total[at] - total[before + 1]
        sign = np.where(before >= 0, codes[np.maximum(before, 0)], 0)
        kind = np.where(lines > 1, 5, np.where(lines == 1, 4, np.where(np.isin(sign, _SENTENCE), 3, np.where(np.isin(sign, _CLAUSE), 2, 1))))
        out[at] = kind
    return out


def successors(text: str, limit: int, overlap: int) -> np.ndarray:
    """The farthest legal cut after each position; n points to itself."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    n = len(codes)
    strength = strengths(codes)
    here = np.arange(n + 1)
    reach = np.minimum(here - np.where(here == 0, 0, overlap) + limit, n)
    least = here + 1
    least[0] = overlap + 1  # the second piece begins inside the text
    half = np.maximum(least, (here + reach + 1) // 2)
    best = np.full(n + 1, -1, dtype=np.int64)
    for k in (5, 4, 3, 2, 1):
        last = np.maximum.accumulate(np.where(strength >= k, here, -1))
        last = last[reach]
        best = np.where((best < 0) & (last >= half), last, best)
    last = np.maximum.accumulate(np.where(strength >= 1, here, -1))[reach]
    best = np.where((best < 0) & (last >= least), last, best)
    # a hard cut keeps grapheme clusters whole where that still advances
    whole = np.ones(n + 1, dtype=bool)
    if (best[reach < n] < 0).any() and not (text.isascii() and "\r" not in text):  # else no hard cut can come up
        whole[:n] = False
        whole[[m.start() for m in CLUSTER.finditer(text)]] = True
    hard = np.maximum.accumulate(np.where(whole, here, -1))[reach]
    hard = np.where(hard >= least, hard, reach)
    best = np.where(best < 0, hard, best)
    return np.where(reach >= n, n, best)


def cuts(text: str, limit: int, overlap: int) -> list[int]:
    """All cuts after 0, the last being the length, by squaring the successor table."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be below the limit")
    n = len(text)
    if n <= limit:
        return [n]
    step = successors(text, limit, overlap)
    reached = np.array([0])
    while True:
        more = np.unique(np.concatenate([reached, step[reached]]))
        if len(more) == len(reached):
            break
        reached = more
        step = step[step]
    return reached[1:].tolist()


def spans(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    ends = cuts(text, limit, overlap)
    return [(0 if i == 0 else ends[i - 1] - overlap, e) for i, e in enumerate(ends)]


def pieces(texts: DataFrame, limits: DataFrame) -> DataFrame:
    """tbl, row_id, piece_no, n_pieces, start_pos, end_pos, piece of every text.

    ``limits`` has (tbl, max_size, overlap_size), one row a table.
    """
    sized = texts.join(F.broadcast(limits), "tbl")  # one row a table
    whole = sized.where("length(text) <= max_size").select(
        "tbl", "row_id", F.lit(0).alias("piece_no"), F.lit(1).alias("n_pieces"), F.lit(0).cast("long").alias("start_pos"),
        F.length("text").cast("long").alias("end_pos"), F.col("text").alias("piece"),
    )
    return whole.unionByName(_cut(sized))


def _cut(sized: DataFrame) -> DataFrame:
    """The pieces of the rows above the limit."""

    def make():
        def step(batch):
            rows = []
            for tbl, row, text, limit, overlap in zip(*(batch.column(i).to_pylist() for i in range(5))):
                own = spans(text, limit, overlap)
                rows += [(tbl, row, i, len(own), s, e, text[s:e]) for i, (s, e) in enumerate(own)]
            names = ("tbl", "row_id", "piece_no", "n_pieces", "start_pos", "end_pos", "piece")
            return {k: [r[i] for r in rows] for i, k in enumerate(names)}

        return step

    large = sized.where("length(text) > max_size").select("tbl", "row_id", "text", "max_size", "overlap_size")
    return map_batches(large, make, "tbl string, row_id long, piece_no int, n_pieces int, start_pos long, end_pos long, piece string")


def _limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "size_limits").where("size_unit = 'code points'").select("tbl", "max_size", "overlap_size")


def all_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(note_texts(spark, sf_dir).select("tbl", "row_id", "text"), _limits(spark, sf_dir))


def rejoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per text: its length, whether no piece is over the limit, whether each shares the overlap with the one before,
    and whether the pieces without their overlaps give the text again."""
    texts, limits = note_texts(spark, sf_dir).select("tbl", "row_id", "text"), _limits(spark, sf_dir)
    own = F.when(F.col("piece_no") == 0, F.col("piece")).otherwise(F.expr("substring(piece, overlap_size + 1)"))
    shared = (F.col("piece_no") == 0) | (F.col("start_pos") == F.col("before") - F.col("overlap_size"))
    before = F.lag("end_pos").over(W.partitionBy("tbl", "row_id").orderBy("piece_no"))
    each = pieces(texts, limits).join(F.broadcast(limits), "tbl").withColumn("before", before)
    back = each.groupBy("tbl", "row_id").agg(
        F.bool_and(F.length("piece") <= F.col("max_size")).alias("within_limit"), F.bool_and(shared).alias("overlaps"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", own.alias("own")))), lambda x: x["own"]), "").alias("again"),
    )
    return texts.join(back, ["tbl", "row_id"]).select("tbl", "row_id", F.length("text").cast("long").alias("n_chars"), "within_limit", "overlaps", (F.col("again") == F.col("text")).alias("same"))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id of the rows that had to be cut: those with a second piece."""
    sized = note_texts(spark, sf_dir).select("tbl", "row_id", "text").join(F.broadcast(_limits(spark, sf_dir)), "tbl")
    return _cut(sized).where("piece_no = 1").select("tbl", "row_id")
