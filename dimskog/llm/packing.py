"""Filling fixed-capacity training sequences with whole documents, in a given token mixture.

Mixture-controlled packing
--------------------------
Each source is a queue with a target share of the tokens (its share of the corpus where none is given).
In an ideal flow every queue runs from its start to its end at the rate of its target; queues without a
target run once the others are through.  A document's place in its queue, by prefix sums, gives its time
in that flow, and equal stretches of the whole flow are the shards, which are filled independently.  What
a queue is behind or ahead of the ideal flow at a shard's start - the flow less the tokens of its
documents in all shards before - is the deficit that the shard begins with, so deficits are carried from
shard to shard without one waiting for another.

Inside a shard, deficit round-robin fills one window of sequences after another: every source gains
credit in proportion to its target, spends it on the next documents of its queue, and carries the rest
to the next window.  The window's documents are placed best-fit by size, largest first; what does not
fit goes back to the front of its queue with its credit.

A document above the capacity, and only such a document, is cut into full sequences and a rest that is
packed like any other.  Every document weighs BASE beside its tokens where shards are cut, so a shard
holds about SHARD_WEIGHT tokens or SHARD_WEIGHT / BASE documents at most; prefix sums run over (queue, bucket) groups of bounded
size, so a source with a third of all rows is split like the rest.

Defined results: null source is a source of its own; documents without tokens (null or empty text) are
assigned too, with size 0; equal sizes are ordered by doc_id; an empty table gives no rows; a target for
a source without tokens has no effect; where a queue is used up before the rest, the others share its part.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimskog.llm import tokens
from dimskog.runtime import cut, table

#: Weight of a shard, of a document beside its tokens, and sequences of a window.
SHARD_WEIGHT, BASE, WINDOW_SEQUENCES = 4_000_000, 20, 128
#: Rows of one (queue, bucket) group, about.
BUCKET_ROWS = 20_000
#: So many of the largest sources have queues of their own, the rest of them share one.
QUEUES = 10_000


class Flow:
    """The ideal flow of queues with tokens and weights: where each begins and ends, and what has passed at a time."""

    def __init__(self, tokens: list[int], weights: list[int], targets: list[float]):
        self.tokens, weight, share = np.array(tokens, float), np.array(weights, float), np.array(targets, float)
        timed = (share > 0) & (self.tokens > 0)
        share = share / (share[timed].sum() or 1.0)
        self.start, self.end = np.zeros(len(tokens)), np.zeros(len(tokens))
        self.end[timed] = self.tokens[timed] / share[timed]
        last = self.end.max(initial=0.0)
        late = ~timed & (self.tokens > 0)
        self.start[late], self.end[late] = last, last + self.tokens[late].sum()
        self.end[self.tokens == 0] = self.end.max(initial=0.0) or 1.0  # empty documents lie everywhere
        self.knots = np.unique(np.concatenate([[0.0], self.start, self.end]))
        rate = np.zeros(len(self.knots))
        np.add.at(rate, np.searchsorted(self.knots, self.start), weight / (self.end - self.start))
        np.add.at(rate, np.searchsorted(self.knots, self.end), -weight / (self.end - self.start))
        passed = np.concatenate([[0.0], np.cumsum(np.cumsum(rate)[:-1] * np.diff(self.knots))])
        self.passed = passed / (passed[-1] or 1.0)

    def share_at(self, time: np.ndarray) -> np.ndarray:
        """The part of all weight that has passed at a time."""
        return np.interp(time, self.knots, self.passed)

    def tokens_at(self, part: float) -> np.ndarray:
        """The tokens of each queue that have passed when that part of all weight has."""
        time = np.interp(part, self.passed, self.knots)
        return self.tokens * np.clip((time - self.start) / (self.end - self.start), 0.0, 1.0)


def queue_places(items: DataFrame) -> DataFrame:
    """Adds ``place`` in (0, 1) to (doc_id, part, source, q, size): where each item lies in its queue's tokens, by hash order.

    A queue without any tokens counts its items instead.
    """
    rows = items.groupBy("q").agg(F.count("*").alias("rows"), F.sum("size").alias("tokens"))  # at most QUEUES + 1
    h = F.xxhash64("doc_id", "part")
    keyed = items.join(F.broadcast(rows), "q").withColumn("h", h).withColumn("bucket", F.expr(f"cast((h / 18446744073709551616.0D + 0.5D) * ceil(rows / {BUCKET_ROWS}) as int)"))
    keyed = keyed.withColumn("unit", F.when(F.col("tokens") > 0, F.col("size")).otherwise(F.lit(1)))
    sums = keyed.groupBy("q", "bucket").agg(F.sum("unit").alias("volume"))
    before = W.partitionBy("q").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("q", "bucket", F.coalesce(F.sum("volume").over(before), F.lit(0)).alias("before"))
    inside = W.partitionBy("q", "bucket").orderBy("h", "doc_id", "part").rowsBetween(W.unboundedPreceding, -1)
    place = (F.col("before") + F.coalesce(F.sum("unit").over(inside), F.lit(0)) + F.col("unit") / 2) / F.greatest("tokens", F.when(F.col("tokens") == 0, F.col("rows")))
    return keyed.join(sums, ["q", "bucket"]).select("doc_id", "part", "source", "q", "size", place.alias("place"))


def fill_shard(items: list[tuple], capacity: int, window: int, share: dict | None = None, credit: dict | None = None) -> list[tuple[int, int, int]]:
    """(item index, sequence, position) for (queue, time, size) items of one shard, by deficit round-robin.

    ``share`` has the target of each queue (its part of the items where none is given), ``credit`` the deficit it begins with.
    """
    queues: dict = {}
    for i, (queue, time, _) in sorted(enumerate(items), key=lambda x: (x[1][1], x[0])):
        queues.setdefault(queue, deque()).append(i)
    size = [x[2] for x in items]
    left = sum(size)
    volume = share or {q: sum(size[i] for i in own) for q, own in queues.items()}
    credit = {q: (credit or {}).get(q, 0.0) for q in queues}
    out, first = [], 0
    while queues:
        goal = min(window * capacity, left)
        whole = sum(volume.get(q, 0.0) for q in queues)
        for q in queues:
            credit[q] += goal * (volume.get(q, 0.0) / whole if whole else 1 / len(queues))
        chosen = _turns(queues, size, credit, goal)
        placed, used, back = _best_fit(chosen, size, capacity, window, final=not any(queues.values()))
        out += [(i, first + sequence, position) for i, sequence, position in placed]
        for i in sorted(back, key=lambda i: (items[i][1], i), reverse=True):
            queues[items[i][0]].appendleft(i)
            credit[items[i][0]] += size[i]
        first += used
        left -= sum(size[i] for i, *_ in placed)
        queues = {q: own for q, own in queues.items() if own}
    return out


def _turns(queues: dict, size: list[int], credit: dict, goal: int) -> list[int]:
    """The items of a window: one a turn from each queue that has credit for half of it."""
    chosen, taken, active = [], 0, list(queues)
    while active and (taken < goal or not goal):
        still = []
        for q in active:
            i = queues[q][0]
            if size[i] <= 2 * credit[q] or not size[i]:
                chosen.append(queues[q].popleft())
                credit[q] -= size[i]
                taken += size[i]
                if queues[q]:
                    still.append(q)
        active = still
    if not chosen:  # every next item is too large for its credit: the queue most in credit goes on
        q = max(queues, key=lambda q: credit[q])
        chosen.append(queues[q].popleft())
        credit[q] -= size[chosen[0]]
    return chosen


def _best_fit(chosen, size, capacity, window, final):
    """Largest first into the fullest sequence with room; returns placements, sequences used, what stays out."""
    room: list[tuple[int, int]] = []  # (free, sequence), sorted
    fill: list[int] = []
    placed, back = [], []
    for i in sorted(chosen, key=lambda i: (-size[i], i)):
        k = bisect_left(room, (size[i], -1))
        if k < len(room):
            free, seq = room.pop(k)
        elif len(fill) < window or final:
            seq, free = len(fill), capacity
            fill.append(0)
        else:
            back.append(i)
            continue
        placed.append((i, seq, fill[seq]))
        fill[seq] += 1
        insort(room, (free - size[i], seq))
    return placed, len(fill), back


def pack(docs: DataFrame, capacity: int, folder: str = tokens.FOLDER, targets: dict[str | None, float] | None = None) -> DataFrame:
    """(doc_id, part, source, n_tokens, shard, sequence, position) of every document or part of one.

    ``targets`` has the wanted share of tokens by source; sources it leaves out come last.
    """
    spark = docs.sparkSession
    sized = cut(tokens.sizes(docs, folder))
    full = F.expr(f"cast(case when n_tokens > {capacity} then ceil(n_tokens / {capacity}) else 1 end as int)")
    parts = sized.withColumn("part", F.explode(F.sequence(F.lit(0), full - 1)))
    size = F.expr(f"cast(case when n_tokens > {capacity} then least({capacity}, n_tokens - part * {capacity}) else n_tokens end as long)")
    items = parts.select("doc_id", "part", "source", size.alias("size"))
    by_source = items.groupBy("source").agg(F.sum("size").alias("tokens"), F.sum(F.col("size") + BASE).alias("weight"))
    own = [tuple(r) for r in by_source.orderBy(F.desc("weight"), "source").limit(QUEUES).collect()]
    all_tokens, all_weight = by_source.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    rest = (all_tokens - sum(t for _, t, _ in own), all_weight - sum(w for *_, w in own))
    flow = Flow([*(t for _, t, _ in own), rest[0]], [*(w for *_, w in own), rest[1]], [*((targets.get(s, 0.0) if targets else t) for s, t, _ in own), 0.0 if targets else rest[0]])
    shards = max(1, -(-all_weight // SHARD_WEIGHT))
    numbers = F.broadcast(spark.createDataFrame([(s, i) for i, (s, *_) in enumerate(own)], "s string, q int"))  # at most QUEUES rows
    queued = items.join(numbers, F.col("source").eqNullSafe(F.col("s")), "left").select("doc_id", "part", "source", "size", F.coalesce("q", F.lit(len(own))).alias("q"))
    shared = spark.sparkContext.broadcast(flow)

    @F.arrow_udf("struct<time:double,shard:int>")
    def timed(place: pa.Array, q: pa.Array) -> pa.Array:
        flow, q = shared.value, q.to_numpy(zero_copy_only=False)
        time = flow.start[q] + place.to_numpy(zero_copy_only=False) * (flow.end - flow.start)[q]
        shard = np.minimum((flow.share_at(time) * shards).astype(np.int32), shards - 1)
        return pa.StructArray.from_arrays([pa.array(time), pa.array(shard, pa.int32())], ["time", "shard"])

    placed = cut(queue_places(queued).withColumn("at", timed("place", "q")).select("doc_id", "part", "source", "q", "size", "at.time", "at.shard"))
    past = W.partitionBy("q").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    before = placed.groupBy("shard", "q").agg(F.sum("size").alias("tokens")).select("shard", "q", F.coalesce(F.sum("tokens").over(past), F.lit(0)).alias("before"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        flow, shard = shared.value, int(pdf["shard"].iloc[0])
        earlier = pdf.drop_duplicates("q")
        begin, end = flow.tokens_at(shard / shards), flow.tokens_at((shard + 1) / shards)
        share = {q: float(end[q] - begin[q]) for q in earlier.q}
        credit = {q: float(begin[q] - b) for q, b in zip(earlier.q, earlier.before)}
        pdf = pdf.sort_values(["time", "doc_id", "part"], kind="stable").reset_index(drop=True)
        done = pd.DataFrame(fill_shard(list(zip(pdf.q, pdf.time, pdf["size"])), capacity, WINDOW_SEQUENCES, share, credit), columns=["i", "sequence", "position"])
        out = pdf.loc[done.i, ["doc_id", "part", "source", "size", "shard"]].reset_index(drop=True)
        out["sequence"], out["position"] = done.sequence, done.position
        return out.rename(columns={"size": "n_tokens"})[["doc_id", "part", "source", "n_tokens", "shard", "sequence", "position"]]

    schema = "doc_id long, part int, source string, n_tokens long, shard int, sequence long, position int"
    return placed.join(before, ["shard", "q"]).groupBy("shard").applyInPandas(fill, schema)


def capacity_of(spark: SparkSession, sf_dir: str) -> int:
    row = table(spark, sf_dir, "size_limits").where("tbl = 'documents' and size_unit = 'tokens'").select("max_size").first()
    if row is None:
        raise ValueError("size_limits names no capacity for documents in tokens")
    return row[0]


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), capacity_of(spark, sf_dir))


def fill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per shard: sequences, tokens, unused share, largest deviation of a source's share from its target in the
    shard and in any full window, and in tokens after this and all shards before."""
    capacity = capacity_of(spark, sf_dir)
    p = cut(packed(spark, sf_dir))
    shares = p.groupBy("source").agg(F.sum("n_tokens").alias("t")).crossJoin(p.agg(F.sum("n_tokens").alias("all"))).select(F.col("source").alias("s"), (F.col("t") / F.col("all")).alias("target"))  # one row of totals
    whole = p.groupBy("shard").agg(F.countDistinct("sequence").alias("sequences"), F.sum("n_tokens").alias("tokens"))
    by = p.groupBy("shard", "source").agg(F.sum("n_tokens").alias("t")).join(whole, "shard").join(shares, F.expr("source <=> s"))
    up_to = W.partitionBy("source").orderBy("shard").rowsBetween(W.unboundedPreceding, 0)
    by = by.withColumn("carried", F.abs(F.sum(F.col("t") - F.col("target") * F.col("tokens")).over(up_to)))
    off = by.groupBy("shard").agg(F.max(F.abs(F.col("t") / F.col("tokens") - F.col("target"))).alias("mixture_error"), F.max("carried").alias("carried_tokens"))
    window = F.floor(F.col("sequence") / WINDOW_SEQUENCES).alias("window")
    windows = p.groupBy("shard", window).agg(F.countDistinct("sequence").alias("n"), F.sum("n_tokens").alias("w")).where(F.col("n") == WINDOW_SEQUENCES)
    inside = p.groupBy("shard", window, "source").agg(F.sum("n_tokens").alias("t")).join(windows, ["shard", "window"]).join(shares, F.expr("source <=> s"))
    worst = inside.groupBy("shard").agg(F.max(F.abs(F.col("t") / F.col("w") - F.col("target"))).alias("window_error"))
    return whole.join(off, "shard").join(worst, "shard", "left").select(
        "shard", "sequences", "tokens", (1 - F.col("tokens") / (F.col("sequences") * capacity)).alias("unused"), "mixture_error", "window_error", "carried_tokens"
    )


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: documents that are placed, those whose parts do not add up to their tokens, those cut without need,
    and sequences over the capacity that hold one of its documents."""
    capacity = capacity_of(spark, sf_dir)
    p = cut(packed(spark, sf_dir))
    docs = p.groupBy("doc_id", "source").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("parts"))
    known = tokens.sizes(table(spark, sf_dir, "documents")).select("doc_id", F.col("n_tokens").alias("wanted"))
    counted = docs.join(known, "doc_id").groupBy("source").agg(
        F.count("*").alias("documents"), F.count_if(F.col("n") != F.col("wanted")).alias("not_whole"), F.count_if((F.col("parts") > 1) & (F.col("wanted") <= capacity)).alias("cut_in_vain")
    )
    full = p.groupBy("shard", "sequence").agg(F.sum("n_tokens").alias("n"), F.collect_set("source").alias("sources"), F.count_if(F.col("source").isNull()).alias("none")).where(F.col("n") > capacity)
    over = full.select(F.explode(F.when(F.col("none") > 0, F.array_append("sources", F.lit(None).cast("string"))).otherwise(F.col("sources"))).alias("s")).groupBy("s").count()
    return counted.join(over, F.expr("source <=> s"), "left").select("source", "documents", "not_whole", "cut_in_vain", F.coalesce("count", F.lit(0)).cast("long").alias("over_full"))
