"""Conflict resolution: which of overlapping entities stand, and who owns each stretch of text.

Both are Arrow passes over the array of one document's findings, which its length bounds: greedy
acceptance keeps what stands sorted, the redaction plan sweeps over the boundaries, so neither compares all
findings with all.
"""

from __future__ import annotations

from bisect import bisect_left
from heapq import heappop, heappush
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimskog.functions.scan import array_of, lists
from dimskog.schema import DIRECT, GROUND_TRUTH, PROTECTED

_DIRECT, _PROTECTED, _TRUTH = frozenset(DIRECT), frozenset(PROTECTED), frozenset(GROUND_TRUTH)
FIELDS = ("seq", "text", "label", "start", "end", "source", "confidence", "generalized", "risk")


def entity(prefix: str = "") -> Column:
    """The entity struct of the columns of a row."""
    return F.struct(*[F.col(prefix + f).cast(t).alias(f) for f, t in zip(FIELDS, ("long", "string", "string", "int", "int", "string", "double", "string", "string"))])


def _priority(e: dict) -> tuple:
    """Direct first, then longer, then earlier in the list."""
    return e["label"] not in _DIRECT, e["start"] - e["end"], e["seq"]


def _discredits(r: dict, generalized: str | None) -> bool:
    """Whether a rejected finding discredits the generalization of one that stands: it is ground truth, or its
    text, also without a genitive s, stands in it."""
    text, told = r["text"].strip().lower(), (generalized or "").strip().lower()
    return r["source"] in _TRUTH or text in told or len(text) > 3 and text.endswith("s") and text[:-1] in told


def standing(entities: list[dict]) -> list[dict]:
    """Greedy acceptance in priority order: an entity stands if it overlaps none that stands already.

    One that does not takes away the generalizations it discredits.  What stands is disjoint and kept
    sorted, so the ones that an entity meets are neighbours.
    """
    starts: list[int] = []
    ends: list[int] = []
    held: list[dict] = []
    out = []
    for x in sorted(entities, key=_priority):
        at = bisect_left(starts, x["end"])
        if not at or ends[at - 1] <= x["start"]:
            x = dict(x)
            starts.insert(at, x["start"])
            ends.insert(at, x["end"])
            held.insert(at, x)
            out.append(x)
        elif x["text"] is not None and x["text"].strip():
            k = at - 1
            while k >= 0 and ends[k] > x["start"]:
                if _discredits(x, held[k]["generalized"]):
                    held[k]["generalized"] = None
                k -= 1
    return out


ENTITY_FIELDS = dict(zip(FIELDS, ("bigint", "string", "string", "int", "int", "string", "double", "string", "string")))


@F.arrow_udf(array_of(ENTITY_FIELDS))
def accepted(entities: pa.Array) -> pa.Array:
    """``standing`` over arrays of entities; null stays null."""
    return lists([None if es is None else [tuple(e[f] for f in FIELDS) for e in standing(es)] for es in entities.to_pylist()], ENTITY_FIELDS)


def collected(entities: DataFrame, keys: list[str]) -> DataFrame:
    """One row a document with its entities as an array (unordered; ``seq`` carries the order)."""
    return entities.groupBy(*keys).agg(F.collect_list(entity()).alias("entities"))


def greedy(entities: DataFrame, keys: list[str]) -> DataFrame:
    """Accepted entities of each document with their rank, generalizations distrusted where discredited.

    Null spans never enter; null keys form a document of their own; repeated entities keep the first.
    """
    docs = collected(entities.where("start is not null and end is not null"), keys)
    kept = docs.select(*keys, F.posexplode(accepted(F.col("entities"))).alias("rank", "e"))
    return kept.select(*keys, F.col("rank").cast("long").alias("rank"), "e.*")


_FRAGMENT = {
    "seq": "bigint", "text": "string", "label": "string", "source": "string", "start": "int", "end": "int", "whole": "boolean", "generalized": "string",
}


def owned(entities: list[dict]) -> list[tuple]:
    """The fragments of one document, by position: a sweep over its boundaries with a heap of the open entities.

    The least open entity by (direct, protected ground truth, longest, first) owns each stretch; stretches
    of one owner that touch are one fragment.
    """
    spans = sorted((e["start"], i) for i, e in enumerate(entities) if e["start"] < e["end"])
    bounds = sorted({x for s, i in spans for x in (s, entities[i]["end"])})
    order = [(e["label"] not in _DIRECT, not (e["source"] in _TRUTH and e["label"] in _PROTECTED), e["start"] - e["end"], e["seq"], i) for i, e in enumerate(entities)]
    pieces: list[list[int]] = []
    mine = [0] * len(entities)
    open_: list[tuple] = []
    at = 0
    for lo, hi in pairwise(bounds):
        while at < len(spans) and spans[at][0] == lo:
            heappush(open_, order[spans[at][1]])
            at += 1
        while open_ and entities[open_[0][-1]]["end"] <= lo:
            heappop(open_)
        if open_:
            i = open_[0][-1]
            mine[i] += hi - lo
            if pieces and pieces[-1][0] == i and pieces[-1][2] == lo:
                pieces[-1][2] = hi
            else:
                pieces.append([i, lo, hi])
    out = []
    for i, lo, hi in pieces:
        e = entities[i]
        whole = mine[i] == e["end"] - e["start"]
        text = e["text"] if whole or e["text"] is None else e["text"][lo - e["start"] : hi - e["start"]]
        out.append((e["seq"], text, e["label"], e["source"], lo, hi, whole, e["generalized"] if whole else None))
    return out


@F.arrow_udf(array_of(_FRAGMENT))
def fragments(entities: pa.Array) -> pa.Array:
    """``owned`` over arrays of entities; null stays null."""
    return lists([None if es is None else owned(es) for es in entities.to_pylist()], _FRAGMENT)


def plan(entities: DataFrame, keys: list[str]) -> DataFrame:
    """Non-overlapping fragments (keys, seq, label, source, start, end, whole, generalized, text) that cover every entity.

    Each stretch between neighbouring boundaries belongs to the covering entity that is direct, then
    protected ground truth, then longest, then first.  An entity that owns all of its span keeps its
    generalization, a fragment has none.  One shuffle gathers a document's entities.
    """
    docs = collected(entities.where("start < end"), keys)
    each = docs.select(*keys, F.explode(fragments(F.col("entities"))).alias("f"))
    return each.select(*keys, *[f"f.{c}" for c in ("seq", "label", "source", "start", "end", "whole", "generalized", "text")])


__all__ = ["ENTITY_FIELDS", "FIELDS", "accepted", "collected", "entity", "fragments", "greedy", "owned", "plan", "standing"]
