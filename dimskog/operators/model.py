"""Token-classification models as detectors: chunk planning, prediction per chunk, decoding, repair.

A model is any object with ``predict(text) -> [(tag, confidence, start, end), ...]`` for the tokens of a
text, built once a worker process from an importable factory ("module:function").  Predictions are
decoded where they are made, so only spans leave the pass; de-duplication and repair are the operators
every detector uses.  A model that knows its tokens (``count``) has its limit in tokens.
"""

from __future__ import annotations

import importlib
import re
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimskog.operators import chunking, conflicts, tagging
from dimskog.schema import CONFIDENCE, ENTITY

#: Share of a model's limit that a chunk may fill, and the overlap of plain windows.
FILL, OVERLAP = 0.85, 50


class TokenModel(Protocol):
    def predict(self, text: str) -> list[tuple[str, float, int, int]]:
        """BIO/BIOES tags of a text's tokens with confidence and code-point span; (0, 0) marks special tokens."""


class DictionaryModel:
    """The deterministic stand-in for tests: tags listed words, runs of one category as one span."""

    def __init__(self, words: dict[str, tuple[str, float]] | None = None):
        self.words = words or {"Anna": ("Name", 0.99), "Ek": ("Name", 0.98), "Uppsala": ("Address", 0.97), "kanske": ("Name", 0.6)}

    def predict(self, text: str) -> list[tuple[str, float, int, int]]:
        out, last = [("O", 1.0, 0, 0)], None
        for m in re.finditer(r"\w+|[^\w\s]", text):
            category, confidence = self.words.get(m.group(), (None, 1.0))
            out.append(("O" if category is None else f"{'I' if category == last else 'B'}-{category}", confidence, *m.span()))
            last = category
        return out


_BUILT: dict[str, TokenModel] = {}


def built(factory: str) -> TokenModel:
    """The model of a factory name, once a process."""
    if factory not in _BUILT:
        module, _, name = factory.partition(":")
        _BUILT[factory] = getattr(importlib.import_module(module), name)()
    return _BUILT[factory]


def chunked(docs: DataFrame, key: str, limit: int, by_sentence: bool = True, factory: str | None = None) -> DataFrame:
    """(key, chunk_no, start, text): the whole text where it fits the limit, else sentence chunks or windows.

    The limit is in the tokens of the factory's model if it counts them: a text over it is cut at FILL of
    the limit by its own characters a token.  Without a count it is in characters.
    """
    text, n = F.col("text"), F.length("text")
    counted = F.length(text) if factory is None else _counted(factory)(text)
    known = docs.where(text.isNotNull()).select(key, "text", counted.alias("n_"))
    size = F.greatest(F.lit(1), F.floor(F.lit(limit * FILL) * n / F.greatest("n_", F.lit(1))).cast("int"))
    cut = chunking.packed(chunking.units(text), size) if by_sentence else chunking.windows(text, size, OVERLAP)
    whole = F.array(F.struct(F.lit(0).alias("start"), n.alias("end")))
    each = known.select(key, "text", F.posexplode(F.when(F.col("n_") <= limit, whole).otherwise(cut)).alias("chunk_no", "c_"))
    return each.select(key, F.col("chunk_no").cast("long").alias("chunk_no"), F.col("c_.start").cast("long").alias("start"), F.expr("substring(text, c_.start + 1, c_.end - c_.start)").alias("text"))


def _counted(factory: str):
    """A UDF text -> tokens by the model's own count, characters where it has none."""

    @F.arrow_udf("int")
    def counted(texts: pa.Array) -> pa.Array:
        count = getattr(built(factory), "count", len)
        return pa.array([count(t) for t in texts.to_pylist()], pa.int32())

    return counted


def _predicted(model: TokenModel, start: int, text: str) -> list[tuple[str, float, int, int]]:
    """The predictions of a chunk with offsets of the whole document; special tokens keep (0, 0)."""
    return [(tag, conf, *((0, 0) if s == e == 0 else (s + start, e + start))) for tag, conf, s, e in model.predict(text)]


def _each(chunks: DataFrame, key: str, factory: str, step, fields: dict[str, str]) -> DataFrame:
    """(key, chunk_no, fields) rows of ``step(predictions)`` for each chunk, in one pass."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = ", ".join([f"{key} {dict(chunks.dtypes)[key]}", "chunk_no long", *(f"{k} {t}" for k, t in fields.items())])
    kinds = to_arrow_schema(StructType.fromDDL(", ".join(f"{k} {t}" for k, t in fields.items())))

    def run(batches):
        model = built(factory)
        for b in batches:
            ids, numbers, rows = [], [], []
            for i, (n, start, text) in enumerate(zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))):
                for row in step(_predicted(model, start, text)):
                    ids.append(i)
                    numbers.append(n)
                    rows.append(row)
            columns = list(zip(*rows)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(ids, pa.int64())), pa.array(numbers, pa.int64()), *[pa.array(c, f.type) for c, f in zip(columns, kinds)]], names=[key, "chunk_no", *fields]
            )

    return chunks.select(key, "chunk_no", "start", "text").mapInArrow(run, schema)


def tokens(chunks: DataFrame, key: str, factory: str) -> DataFrame:
    """(key, chunk_no, tok_idx, tag, conf, cs, ce): the predictions for every token."""
    fields = {"tok_idx": "long", "tag": "string", "conf": "double", "cs": "long", "ce": "long"}
    return _each(chunks, key, factory, lambda found: [(k, *x) for k, x in enumerate(found)], fields)


def spans(chunks: DataFrame, key: str, factory: str) -> DataFrame:
    """(key, chunk_no, start, end, label, tokens, confidence): the predictions decoded where they are made."""
    fields = {"start": "long", "end": "long", "label": "string", "tokens": "long", "confidence": "double"}
    return _each(chunks, key, factory, tagging.decoded, fields)


def detect(docs: DataFrame, key: str, factory: str = "dimskog.operators.model:DictionaryModel", limit: int = 2000, by_sentence: bool = True) -> DataFrame:
    """Entities of a token model (columns of the entity schema): decoded, de-duplicated over chunks, repaired."""
    spans_ = spans(chunked(docs, key, limit, by_sentence, factory), key, factory).select(key, "start", "end", "label", "confidence")
    order = F.row_number().over(W.partitionBy(key).orderBy("start", "end", "label"))
    none = F.lit(None).cast("string")
    rows = spans_.distinct().select(
        key, order.cast("long").alias("seq"), F.lit("").alias("text"), "label", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"),
        F.lit("bert").alias("source"), "confidence", none.alias("generalized"), F.lit("high").alias("risk"),
    )
    kept = conflicts.greedy(rows, [key])
    one = F.struct("start", "end", "label", "confidence")
    per_doc = kept.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("es_"))
    fixed = docs.select(key, F.col("text").alias("body_")).join(per_doc, key).select(key, "body_", F.posexplode(tagging.repair(F.col("es_"), F.col("body_"))).alias("n_", "e_"))
    return fixed.select(
        key, F.col("n_").cast("long").alias("seq"), F.expr("substring(body_, e_.start + 1, e_.end - e_.start)").alias("text"), F.col("e_.label").alias("label"),
        F.col("e_.start").alias("start"), F.col("e_.end").alias("end"), F.lit("bert").alias("source"), F.lit(CONFIDENCE["bert"]).alias("confidence"),
        none.alias("generalized"), F.lit("high").alias("risk"),
    )


__all__ = ["ENTITY", "DictionaryModel", "TokenModel", "built", "chunked", "detect", "spans", "tokens"]
