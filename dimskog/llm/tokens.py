"""Encoding of texts with a public byte-level BPE tokenizer.

The tiktoken library encodes with a local rank file.  Long texts are first cut by a regular expression
at safe boundaries - before a single space between two solid characters, where the tokenizer's own
split pattern always ends a piece - so that every stretch is encoded on its own with the same result
as the whole.  Decoding joins the raw bytes of all ids before reading UTF-8, so characters that span
ids come back.

Defined results: null and empty texts give an empty list; no special tokens are ever produced (their
strings in a text are ordinary text); unbroken runs are encoded whole.
"""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dimskog.llm.corpus import map_batches
from dimskog.runtime import table

#: Where the rank files lie; a parameter, never copied into the package.
FOLDER = "/opt/tokenizers"
# Fixed value: the split pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 20_000
_SAFE = re.compile(r"(?<=\S) (?=\S)")


@cache
def encoding(folder: str, name: str):
    """The tokenizer ``name`` of ``folder``, built once a process."""
    import tiktoken

    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def stretches(text: str, size: int = LONG) -> list[str]:
    """The text cut at the first safe boundary after each ``size`` characters."""
    out, at = [], 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if not m:
            break
        out.append(text[at : m.start()])
        at = m.start()
    out.append(text[at:])
    return out


def encode(text: str | None, enc) -> list[int]:
    if not text:
        return []
    if len(text) <= LONG:
        return enc.encode_ordinary(text)
    return [i for s in stretches(text) for i in enc.encode_ordinary(s)]


def decode(ids: list[int], enc) -> str:
    """The text of a list of ids, by its raw bytes."""
    return b"".join(enc.decode_single_token_bytes(i) for i in ids).decode("utf-8")


def encoded(docs: DataFrame, folder: str = FOLDER, name: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, ids) of (doc_id, text)."""

    def make():
        enc = encoding(folder, name)

        def step(batch):
            parts = [np.array(encode(t, enc), dtype=np.int32) for t in batch.column(1).to_pylist()]  # 4 bytes an id while the batch is built
            bounds = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int32())
            return {"doc_id": batch.column(0), "ids": pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(parts)))}

        return step

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, ids array<int>")


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def decoded(spark: SparkSession, sf_dir: str, folder: str = FOLDER, name: str = "byte_bpe_50k") -> DataFrame:
    """doc_id and the text that its ids give back; '' for null and empty texts."""

    def make():
        enc = encoding(folder, name)

        def step(batch):
            return {"doc_id": batch.column(0), "text": [decode(x, enc) for x in batch.column(1).to_pylist()]}

        return step

    return map_batches(encoded(table(spark, sf_dir, "documents"), folder, name), make, "doc_id long, text string")


def sizes(docs: DataFrame, folder: str = FOLDER, name: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, source, n_tokens) of (doc_id, source, text)."""

    def make():
        enc = encoding(folder, name)

        def step(batch):
            return {"doc_id": batch.column(0), "source": batch.column(1), "n_tokens": [len(encode(t, enc)) for t in batch.column(2).to_pylist()]}

        return step

    return map_batches(docs.select("doc_id", "source", "text"), make, "doc_id long, source string, n_tokens int")
