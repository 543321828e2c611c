"""Cutting documents for models: sentence units, packed chunks, windows and training chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimskog.functions.scan import scanner
from dimskog.functions.text import spans

# Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = ("dr", "prof", "fil", "med", "jur", "ex", "etc", "kl", "nr", "sid")
UNIT = "array<struct<start:int,end:int>>"


def units(text: Column) -> Column:
    """Sentence units inside lines as (start, end); they cover the text and never split a line's sentence.

    A run of . ! ? before white space or the line's end closes a unit unless the word before it in the
    unit is an abbreviation.  Null text gives null, empty text an empty array.
    """
    lines = spans(text, r"[^\n]+\n?|\n")

    def of_line(line: Column) -> Column:
        stops = spans(line["text"], r"(?U)[.!?]+(?=\s|$)")
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(UNIT).alias("out"))

        def step(acc: Column, m: Column) -> Column:
            before = F.substring(line["text"], acc["at"] + 1, m["start"] - acc["at"])
            word = F.lower(F.regexp_extract(before, r"([\p{L}\p{N}_]+)\.?$", 1))
            one = F.struct((line["start"] + acc["at"]).alias("start"), (line["start"] + m["end"]).alias("end"))
            return F.when(word.isin(*ABBREVIATIONS), acc).otherwise(F.struct(m["end"].alias("at"), F.concat(acc["out"], F.array(one)).alias("out")))

        def finish(acc: Column) -> Column:
            rest = F.array(F.struct((line["start"] + acc["at"]).alias("start"), line["end"].alias("end")))
            return F.when(acc["at"] < F.length(line["text"]), F.concat(acc["out"], rest)).otherwise(acc["out"])

        return F.aggregate(stops, zero, step, finish)

    return F.flatten(F.transform(lines, of_line))


def packed(parts: Column, most: int | Column) -> Column:
    """Units packed in order into chunks of at most ``most`` characters; a longer unit is a chunk alone."""
    zero = F.struct(F.lit(None).cast("struct<start:int,end:int>").alias("now"), F.array().cast(UNIT).alias("out"))

    def step(acc: Column, u: Column) -> Column:
        fits = u["end"] - acc["now"]["start"] <= most
        grown = F.struct(F.struct(acc["now"]["start"].alias("start"), u["end"].alias("end")).alias("now"), acc["out"].alias("out"))
        closed = F.struct(u.alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out"))
        first = F.struct(u.alias("now"), acc["out"].alias("out"))
        return F.when(acc["now"].isNull(), first).when(fits, grown).otherwise(closed)

    return F.aggregate(parts, zero, step, lambda acc: F.when(acc["now"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(acc["now"]))))


def windows(text: Column, size: int | Column, overlap: int) -> Column:
    """Character windows with an overlap; the last one is the first to reach the end."""
    size = F.lit(size) if isinstance(size, int) else size
    step = F.greatest(size - overlap, F.lit(1))
    n = F.length(text)
    count = F.when(n <= 0, 0).otherwise(F.greatest(F.lit(1), F.ceil((n - size) / step).cast("int") + 1))
    index = F.slice(F.sequence(F.lit(0), F.greatest(count, F.lit(1))), F.lit(1), count)
    return F.transform(index, lambda i: F.struct((i * step).cast("int").alias("start"), F.least(i * step + size, n).cast("int").alias("end")))


# Fixed value: what ends a training chunk.
CHUNK_BREAK = r"\n|(?<=\.)\s+"
_breaks = scanner([("", CHUNK_BREAK)])


def training_chunks(rows: DataFrame, key: str) -> DataFrame:
    """(key, chunk_no, start, end, n_spans, spans) of (key, source_text, privacy_mask).

    Cuts follow a newline or the white space after a full stop; a chunk keeps the spans that lie wholly
    inside, counted from its start.  Blank chunks are left out; null masks have no spans.
    """
    text = F.col("source_text")
    at = F.transform(_breaks(text), lambda s: s["end"])
    cuts = F.concat(F.array(F.lit(0)), at, F.array(F.length(text)))
    found = rows.where(text.isNotNull()).select(key, "source_text", "privacy_mask", cuts.alias("cuts_"))
    pairs = F.transform(F.slice("cuts_", F.lit(1), F.size("cuts_") - 1), lambda s, i: F.struct(s.alias("start"), F.get("cuts_", i + 1).alias("end")))
    chunks = found.select(key, "source_text", "privacy_mask", F.posexplode(pairs).alias("chunk_no", "c"))
    piece = F.expr("substring(source_text, c.start + 1, c.end - c.start)")
    inside = F.filter(F.coalesce("privacy_mask", F.array().cast("array<struct<start_pos:int,end_pos:int,label:string>>")), lambda s: (s["start_pos"] >= F.col("c.start")) & (s["end_pos"] <= F.col("c.end")))
    moved = F.transform(inside, lambda s: F.struct((s["start_pos"] - F.col("c.start")).alias("start_pos"), (s["end_pos"] - F.col("c.start")).alias("end_pos"), s["label"].alias("label")))
    return chunks.where(piece.rlike(r"(?U)\S")).select(
        key, F.col("chunk_no").cast("long").alias("chunk_no"), F.col("c.start").cast("long").alias("start_pos"), F.col("c.end").cast("long").alias("end_pos"), moved.alias("spans")
    )
