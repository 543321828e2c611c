"""Dictionary of names and places: patterns from the rows, and their occurrences in text.

A pattern starts and ends with a letter or digit and must stand between others, so an occurrence is a
run of whole tokens.  The scan is therefore an equi-join: every token n-gram of a text (n up to the
longest pattern, which is counted) against the patterns.  Nothing is broadcast unless the patterns are
below the session's broadcast limit.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimskog.functions.scan import array_of, lists
from dimskog.functions.text import strip

# Label of each category of the gazetteer table.
CATEGORY_LABELS = {
    "Administrative_Entity": "private_address", "Street": "private_address", "Hospital": "private_address", "School": "private_address",
    "Given_Name": "private_person", "Family_Name": "private_person",
    "given_name": "private_person", "family_name": "private_person", "place": "private_address", "hospital": "private_address", "street": "private_address",
}
# Category words that informal names leave out.
SUFFIXES = (
    "universitetssjukhuset", "universitetssjukhus", "sjukhuset", "sjukhus", "lasarettet", "lasarett", "kommunen", "kommun", "länet", "län",
    "skolan", "skola", "gymnasiet", "gymnasium", "högskolan", "högskola", "universitetet", "universitet",
    "hospital", "school", "municipality", "county", "university", "college",
)
# Words that are no name by themselves.
GENERIC = ("västra", "östra", "norra", "södra", "övre", "nedre", "stora", "lilla", "nya", "gamla")
SHORTEST = 4


def patterns(rows: DataFrame) -> DataFrame:
    """(key, name, label) of a gazetteer: Swedish before English label, each before its short form.

    The first registration of a lower-case key wins, by row id and variant.  Null labels are skipped,
    names under four characters never register.
    """
    label = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in CATEGORY_LABELS.items() for x in kv]), F.coalesce("category", F.lit(""))), F.lit("private_address"))
    names = rows.select("wikidata_id", label.alias("label"), F.posexplode(F.array("label_sv", "label_en")).alias("variant", "raw")).where("raw is not null")
    names = names.withColumn("name", strip(F.col("raw")))
    words = F.split("name", r"(?U)\s+")
    last = F.regexp_replace(F.lower(F.element_at(words, -1)), r"^[.,]+|[.,]+$", "")
    short = F.array_join(F.slice(words, 1, F.size(words) - 1), " ")
    names = names.withColumn(
        "short",
        F.when((F.size(words) >= 2) & last.isin(*SUFFIXES) & (F.length(short) >= SHORTEST) & ~((F.size(words) == 2) & F.lower(short).isin(*GENERIC)), short),
    )
    both = names.select("wikidata_id", "label", F.posexplode(F.array(F.when(F.length("name") >= SHORTEST, F.col("name")), F.col("short"))).alias("form", "name"), "variant").where("name is not null")
    first = W.partitionBy("key").orderBy("wikidata_id", "variant", "form", "name")
    return both.withColumn("key", F.lower("name")).withColumn("n", F.row_number().over(first)).where("n = 1").select("key", "name", "label")


_TOKEN = re.compile(r"[^\W_]+")


#: Bits of the filter on first tokens: a fixed size, whatever the gazetteer's.
FILTER_BITS = 1 << 20


def _first_tokens(bits: list[int]) -> bytes:
    """The filter as packed bits."""
    out = np.zeros(FILTER_BITS, dtype=bool)
    out[bits] = True
    return np.packbits(out).tobytes()


def _grams(most: int, beyond: int, allowed: bytes):
    """A UDF text -> (start, end, text, after) of every run of 1..most tokens that may begin a pattern, with what follows it.

    A run begins upper-case and with a token that the filter lets through; tokens beyond Latin-1, whose
    lower case may depend on the engine, always pass.
    """
    fields = {"start": "int", "end": "int", "text": "string", "after": "string"}

    @F.arrow_udf(array_of(fields))
    def grams(texts: pa.Array) -> pa.Array:
        passes: dict[str, bool] = {}

        def may_begin(token: str) -> bool:
            ok = passes.get(token)
            if ok is None:
                bit = zlib.crc32(token.lower().encode()) % FILTER_BITS
                ok = passes[token] = max(token) > "\xff" or bool(allowed[bit >> 3] >> (7 - (bit & 7)) & 1)
            return ok

        out = []
        for t in texts.to_pylist():
            spans = [m.span() for m in _TOKEN.finditer(t)] if t else []
            out.append(None if t is None else [(s, e, t[s:e], t[e : e + beyond]) for i, (s, z) in enumerate(spans) if t[s].isupper() and may_begin(t[s:z]) for _, e in spans[i : i + most]])
        return lists(out, fields)

    return grams


def scan(docs: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """(key, start, end, text, label) of every occurrence between non-alphanumerics that begins upper-case.

    Patterns of any length match, also those that end in signs ("Hotellet (gamla)"); overlapping hits are
    all returned.  The longest pattern and the longest such ending are counted over all patterns.
    """
    core = F.regexp_replace("key", r"[^\p{L}\p{N}]+$", "")
    known = names.select(core.alias("k_"), F.expr("substring(key, length(regexp_replace(key, '[^\\\\p{L}\\\\p{N}]+$', '')) + 1)").alias("tail_"), "label")
    bit = (F.crc32(F.regexp_extract("k_", r"^[\p{L}\p{N}]+", 0)) % FILTER_BITS).cast("int")
    n_tokens = F.size(F.regexp_extract_all("k_", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    most, beyond, bits = known.agg(F.max(n_tokens), F.max(F.length("tail_")), F.collect_set(bit)).first()  # at most FILTER_BITS numbers
    each = docs.where("text is not null").select(key, F.explode(_grams(most or 0, beyond + 1 if beyond else 0, _first_tokens(bits))(F.col("text"))).alias("g_"))
    found = each.select(key, "g_.start", "g_.end", "g_.text", "g_.after").withColumn("k_", F.lower("text"))
    whole = F.lower("after").startswith(F.col("tail_")) & ~F.expr("substring(after, length(tail_) + 1, 1)").rlike(r"[\p{L}\p{N}]")
    hits = found.join(known, "k_").where((F.col("tail_") == "") | whole)
    return hits.select(key, "start", (F.col("end") + F.length("tail_")).alias("end"), F.concat("text", F.expr("substring(after, 1, length(tail_))")).alias("text"), "label")
