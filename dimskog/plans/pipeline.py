"""The de-identification plan: stages gated by options, gathered into one row a document.

Stage order is the final tie-break: rule, model, language models, gazetteer, propagated.

Every model call is made once: its replies are cut at a reliable checkpoint before claims, errors and
reasoning are read from them.  All findings of a document are then gathered by one shuffle into an array
beside its text, and propagation, redaction plan, rewriting and audit are expressions of that row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimskog.operators import backend as llm
from dimskog.operators import conflicts, coreference, gazetteer, judge, redact, rules
from dimskog.runtime import cut
from dimskog.schema import CONFIDENCE, ENTITY_TYPE, placeholder_of

MODES = ("full", "no_bert", "llm_only")
FIELDS = conflicts.FIELDS
_NONE = f"ARRAY<{ENTITY_TYPE}>"


@dataclass(frozen=True)
class Options:
    """What a run does; unknown modes and backends are refused before any job starts."""

    mode: str = "full"
    backends: tuple[str, ...] = ("mock",)
    quasi_only: bool = False
    no_generalize: bool = False
    backstop: bool = False
    gazetteer: bool = True
    propagate: bool = True
    model: object | None = field(default=None, compare=False)
    judges: tuple[str, ...] = ()
    rounds: int = 2
    min_votes: int = 1
    generalize_backend: str | None = None
    thinking: bool = False
    transport: str | None = None

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"unknown mode {self.mode!r}; known: {', '.join(MODES)}")
        for name in {*self.backends, *self.judges, self.generalize_backend} - {None}:
            llm.check(name, self.transport)

    @property
    def detect_direct(self) -> bool:
        """Whether language models are asked for direct identifiers too."""
        return not self.quasi_only and (self.mode in ("llm_only", "no_bert") or self.backstop)

    @property
    def request(self) -> llm.Request:
        return llm.Request(self.detect_direct, thinking=self.thinking, omit_generalize=self.generalize_backend is not None)


def redact_by_rules(text: Column) -> Column:
    """A text with its rule findings replaced: one expression of a row, fit for streams."""
    spans = F.array_sort(F.transform(rules.accepted(text), lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), placeholder_of(e["label"]).alias("replacement"))))
    return F.when(text.isNotNull(), redact.splice(text, spans))


def rule_entities(docs: DataFrame, key: str) -> DataFrame:
    """Accepted rule findings of (key, text), in priority order."""
    each = docs.where("text is not null").select(key, F.posexplode(rules.accepted(F.col("text"))).alias("seq_", "e"))
    return each.select(key, F.col("seq_").cast("long").alias("seq"), *[F.col(f"e.{f}").alias(f) for f in FIELDS if f != "seq"])


def llm_entities(docs: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The claims of a language model as entities of the documents' own text."""
    return llm.resolve_all(docs, wanted, key).select(
        key, F.col("item").alias("seq"), "text", "label", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"),
        F.lit("llm").alias("source"), F.lit(CONFIDENCE["llm"]).alias("confidence"), "generalized", "risk",
    )


def backend_entities(docs: DataFrame, key: str, name: str, direct: bool, transport: str | None = None) -> DataFrame:
    return llm_entities(docs, llm.sweep(docs, key, name, direct, transport), key)


def gazetteer_entities(docs: DataFrame, key: str, names: DataFrame) -> DataFrame:
    hits = gazetteer.scan(docs, names, key)
    rows = hits.select(
        key, (F.col("start").cast("long") * 2**20 + F.col("end")).alias("seq"), "text", "label", "start", "end",
        F.lit("gazetteer").alias("source"), F.lit(CONFIDENCE["gazetteer"]).alias("confidence"), F.lit(None).cast("string").alias("generalized"), F.lit("high").alias("risk"),
    )
    return conflicts.greedy(rows, [key]).drop("rank")


# ---------------------------------------------------------------- the row of a document


def numbered(entities: Column) -> Column:
    """Entities with ``seq`` as their place in the list."""
    return F.transform(entities, lambda e, i: F.struct(*[(i + 1).cast("long").alias(f) if f == "seq" else e[f].alias(f) for f in FIELDS]))


def gathered(docs: DataFrame, key: str, stages: list[DataFrame], first: Column | None = None) -> DataFrame:
    """(key, text, entities): the findings of all stages beside each text, in stage order and each stage's own.

    ``first`` is an array of entities that comes before them, computed from the row itself.  Documents
    without findings have an empty array, null texts keep none.
    """
    base = docs.select(key, "text", (F.array().cast(_NONE) if first is None else F.coalesce(first, F.array().cast(_NONE))).alias("first_"))
    parts = [s.select(key, F.struct(F.lit(i).alias("stage"), F.col("seq").cast("long").alias("n"), conflicts.entity().alias("e")).alias("x_")) for i, s in enumerate(stages)]
    if not parts:
        return base.select(key, "text", numbered(F.col("first_")).alias("entities"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    found = rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("x_")), lambda x: x["e"]).alias("found_"))
    both = F.concat(F.col("first_"), F.coalesce("found_", F.array().cast(_NONE)))
    return base.join(found, key, "left").select(key, "text", numbered(F.when(F.col("text").isNotNull(), both).otherwise(F.array().cast(_NONE))).alias("entities"))


def with_mentions(docs: DataFrame, key: str, *others: str) -> DataFrame:
    """Documents (key, text, entities) whose entities have their further mentions behind them, as ``propagated``."""
    new = docs.withColumn("new_", coreference.new_mentions(F.col("text"), F.col("entities")))

    def clone(m: Column) -> Column:
        of = F.get(F.col("entities"), (m["seq"] - 1).cast("int"))  # seq is the place in the list
        own = {"text": F.substring(F.col("text"), m["start"] + 1, m["end"] - m["start"]), "start": m["start"], "end": m["end"], "source": F.lit("propagated")}
        return F.struct(*[own.get(f, of[f]).alias(f) for f in FIELDS])

    grown = F.concat(F.col("entities"), F.coalesce(F.transform("new_", clone), F.array().cast(_NONE)))
    return new.select(key, "text", numbered(grown).alias("entities"), *others)


def with_redaction(docs: DataFrame, no_generalize: bool) -> DataFrame:
    """Adds ``fragments`` and ``redacted`` to documents (key, text, entities)."""
    planned = docs.withColumn("fragments", F.when(F.col("text").isNotNull(), conflicts.fragments(F.col("entities"))))
    return planned.withColumn("redacted", redact.rewritten(F.col("text"), F.col("fragments"), no_generalize))


def exploded(docs: DataFrame, key: str) -> DataFrame:
    """(key, entity columns) of documents (key, entities)."""
    return docs.select(key, F.explode("entities").alias("e_")).select(key, *[F.col(f"e_.{f}").alias(f) for f in FIELDS])


def audit_of(docs: DataFrame, key: str, no_generalize: bool) -> DataFrame:
    """The audit rows of documents (key, entities), by position; no shuffle."""
    by_place = F.transform(F.array_sort(F.transform("entities", lambda e: F.struct(e["start"].alias("s"), e["seq"].alias("n"), e.alias("e")))), lambda x: x["e"])
    each = docs.select(key, F.posexplode(by_place).alias("n_", "e_"))
    replaced = redact.replacement(F.col("e_.text"), F.col("e_.label"), F.col("e_.generalized"), no_generalize)
    return each.select(
        key, (F.col("n_") + 1).cast("long").alias("position"), F.col("e_.text").alias("original"), F.col("e_.label").alias("label"), F.col("e_.start").cast("long").alias("start_pos"),
        F.col("e_.end").cast("long").alias("end_pos"), F.col("e_.source").alias("source"), F.col("e_.risk").alias("risk"), replaced.alias("generalized_to"),
    )


# ---------------------------------------------------------------- calls


class Calls:
    """The replies of a run, kept for their claims, errors and reasoning."""

    def __init__(self, key: str, transport: str | None):
        self.key, self.transport, self.kept = key, transport, []

    def keep(self, found: DataFrame, name: str, task: str) -> DataFrame:
        """Makes the calls of a plan, once, and keeps their replies."""
        found = cut(found)
        self.kept.append(found.select(self.key, F.lit(name).alias("backend"), F.lit(task).alias("task"), "raw", "error"))
        return found

    def rows(self, spark_docs: DataFrame) -> DataFrame:
        if not self.kept:
            return spark_docs.select(self.key, *[F.lit(None).cast("string").alias(c) for c in ("backend", "task", "raw", "error")]).limit(0)
        out = self.kept[0]
        for k in self.kept[1:]:
            out = out.unionByName(k)
        return out


def generalized(docs: DataFrame, found: list[DataFrame], key: str, options: Options, calls: Calls) -> list[DataFrame]:
    """The language models' findings with the generalizations of the separate stage, one call a document.

    Its proposals replace whatever the findings came with; a target without a proposal has none.
    """
    from functools import reduce

    marked = reduce(DataFrame.unionByName, [f.withColumn("stage_", F.lit(i)) for i, f in enumerate(found)])
    marked = cut(marked.withColumn("n_", F.col("stage_") * F.lit(2**40) + F.col("seq")))
    targets = llm.generalize_targets(marked).select(key, F.col("n_").alias("seq"), "text", "label")
    asked = targets.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text", "label"))), lambda x: F.struct(x["text"].alias("text"), x["label"].alias("label"))).alias("spans"))
    said = calls.keep(llm.replies(docs.join(asked, key), key, options.generalize_backend, "generalize", options.request, calls.transport), options.generalize_backend, "generalize")
    wanted = targets.join(said.where("raw is not null").select(key), key, "left_semi")  # a call that failed leaves what there was
    proposed = llm.apply_generalizations(wanted, said.where("raw is not null").select(key, "raw"), [key]).select(key, F.col("seq").alias("n_"), F.col("generalized").alias("g_"), F.lit(True).alias("asked_"))
    whole = marked.join(proposed, [key, "n_"], "left").withColumn("generalized", F.when(F.col("asked_"), F.col("g_")).otherwise(F.col("generalized")))
    return [whole.where(F.col("stage_") == i).drop("stage_", "n_", "g_", "asked_") for i in range(len(found))]


def judged(docs: DataFrame, key: str, options: Options, calls: Calls) -> tuple[DataFrame, DataFrame]:
    """(documents after the last round, flags that are left) of documents (key, text, entities, fragments, redacted).

    In each round the panel reviews the redacted texts still open; the quotes it flags go back to every
    backend as targets, findings join the document's list, and propagation and redaction run again.
    """
    def review(open_: DataFrame) -> DataFrame:
        said = []
        for n, name in enumerate(options.judges):
            r = calls.keep(llm.replies(open_.select(key, F.col("redacted").alias("text")), key, name, "judge", options.request, calls.transport), name, "judge")
            said.append(llm.flags(r.where("raw is not null"), key, name, n))
        out = said[0]
        for s in said[1:]:
            out = out.unionByName(s)
        return out

    def retry(open_: DataFrame, flags: DataFrame) -> DataFrame:
        quotes = flags.groupBy(key).agg(F.array_sort(F.collect_list("quote")).alias("quotes"))
        asked = open_.join(quotes, key).select(key, F.col("redacted").alias("text"), "quotes", F.array_distinct(F.transform("entities", lambda e: e["label"])).alias("labels"))
        again = llm.Request(True, thinking=options.thinking)
        stages = [
            llm_entities(open_.select(key, "text"), llm.sweep_claims(calls.keep(llm.replies(asked, key, name, "detect", again, calls.transport), name, "detect").withColumn("chunk", F.lit(0).cast("long")), key), key)
            for name in options.backends
        ]
        more = gathered(open_.select(key, "text", "entities"), key, stages, F.lit(None).cast(_NONE)).select(key, F.col("entities").alias("more_"))
        grown = open_.select(key, "text", "entities").join(more, key).select(key, "text", numbered(F.concat("entities", "more_")).alias("entities"))
        return with_redaction(with_mentions(grown, key) if options.propagate else grown, options.no_generalize)

    out, left = judge.rounds(docs, review, retry, key, options.rounds, options.min_votes)
    return out, left


def deidentify(docs: DataFrame, key: str, options: Options = Options(), names: DataFrame | None = None) -> dict[str, DataFrame]:
    """De-identifies documents (key, text); a document is one row a key.

    Gives ``entities``, ``fragments``, ``redacted`` (with ``needs_review``), ``audit``, ``flags`` of the
    judges that are left, ``calls`` (key, backend, task, raw, error), ``errors`` (those that failed) and
    ``reasoning``.  A document any of whose calls failed needs review, whatever the judges say.
    """
    docs = docs.select(key, "text")
    calls = Calls(key, options.transport)
    by_rules = rules.accepted(F.col("text")) if options.mode != "llm_only" else None
    before: list[DataFrame] = []
    if options.mode == "full" and options.model is not None:
        before.append(cut(options.model(docs, key)))
    known = gathered(docs, key, before, by_rules)
    if options.backstop and (by_rules is not None or before):
        known = cut(with_redaction(known, options.no_generalize))
        scan = known.select(key, F.col("redacted").alias("text"), F.array_distinct(F.transform("entities", lambda e: e["label"])).alias("labels"))
    else:
        scan = known.select(key, "text", F.array_distinct(F.transform("entities", lambda e: e["label"])).alias("labels"))
    found = []
    for name in options.backends:  # every backend sees the same text, none sees another's findings
        said = calls.keep(llm.sweep_replies(scan, key, name, options.request, options.transport), name, "detect")
        found.append(llm_entities(docs, llm.sweep_claims(said, key), key))
    if options.generalize_backend and found:
        found = generalized(docs, found, key, options, calls)
    stages = [*before, *found]
    if options.gazetteer and names is not None and options.mode != "llm_only":
        stages.append(gazetteer_entities(docs, key, names))
    whole = gathered(docs, key, stages, by_rules)
    if options.propagate:
        whole = with_mentions(whole, key)
    whole = cut(with_redaction(whole, options.no_generalize))
    flags = None
    if options.judges:
        whole, flags = judged(whole, key, options, calls)
        whole, flags = cut(whole), cut(flags)
    said = calls.rows(docs)
    errors = said.where("error is not null")
    doubted = errors.select(key) if flags is None else errors.select(key).unionByName(flags.select(key))
    marked = whole.select(key, "text", "redacted").join(doubted.distinct().withColumn("doubt_", F.lit(True)), key, "left")
    return {
        "documents": whole,
        "entities": exploded(whole, key),
        "fragments": whole.select(key, F.explode("fragments").alias("f")).select(key, "f.*"),
        "redacted": marked.select(key, "text", "redacted", F.coalesce("doubt_", F.lit(False)).alias("needs_review")),
        "audit": audit_of(whole, key, options.no_generalize),
        "flags": flags if flags is not None else docs.select(key, *[F.lit(None).cast("string").alias(c) for c in ("quote", "reason", "judge")], F.lit(None).cast("long").alias("votes")).limit(0),
        "calls": said,
        "errors": errors,
        "reasoning": said.select(key, "backend", "task", llm.reasoning(F.col("raw")).alias("reasoning")).where("reasoning <> ''"),
    }
