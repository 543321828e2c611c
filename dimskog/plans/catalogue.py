"""All queries of the core operators, by name.  Every query runs over whole tables."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dimskog.operators import backend, chunking, conflicts, coreference, gazetteer, judge, model, redact, review, rules, scoring, tagging, training
from dimskog.plans import oracle, pipeline
from dimskog.plans.words import NAMED, NOTE_WORDS, UNSURE
from dimskog.runtime import scratch, spread, table
from dimskog.schema import CONFIDENCE, SOURCES, taxonomy
from dimskog.sources import files

RUN = ["run_label", "note"]


# ---------------------------------------------------------------- inputs


def _notes(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "notes").select("note_id", "doc_id", "text", "received_at"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """(note, text): the last delivery of each note that has a text."""
    last = F.struct(F.coalesce("received_at", F.to_timestamp(F.lit("1970-01-01"))), "note_id")
    return _notes(spark, d).where("text is not null").groupBy(F.col("doc_id").alias("note")).agg(F.max_by("text", last).alias("text"))


def _entities(spark: SparkSession, d: str) -> DataFrame:
    """The audit table as entities of (run_label, note)."""
    conf = F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv])
    return table(spark, d, "audit").select(
        *RUN, F.col("audit_id").alias("seq"), F.col("original").alias("text"), "label", F.col("start_pos").cast("int").alias("start"), F.col("end_pos").cast("int").alias("end"),
        "source", F.coalesce(F.try_element_at(conf, F.col("source")), F.lit(1.0)).alias("confidence"), F.col("generalized_to").alias("generalized"), "risk",
    )


def _run_texts(spark: SparkSession, d: str) -> DataFrame:
    """(run_label, note, text) of every run of a note."""
    return table(spark, d, "audit").select(*RUN).distinct().join(_texts(spark, d), "note").select(*RUN, "text")


def _long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


# ---------------------------------------------------------------- detection


def rule_spans(spark: SparkSession, d: str) -> DataFrame:
    out = rules.rule_spans(_notes(spark, d), "note_id").withColumnsRenamed({"start": "start_pos", "end": "end_pos"})
    return _long(out, "pattern_no", "start_pos", "end_pos")


def rule_spans_of(number: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return rule_spans(spark, d).where(F.col("pattern_no") == number).select("note_id", "start_pos", "end_pos", "text")

    return run


def rule_entities(spark: SparkSession, d: str) -> DataFrame:
    out = pipeline.rule_entities(_notes(spark, d), "note_id").withColumnsRenamed({"start": "start_pos", "end": "end_pos"})
    return _long(out.select("note_id", "seq", "label", "start_pos", "end_pos", "text"), "start_pos", "end_pos")


def rule_label_counts(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.rule_entities(_notes(spark, d), "note_id").groupBy("label").agg(F.count("*").alias("n"))


def redact_notes(spark: SparkSession, d: str) -> DataFrame:
    return _notes(spark, d).select("note_id", pipeline.redact_by_rules(F.col("text")).alias("redacted"))


def gazetteer_patterns(spark: SparkSession, d: str) -> DataFrame:
    return gazetteer.patterns(table(spark, d, "gazetteer"))


def gazetteer_spans(spark: SparkSession, d: str) -> DataFrame:
    out = gazetteer.scan(_notes(spark, d), gazetteer_patterns(spark, d), "note_id").withColumnsRenamed({"start": "start_pos", "end": "end_pos"})
    return _long(out, "start_pos", "end_pos")


def deidentified(part: str, options: pipeline.Options = pipeline.Options()):
    def run(spark: SparkSession, d: str) -> DataFrame:
        docs = _notes(spark, d).select("note_id", "text")
        return pipeline.deidentify(docs, "note_id", options, gazetteer_patterns(spark, d))[part]

    return run


class NoteBackend(backend.MockBackend):
    """A stand-in that finds NOTE_WORDS as whole words, flags long runs of digits, and settles what it is asked about as secrets."""

    def detect(self, text: str, request: backend.Request = backend.Request()) -> str:
        if request.quotes:
            return backend.json_of([{"text": q, "label": "secret", "risk": "high"} for q in request.quotes])
        words = {w: v for w, v in NOTE_WORDS.items() if re.search(rf"(?<![^\W_]){w}(?![^\W_])", text)}
        return backend.json_of([{"text": w, "label": v[0], "risk": v[1]} | ({} if request.omit_generalize else {"generalize": v[2]}) for w, v in words.items()])

    def judge(self, redacted_text: str, thinking: bool = False) -> str:
        return "<think>siffror</think>" + backend.json_of([{"quote": q, "reason": "siffror"} for q in dict.fromkeys(re.findall(r"(?<![^\W_])[0-9]{6,}(?![^\W_])", redacted_text))])


backend.register("note_words", "dimskog.plans.catalogue:NoteBackend")


def word_entities(spark: SparkSession, d: str) -> DataFrame:
    """Findings of the stand-in language model over all notes, whole texts at once."""
    out = pipeline.backend_entities(_notes(spark, d).select("note_id", "text"), "note_id", "note_words", True).drop("confidence")
    return _long(out, "start", "end").withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


def mock_entities(spark: SparkSession, d: str) -> DataFrame:
    """Findings of the mock over all documents, in sentence chunks."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return _long(pipeline.backend_entities(docs, "doc_id", "mock", False).drop("confidence"), "start", "end").withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


#: Rules and the stand-in alone: what SQL can follow to the end.
PLAIN = pipeline.Options(mode="no_bert", backends=("note_words",), gazetteer=False, propagate=False)


def plain_generalized(spark: SparkSession, d: str) -> DataFrame:
    """Findings of the stand-in with the proposals of the separate generalization stage, and how many are filled."""
    options = replace(PLAIN, generalize_backend="note_words")
    e = deidentified("entities", options)(spark, d).where("source = 'llm'")
    return e.groupBy("label", "generalized").agg(F.count("*").alias("n"), F.count("generalized").alias("filled"))


def judged_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes after the judge's rounds: whether they need review, what runs of digits are left, and secrets found by retry."""
    options = replace(PLAIN, judges=("note_words",))
    docs = _notes(spark, d).select("note_id", "text")
    out = pipeline.deidentify(docs, "note_id", options)
    secrets = out["entities"].where("label = 'secret'").groupBy("note_id").agg(F.count("*").alias("n"))
    left = F.col("redacted").rlike(r"(?<![\p{L}\p{N}])[0-9]{6,}(?![\p{L}\p{N}])")
    return out["redacted"].join(secrets, "note_id", "left").select("note_id", "needs_review", left.alias("digits_left"), (F.coalesce("n", F.lit(0)) > 0).alias("retried"))


def note_model() -> model.DictionaryModel:
    """A small dictionary model for the notes: some given names, places, and a word it is unsure of."""
    return model.DictionaryModel({w: (c, 0.6 if w in UNSURE else 0.96) for w, c in NAMED.items()})


def model_entities(spark: SparkSession, d: str) -> DataFrame:
    """Findings of the stand-in token model over all notes, in sentence chunks."""
    out = model.detect(_notes(spark, d).select("note_id", "text"), "note_id", "dimskog.plans.catalogue:note_model").withColumnsRenamed({"start": "start_pos", "end": "end_pos"})
    return _long(out.select("note_id", "seq", "text", "label", "start_pos", "end_pos"), "start_pos", "end_pos")


# ---------------------------------------------------------------- conflicts and rewriting


def greedy_accept(spark: SparkSession, d: str) -> DataFrame:
    out = conflicts.greedy(_entities(spark, d), RUN).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})
    return _long(out.select(*RUN, "rank", "seq", "label", "start_pos", "end_pos", "generalized"), "start_pos", "end_pos")


def redaction_plan(spark: SparkSession, d: str) -> DataFrame:
    out = conflicts.plan(_entities(spark, d), RUN).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})
    return _long(out.select(*RUN, "seq", "label", "source", "start_pos", "end_pos", "whole", "generalized"), "start_pos", "end_pos")


def replacements(no_generalize: bool):
    def run(spark: SparkSession, d: str) -> DataFrame:
        e = _entities(spark, d)
        return e.select(F.col("seq").alias("audit_id"), redact.replacement(F.col("text"), F.col("label"), F.col("generalized"), no_generalize).alias("replacement"))

    return run


def age_decades(spark: SparkSession, d: str) -> DataFrame:
    return _entities(spark, d).select(F.col("seq").alias("audit_id"), redact.age_range(F.col("text")).alias("age_range"))


def redacted_runs(spark: SparkSession, d: str) -> DataFrame:
    return redact.redact_all(_run_texts(spark, d), _entities(spark, d), RUN).select(*RUN, "redacted")


def audit_log(spark: SparkSession, d: str) -> DataFrame:
    return redact.audit(_entities(spark, d), RUN)


def propagated(spark: SparkSession, d: str) -> DataFrame:
    return coreference.propagate(_run_texts(spark, d), _entities(spark, d), RUN).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


def stage_counts(spark: SparkSession, d: str) -> DataFrame:
    return _entities(spark, d).groupBy("run_label", "source").agg(F.count("*").alias("n"))


def union_stages(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d)
    return backend.union_stages([e.where(F.col("source") == s) for s in SOURCES], RUN).select(*RUN, "seq", "source", "label", F.col("start").cast("long").alias("start_pos"))


def taxonomy_table(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy(spark)


# ---------------------------------------------------------------- language-model contract


def generalize_targets(spark: SparkSession, d: str) -> DataFrame:
    return backend.generalize_targets(_entities(spark, d)).select(F.col("seq").alias("audit_id"), "label")


def _llm_claims(spark: SparkSession, d: str) -> DataFrame:
    """Findings of the language model as a raw reply a run and note, parsed again."""
    e = _entities(spark, d).where("source = 'llm' and text is not null")
    one = F.struct("seq", F.to_json(F.struct("text", "label", "risk", F.col("generalized").alias("generalize"))).alias("j"))
    raw = e.groupBy(*RUN).agg(F.concat(F.lit("<think>[{}]</think>```json["), F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["j"]), ","), F.lit("]```")).alias("raw"))
    key = F.concat_ws("|", *RUN).alias("doc")
    return backend.claims(raw.select(key, "raw"), "doc")


def llm_claims(spark: SparkSession, d: str) -> DataFrame:
    return _llm_claims(spark, d)


def llm_resolved(spark: SparkSession, d: str) -> DataFrame:
    docs = _run_texts(spark, d).select(F.concat_ws("|", *RUN).alias("doc"), "text")
    return backend.resolve_all(docs, _llm_claims(spark, d), "doc").withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


def token_budgets(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("n_chars is not null")
    tokens = F.ceil(F.col("n_chars") / 4).cast("long")
    return docs.select("doc_id", *[backend.token_budget(tokens, F.lit(q), F.lit(x)).cast("long").alias(n) for n, q, x in (("full", 0, True), ("quasi", 0, False), ("targeted", 5, False))])


def quantization_tiers(spark: SparkSession, d: str) -> DataFrame:
    """The tier of every registered chat model on accelerators of usual sizes, and on none."""
    sizes = ", ".join(f"('{name}', {billions}D)" for name, (_, _, billions) in backend.REGISTRY.items())
    grid = spark.sql(f"SELECT backend, params_b, vram FROM VALUES {sizes} AS r(backend, params_b) LATERAL VIEW explode(array(CAST(null AS DOUBLE), 8D, 16D, 24D, 40D, 48D, 80D)) v AS vram")
    return grid.select("backend", "vram", backend.quantization(F.col("vram"), F.col("params_b")).alias("tier"))


# ---------------------------------------------------------------- judge


def _flags(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d)
    return e.select("note", "seq", F.col("source").alias("judge"), F.concat_ws(" ", F.coalesce("text", F.lit("")), F.col("generalized")).alias("quote"), F.col("label").alias("reason"))


def judge_panel(spark: SparkSession, d: str) -> DataFrame:
    return judge.panel(_flags(spark, d), "note")


def judge_votes(spark: SparkSession, d: str) -> DataFrame:
    return judge.panel(_flags(spark, d), "note", 2)


def judge_first_flags(spark: SparkSession, d: str) -> DataFrame:
    return judge.first_flags(_flags(spark, d), "note").select("note", "seq", "judge", "quote")


def needs_review(spark: SparkSession, d: str) -> DataFrame:
    return judge.needs_review(_texts(spark, d), judge_panel(spark, d), "note")


# ---------------------------------------------------------------- chunking


def sentence_units(spark: SparkSession, d: str) -> DataFrame:
    each = _notes(spark, d).where("text is not null").select("note_id", F.posexplode(chunking.units(F.col("text"))).alias("unit_no", "u"))
    return each.select("note_id", F.col("unit_no").cast("long").alias("unit_no"), F.col("u.start").cast("long").alias("start_pos"), F.col("u.end").cast("long").alias("end_pos"))


def sentence_chunks(spark: SparkSession, d: str) -> DataFrame:
    packed = chunking.packed(chunking.units(F.col("text")), backend.CHUNK)
    each = _notes(spark, d).where("text is not null").select("note_id", F.posexplode(packed).alias("chunk_no", "c"))
    return each.select("note_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.col("c.start").cast("long").alias("start_pos"), F.col("c.end").cast("long").alias("end_pos"))


def char_windows(spark: SparkSession, d: str) -> DataFrame:
    each = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(chunking.windows(F.col("text"), 1000, 50)).alias("window_no", "w"))
    return each.select("doc_id", F.col("window_no").cast("long").alias("window_no"), F.col("w.start").cast("long").alias("start_pos"), F.col("w.end").cast("long").alias("end_pos"))


def training_chunks(spark: SparkSession, d: str) -> DataFrame:
    out = chunking.training_chunks(spread(table(spark, d, "sv_pure3").select("row_id", "source_text", "privacy_mask")), "row_id")
    shown = F.transform("spans", lambda x: F.concat_ws(":", x["start_pos"].cast("string"), x["end_pos"].cast("string"), F.coalesce(x["label"], F.lit(""))))
    return out.withColumn("n_spans", F.size("spans").cast("long")).withColumn("spans", F.array_join(shown, ","))


# ---------------------------------------------------------------- tags and metrics


def _masks(spark: SparkSession, d: str) -> DataFrame:
    """(row_id, source_text, spans): each training row with its mask by category."""
    one = lambda m: F.struct(m["start_pos"].alias("start"), m["end_pos"].alias("end"), tagging.mapped(m["label"], tagging.MASK).alias("category"))
    return spread(table(spark, d, "sv_pure3").select("row_id", "source_text", F.transform("privacy_mask", one).alias("spans")))


def token_tags(spark: SparkSession, d: str) -> DataFrame:
    each = _masks(spark, d).select("row_id", F.explode(tagging.tags(F.col("source_text"), F.col("spans"))).alias("t"))
    return each.select("row_id", "t.*")


def _decoded(spark: SparkSession, d: str) -> DataFrame:
    """Tags and back, text by text: (row_id, start, end, label, tokens, confidence)."""
    each = _masks(spark, d).select("row_id", F.explode(tagging.decode(tagging.tags(F.col("source_text"), F.col("spans")))).alias("s"))
    return each.select("row_id", "s.*")


def decoded_spans(spark: SparkSession, d: str) -> DataFrame:
    out = _decoded(spark, d)
    return out.select("row_id", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "label", "tokens")


def model_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of the stand-in token model that carry a tag, and whether it is sure enough to count."""
    notes = model.chunked(_notes(spark, d).select("note_id", "text"), "note_id", 2000)
    t = model.tokens(notes, "note_id", "dimskog.plans.catalogue:note_model").where("tag <> 'O'")
    return t.groupBy("tag").agg(F.count("*").alias("n"), F.count_if(F.col("conf") >= tagging.LOWEST_CONFIDENCE).alias("counted"))


def _gold_spans(spark: SparkSession, d: str) -> DataFrame:
    each = _masks(spark, d).where("source_text is not null").select("row_id", F.explode("spans").alias("m")).where("m.category is not null")
    return each.select("row_id", F.col("m.start").cast("long").alias("start"), F.col("m.end").cast("long").alias("end"), tagging.mapped(F.col("m.category"), tagging.MODEL).alias("label"))


def f_scores(by_label: bool):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return training.f_scores(_gold_spans(spark, d), _decoded(spark, d), ["row_id"], by_label)

    return run


def ner_report(spark: SparkSession, d: str) -> DataFrame:
    return training.report(f_scores(True)(spark, d))


def fragment_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(table(spark, d, "sv_pure3").where("source_text is not null and privacy_mask is not null").select("row_id", "source_text", "privacy_mask"))
    label = lambda m: F.coalesce(tagging.mapped(tagging.mapped(m["label"], tagging.MASK), tagging.MODEL), m["label"])
    spans = F.transform("privacy_mask", lambda m: F.struct(m["start_pos"].alias("start"), m["end_pos"].alias("end"), label(m).alias("label"), F.lit(0.95).alias("confidence")))
    each = rows.select("row_id", F.posexplode(tagging.repair(spans, F.col("source_text"))).alias("n", "e"))
    return each.select("row_id", F.col("n").cast("long").alias("n"), F.col("e.start").cast("long").alias("start_pos"), F.col("e.end").cast("long").alias("end_pos"), "e.label")


def label_counts(spark: SparkSession, d: str) -> DataFrame:
    return training.label_counts(table(spark, d, "sv_pure3"), tagging.MASK)


def tag_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return tagging.vocabulary(spark)


def tuning_rows(spark: SparkSession, d: str) -> DataFrame:
    return training.tuning_rows(_run_texts(spark, d), _entities(spark, d), RUN, "Hitta identifierande uppgifter och svara med JSON.")


def _export(spark: SparkSession, d: str) -> DataFrame:
    """(run_label, note, task): the audit as an export of review tasks."""
    texts = table(spark, d, "audit").select(*RUN).distinct().join(_texts(spark, d), "note", "left").select(*RUN, "text")
    out = review.tasks(texts, review.regions(_entities(spark, d), RUN), RUN)
    return out.select(*RUN, F.from_json("task", review.TASK).alias("task"))


def export_ner_rows(spark: SparkSession, d: str) -> DataFrame:
    """Training rows for entity recognition out of an export: text length, spans, and the sum of their ends."""
    rows = training.export_rows(_export(spark, d), RUN)
    ends = F.aggregate("privacy_mask", F.lit(0).cast("long"), lambda a, m: a + m["end_pos"])
    return rows.select(*RUN, F.length("source_text").cast("long").alias("n_chars"), F.size("privacy_mask").cast("long").alias("n_spans"), ends.alias("ends"))


def export_tuning_rows(spark: SparkSession, d: str) -> DataFrame:
    """Tuning rows out of an export."""
    return training.export_tuning(_export(spark, d), RUN, "Hitta identifierande uppgifter och svara med JSON.")


def train_split(spark: SparkSession, d: str) -> DataFrame:
    return training.exact_split(table(spark, d, "sv_pure3"), "row_id", 42, 0.8)


def hash_split(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sv_pure3").select("row_id", training.split_part(F.col("row_id"), 42, 0.8).alias("part"))


# ---------------------------------------------------------------- sources and sinks


def gazetteer_file(spark: SparkSession, d: str) -> DataFrame:
    """The gazetteer written as CSV and read again."""
    path = scratch(spark)
    files.write_gazetteer(table(spark, d, "gazetteer"), path)
    return files.gazetteer(spark, path)


def tuning_file(spark: SparkSession, d: str) -> DataFrame:
    """Tuning rows written as two CSV files and read again."""
    path = scratch(spark)
    part = training.split_part(F.concat_ws("|", *RUN), 7, 0.8)
    files.write_tuning(tuning_rows(spark, d).select("system_prompt", "user_input", "assistant_output", part.alias("part")), path)
    read = [spark.read.csv(f"{path}_{p}", header=True, multiLine=True, escape='"', schema="system_prompt string, user_input string, assistant_output string").withColumn("part", F.lit(p)) for p in ("train", "validation")]
    return read[0].unionByName(read[1]).groupBy("part").agg(F.count("*").alias("n"), F.sum(F.length("user_input")).alias("chars_in"), F.sum(F.length("assistant_output")).alias("chars_out"))


def review_file(spark: SparkSession, d: str) -> DataFrame:
    """Review tasks written as files for import and read again: tasks and regions of each run."""
    path = scratch(spark)
    out = review.tasks(_run_texts(spark, d).withColumn("output_file", F.concat_ws("|", *RUN)), review.regions(_entities(spark, d), RUN), RUN, ["output_file"])
    files.write_tasks(out, path)
    back = files.review_export(spark, path)
    label = F.substring_index("task.data.output_file", "|", 1)
    return back.groupBy(label.alias("run_label")).agg(F.count("*").alias("tasks"), F.sum(F.size(review.chosen(F.col("task")))).alias("items"), F.sum(F.length("task.data.text")).alias("chars"))


def audit_file(spark: SparkSession, d: str) -> DataFrame:
    """Audit rows written as JSON and read again, without the time of writing."""
    path = scratch(spark)
    files.write_audit(audit_log(spark, d), path)
    return spark.read.schema("run_label string, note string, position long, original string, label string, start_pos long, end_pos long, source string, risk string, generalized_to string").json(path)


# ---------------------------------------------------------------- scores


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    gold = table(spark, d, "synthetic_notes_key").select("item_id", "note", "item_group", "text", "pii_type")
    return scoring.item_outcomes(gold, redacted_runs(spark, d), table(spark, d, "audit"))


def score_misses(spark: SparkSession, d: str) -> DataFrame:
    """What each run missed on each note, as one text a kind."""
    gold = table(spark, d, "synthetic_notes_key").select("item_id", "text")
    return scoring.misses(_outcomes(spark, d), gold).withColumn("items", F.array_join("items", "|"))


def score_items(spark: SparkSession, d: str) -> DataFrame:
    return _outcomes(spark, d).select("item_id", *RUN, "kind", "kept", "detected", "hit")


def score_notes(spark: SparkSession, d: str) -> DataFrame:
    return scoring.per_note(_outcomes(spark, d))


def score_compare(spark: SparkSession, d: str) -> DataFrame:
    return scoring.compare(_outcomes(spark, d))


def score_seeds(spark: SparkSession, d: str) -> DataFrame:
    return scoring.seeds(_outcomes(spark, d))


ENSEMBLE = ["modell_a_s1", "modell_a_s2", "modell_b_s1"]


def score_ensemble(spark: SparkSession, d: str) -> DataFrame:
    return scoring.ensemble(_outcomes(spark, d), ENSEMBLE)


def detector_compare(spark: SparkSession, d: str) -> DataFrame:
    return scoring.detector_compare(table(spark, d, "synthetic_notes_key"), table(spark, d, "audit"))


def scored_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes of the key with their runs, and runs without a text."""
    notes = table(spark, d, "synthetic_notes_key").select("note").distinct()
    runs = table(spark, d, "audit").groupBy("note").agg(F.countDistinct("run_label").alias("runs"))
    has = _texts(spark, d).select("note", F.lit(True).alias("has_text"))
    return notes.join(runs, "note", "left").join(has, "note", "left").select("note", F.coalesce("runs", F.lit(0)).cast("long").alias("runs"), F.coalesce("has_text", F.lit(False)).alias("has_text"))


# ---------------------------------------------------------------- review


def review_regions(spark: SparkSession, d: str) -> DataFrame:
    return review.regions(_entities(spark, d), RUN)


def review_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Entities out as tasks and back again."""
    texts = table(spark, d, "audit").select(*RUN).distinct().join(_texts(spark, d), "note", "left").select(*RUN, "text")
    out = review.tasks(texts, review.regions(_entities(spark, d), RUN), RUN)
    parsed = out.select(*RUN, F.from_json("task", review.TASK).alias("t"))
    back = review.decoded(parsed.select(*RUN, review.chosen(F.col("t")).alias("result")), RUN)
    return _long(back.select(*RUN, "text", "label", "start", "end", "source", "generalized", "risk"), "start", "end").withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


def review_clusters(spark: SparkSession, d: str) -> DataFrame:
    return review.clusters(_entities(spark, d), RUN)


def review_rendered(spark: SparkSession, d: str) -> DataFrame:
    c = review.clusters(_entities(spark, d), RUN).select(*RUN, F.struct(F.col("start_pos").cast("int").alias("start"), F.col("end_pos").cast("int").alias("end"), "replacement").alias("s"))
    spans = c.groupBy(*RUN).agg(F.array_sort(F.collect_list("s")).alias("spans"))
    return _run_texts(spark, d).join(spans, RUN, "left").select(*RUN, F.when(F.col("spans").isNull(), F.col("text")).otherwise(redact.splice(F.col("text"), F.col("spans"))).alias("rendered"))


def deliveries(spark: SparkSession, d: str) -> DataFrame:
    """The last delivery of each note (notes arrive twice, and late)."""
    last = W.partitionBy("doc_id").orderBy(F.col("received_at").desc_nulls_last(), F.col("note_id").desc())
    return table(spark, d, "notes").withColumn("n", F.row_number().over(last)).where("n = 1").select("doc_id", "note_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))


def queries() -> dict:
    return {
        "rule_spans": rule_spans,
        "rule_spans_email": rule_spans_of(0),
        "rule_spans_phone": rule_spans_of(1),
        "rule_entities": rule_entities,
        "rule_label_counts": rule_label_counts,
        "redact_notes": redact_notes,
        "gazetteer_patterns": gazetteer_patterns,
        "gazetteer_spans": gazetteer_spans,
        "mock_entities": mock_entities,
        "word_entities": word_entities,
        "plain_text": lambda s, d: deidentified("redacted", PLAIN)(s, d).select("note_id", "redacted", "needs_review"),
        "plain_generalized": plain_generalized,
        "judged_notes": judged_notes,
        "model_tokens": model_tokens,
        "model_entities": model_entities,
        "deidentified_text": lambda s, d: deidentified("redacted")(s, d).select("note_id", "redacted"),
        "deidentified_audit": deidentified("audit"),
        "backstop_audit": deidentified("audit", pipeline.Options(mode="no_bert", backstop=True)),
        "greedy_accept": greedy_accept,
        "redaction_plan": redaction_plan,
        "replacements": replacements(False),
        "replacements_no_generalize": replacements(True),
        "age_decades": age_decades,
        "redacted_runs": redacted_runs,
        "audit_log": audit_log,
        "propagated": propagated,
        "stage_counts": stage_counts,
        "union_stages": union_stages,
        "taxonomy": taxonomy_table,
        "generalize_targets": generalize_targets,
        "llm_claims": llm_claims,
        "llm_resolved": llm_resolved,
        "token_budgets": token_budgets,
        "quantization_tiers": quantization_tiers,
        "judge_panel": judge_panel,
        "judge_votes": judge_votes,
        "judge_first_flags": judge_first_flags,
        "needs_review": needs_review,
        "sentence_units": sentence_units,
        "sentence_chunks": sentence_chunks,
        "char_windows": char_windows,
        "training_chunks": training_chunks,
        "token_tags": token_tags,
        "decoded_spans": decoded_spans,
        "ner_f_scores": f_scores(False),
        "ner_f_scores_by_label": f_scores(True),
        "ner_report": ner_report,
        "fragment_repair": fragment_repair,
        "label_counts": label_counts,
        "tag_vocabulary": tag_vocabulary,
        "tuning_rows": tuning_rows,
        "export_ner_rows": export_ner_rows,
        "export_tuning_rows": export_tuning_rows,
        "gazetteer_file": gazetteer_file,
        "tuning_file": tuning_file,
        "review_file": review_file,
        "audit_file": audit_file,
        "train_split": train_split,
        "hash_split": hash_split,
        "score_items": score_items,
        "score_notes": score_notes,
        "score_misses": score_misses,
        "score_compare": score_compare,
        "score_seeds": score_seeds,
        "score_ensemble": score_ensemble,
        "detector_compare": detector_compare,
        "scored_notes": scored_notes,
        "review_regions": review_regions,
        "review_round_trip": review_round_trip,
        "review_clusters": review_clusters,
        "review_rendered": review_rendered,
        "deliveries": deliveries,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.sql()
