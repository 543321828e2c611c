"""Model replies, judge, review, training, sources, sinks and streams."""

import json

import pytest
from pyspark.sql import functions as F

from dimskog.operators import backend, judge, review, training
from dimskog.plans import catalogue, pipeline
from dimskog.schema import ENTITY
from dimskog.sources import files, sparql

REPLIES = [
    '[{"text": "Anna Ek", "label": "private_person", "risk": "high", "generalize": null}]',
    '<think>[{"text": "nej"}]</think>```json\n[{"text": "snickare", "generalize": "hantverkare"}]\n```',
    '[{"text": "ett", "label": "a"}, {"text": "två", "label": "b"}, {"text": "tr',
    '[{"text": 5, "label": {"x": 1}}, {"text": "ok", "label": 7, "generalize": {"a": 1}}]',
    "inget här", "", None,
]


def test_claims_survive_bad_items(spark):
    df = spark.createDataFrame(list(enumerate(REPLIES)), "id int, raw string")
    got = {(r.id, r.text): (r.label, r.risk, r.generalized) for r in backend.claims(df, "id").collect()}
    assert got == {
        (0, "Anna Ek"): ("private_person", "high", None), (1, "snickare"): ("unknown", "medium", "hantverkare"),
        (2, "ett"): ("a", "medium", None), (2, "två"): ("b", "medium", None), (3, "ok"): ("unknown", "medium", None),
    }
    raw = spark.createDataFrame([("<think> a\nb </think>[]",), ("<|channel>thought x<channel|>",), ("[]",)], "raw string")
    assert [r[0] for r in raw.select(backend.reasoning(F.col("raw"))).collect()] == ["a\nb", "x", None]


def test_offsets(spark):
    text = "neurologiska fynd: neurolog Ek, neurolog Bo, barnneurolg vid (aaa)"
    docs = spark.createDataFrame([(1, text)], "id int, text string")
    want = [(1, 0, "neurolog"), (1, 1, "neurolog"), (1, 2, "barnneurolog"), (1, 3, "finns inte"), (1, 4, "neurolog")]
    claims = spark.createDataFrame([(*w, "l", "low", None) for w in want], "id int, item long, text string, label string, risk string, generalized string")
    got = {r.item: text[r.start : r.end] for r in backend.resolve_all(docs, claims, "id").collect()}
    spans = {r.item: r.start for r in backend.resolve_all(docs, claims, "id").collect()}
    assert (spans[0], spans[1]) == (19, 32) and got[0] == got[1] == "neurolog" and got[2] == "barnneurolg" and 3 not in got


def test_claims_beyond_the_occurrences(spark):
    """A claimed span is not given again: not to an equal claim, nor to a near one, nor to an exact one after a near one."""
    text = "Besök 14/2/2024 hos barnneurolog; sjukskriven snickare."
    want = ["14/2/2024", "14/2/2024", "barnneurologg", "barnneurologg", "barnneurolog", "snickare", "snickare"]
    docs = spark.createDataFrame([(1, text), (2, text), (3, None)], "id int, text string")
    claims = spark.createDataFrame([(d, i, w, "l", "low", None) for d in (1, 3) for i, w in enumerate(want)], "id int, item long, text string, label string, risk string, generalized string")
    got = sorted((r.id, r.item, r.text, text[r.start : r.end]) for r in backend.resolve_all(docs, claims, "id").collect())
    assert got == [(1, 0, "14/2/2024", "14/2/2024"), (1, 2, "barnneurolog", "barnneurolog"), (1, 5, "snickare", "snickare")]


def test_mock_pipeline(spark):
    text = "Anna är snickare, ring 0701234567. Som snickare är hon 34 år."
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")
    out = pipeline.deidentify(docs, "id", pipeline.Options(mode="no_bert"))
    red = {r.id: r.redacted for r in out["redacted"].collect()}
    assert red == {1: "Anna är hantverkare, ring [TELEFON]. Som hantverkare är hon 34 år.", 2: None, 3: ""}
    assert [r.source for r in out["audit"].where("id = 1").orderBy("position").collect()] == ["llm", "rule", "propagated"]
    masked = pipeline.deidentify(docs, "id", pipeline.Options(mode="no_bert", backstop=True, no_generalize=True))
    assert {r.id: r.redacted for r in masked["redacted"].collect()}[1] == "Anna är [DEMOGRAFISK-UPPGIFT], ring [TELEFON]. Som [DEMOGRAFISK-UPPGIFT] är hon 34 år."
    with pytest.raises(ValueError):
        pipeline.Options(mode="x")
    with pytest.raises(ValueError):
        backend.backend("x")


@pytest.mark.parametrize("quote, drop", [("[PERSON] bor i [ADRESS]", True), ("Patienten [PERSON] hos Anna", False), ("[TELEFON] 12", False), ("Anna", False), ("Hos [PERSON]", True)])
def test_misread(spark, quote, drop):
    assert spark.createDataFrame([(quote,)], "q string").select(judge.misread(F.col("q"))).first()[0] is drop


def test_judge_rounds(spark):
    docs = spark.createDataFrame([(1, "Anna a"), (2, "ok"), (3, "Anna Bo")], "id int, text string")
    review_ = lambda d: d.where("text like '%Anna%'").select("id", F.lit(0).alias("seq"), F.lit("j").alias("judge"), F.lit("Anna").alias("quote"), F.lit("namn").alias("reason"))
    retry = lambda d, flags: d.withColumn("text", F.regexp_replace("text", "Anna", "[PERSON]"))
    out, left = judge.rounds(docs, review_, retry, "id")
    assert {r.id: r.text for r in out.collect()} == {1: "[PERSON] a", 2: "ok", 3: "[PERSON] Bo"} and left.count() == 0


def test_generalizations(spark):
    e = spark.createDataFrame([(1, k, f"t{k}", "demographics", 0, 1, "llm", 0.8, None, "low") for k in range(3)], f"doc int, {ENTITY}")
    def run(raw):
        r = spark.createDataFrame([(1, raw)], "doc int, raw string")
        return [x.generalized for x in backend.apply_generalizations(e, r, ["doc"]).orderBy("seq").collect()]
    assert run('[{"index": 2, "generalize": "b"}, {"index": 9, "generalize": "x"}]') == [None, "b", None]
    assert run('[{"generalize": "a"}, {"generalize": "b"}, {"generalize": " c "}]') == ["a", "b", "c"]
    assert run('[{"generalize": "a"}]') == [None, None, None]


def test_review_layers(spark):
    item = {"id": "r", "from_name": "label", "value": {"start": 0, "end": 4, "text": "Anna", "labels": ["private_person"]}, "meta": {"text": ["generalized: x"]}}
    tasks = [
        {"annotations": [{"was_cancelled": True, "result": []}], "predictions": [{"result": [item]}]},
        {"annotations": [{"was_cancelled": False, "result": []}], "predictions": [{"result": [item]}]},
        {"predictions": [{"result": [item, {"id": "q", "from_name": "risk", "value": {"choices": ["high"]}}]}]},
    ]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(tasks)], "id int, t string").select("id", F.from_json("t", review.TASK).alias("t"))
    got = {r.id: (r.label, r.source, r.risk, r.generalized) for r in review.decoded(df.select("id", review.chosen(F.col("t")).alias("result")), ["id"]).collect()}
    assert got == {0: ("private_person", "manual", "low", "x"), 2: ("private_person", "manual", "low", "x")}
    assert df.select(F.size(review.chosen(F.col("t"), "annotations"))).first()[0] == 0
    assert review.labeling_page().count("<Label ") == 20


def test_split_is_exact(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    parts = {r.part: r["count"] for r in training.exact_split(df, "k", 1, 0.8).groupBy("part").count().collect()}
    assert parts == {"train": 802, "validation": 201}


def test_f_scores(spark):
    s = "doc int, start long, end long, label string"
    gold = spark.createDataFrame([(1, 0, 4, "a"), (1, 5, 6, "b"), (1, 7, 9, "a")], s)
    pred = spark.createDataFrame([(1, 0, 4, "a"), (1, 5, 6, "a")], s)
    r = training.f_scores(gold, pred, ["doc"]).first()
    assert (r.precision, round(r.recall, 6), round(r.f1, 6)) == (0.5, 0.333333, 0.4) and round(r.f2, 6) == round(5 * 0.5 / 3 / (4 * 0.5 + 1 / 3), 6)


PAGES = {}


def fake_transport(query):
    """Two pages for given names with one timeout between, an error for streets, nothing else."""
    if "Q34442" in query:
        raise RuntimeError("gone")
    if "Q202444" not in query:
        return []
    if "OFFSET 0" in query:
        return [{"item": f"Q{i}", "sv": f"Namn{i}"} for i in range(3)]
    if not PAGES.setdefault("late", False):
        PAGES["late"] = True
        raise TimeoutError
    return [{"item": "Q9", "en": "Last"}]


def test_sparql_source(spark):
    spark.dataSource.register(sparql.SparqlSource)
    df = spark.read.format("sparql").option("transport", "tests.test_contracts:fake_transport").option("limit", "3").option("pause", "0").load()
    rows = df.collect()
    assert len(rows) == 4 and {r.category for r in rows} == {"Given_Name"}


def test_files(spark, tmp_path):
    (tmp_path / "n.txt").write_text("Rad ett\nRad två", encoding="utf-8")
    assert files.notes(spark, str(tmp_path / "n.txt")).first()[:2] == ("n", "Rad ett\nRad två")
    key = {"_about": {"x": 1}, "n.txt": {"should_redact": [{"text": "Anna", "label": "private_person", "type": "direct"}], "medications_flag_keep": ["Alvedon"], "should_not_flag": []}}
    (tmp_path / "key.json").write_text(json.dumps(key), encoding="utf-8")
    assert sorted((r.note, r.item_group, r.text) for r in files.gold_key(spark, str(tmp_path / "key.json")).collect()) == [("n", "medications_flag_keep", "Alvedon"), ("n", "should_redact", "Anna")]
    run = tmp_path / "run"
    run.mkdir()
    (run / "a.redacted.txt").write_text("x [PERSON]")
    (run / "a.audit.json").write_text(json.dumps([{"original": "Anna", "label": "private_person", "start": 2, "end": 6, "source": "bert", "risk": "high"}]))
    (run / "b.redacted.txt").write_text("y")
    red, audit, missing = files.run_folder(spark, str(run), "m_s1")
    assert [r.note for r in red.collect()] == ["a"] and audit.count() == 1 and [r.note for r in missing.collect()] == ["b"]
    out = spark.createDataFrame([("å", "träna", "[]", "train"), ("a", 'b "c"\nd', "[]", "validation")], "system_prompt string, user_input string, assistant_output string, part string")
    files.write_tuning(out, str(tmp_path / "t"))
    back = spark.read.csv(str(tmp_path / "t_validation"), header=True, multiLine=True, escape='"')
    assert back.first().user_input == 'b "c"\nd'
    (tmp_path / "bad.json").write_text("{not json")
    assert files.review_export(spark, str(tmp_path / "bad.json")).count() == 0


def test_review_files(spark, tmp_path):
    """Arrays that can be imported, appended to and read again; positions count in their file; corrupt files give nothing."""
    tasks = spark.createDataFrame([(f'{{"data": {{"text": "t{i}", "output_file": "f{i}.redacted.txt"}}, "predictions": []}}',) for i in range(7)], "task string").repartition(3)
    path = str(tmp_path / "tasks")
    files.write_tasks(tasks, path)
    (tmp_path / "tasks" / "part-bad").write_text("[{")
    files.write_tasks(tasks.limit(2), path, append=True)
    assert all(isinstance(json.loads(f.read_text()), list) for f in (tmp_path / "tasks").glob("part-0*"))
    got = files.review_export(spark, path).collect()
    assert len(got) == 9 and len({(r.file, r.position) for r in got}) == 9 and min(r.position for r in got) == 0
    (tmp_path / "one.json").write_text('{"data": {"text": "ensam"}}')
    assert [(r.position, r.task.data.text) for r in files.review_export(spark, str(tmp_path / "one.json")).collect()] == [(0, "ensam")]
    reviewed = spark.createDataFrame([("a", 1, "s", "andra"), ("a", 0, "s", "första"), ("b", 0, "u", "egen")], "file string, position long, stem string, text string")
    audit = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), ("b", 0, "z")], "file string, position long, original string")
    assert [r.stem for r in files.write_reviewed(reviewed, audit, str(tmp_path / "rev")).collect()] == ["s"]
    assert {r.text for r in spark.read.parquet(str(tmp_path / "rev/texts")).collect()} == {"första", "egen"}
    assert {(r.stem, r.original) for r in spark.read.json(str(tmp_path / "rev/audit")).collect()} == {("s", "y"), ("u", "z")}


def test_rows_by_split(spark, tmp_path):
    spark.createDataFrame([(1, "train"), (2, "validation"), (3, "train")], "id int, split string").write.partitionBy("split").parquet(str(tmp_path / "r"))
    assert files.split_rows(spark, str(tmp_path / "r")).count() == 3 and {r.id for r in files.split_rows(spark, str(tmp_path / "r"), "train").collect()} == {1, 3}


def test_training_rows_from_an_export(spark):
    item = lambda s, e, *labels: {"id": "r", "from_name": "label", "value": {"start": s, "end": e, "text": "Anna Ek"[s:e], "labels": list(labels)}}
    tasks = [
        {"data": {"text": "Anna Ek"}, "annotations": [{"result": []}, {"result": [item(0, 4, "private_person"), item(5, 7)]}], "predictions": [{"result": [item(0, 7, "x")]}]},
        {"data": {"text": "Bo"}, "predictions": [{"result": [item(0, 2, "private_person")]}]},
        {"data": {"text": "tom"}}, {"data": {}},
    ]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(tasks)], "id int, t string").select("id", F.from_json("t", review.TASK).alias("task"))
    got = {r.id: (r.source_text, [tuple(m) for m in r.privacy_mask]) for r in training.export_rows(df, ["id"]).collect()}
    assert got == {0: ("Anna Ek", [(0, 4, "private_person")]), 1: ("Bo", [(0, 2, "private_person")]), 2: ("tom", [])}
    rows = {r.id: r.assistant_output for r in training.export_tuning(df, ["id"], "p").collect()}
    assert rows[2] == "[]" and "private_person" in rows[1]
    with pytest.raises(ValueError):
        training.require_labels(spark.createDataFrame([("X", 3, None)], "label string, n long, category string"))


def test_report_and_summary(spark, tmp_path):
    s = "label string, gold long, predicted long, correct long"
    rows = training._rated(spark.createDataFrame([("a", 4, 2, 2), ("b", 1, 2, 1), ("c", 0, 0, 0)], s))
    got = {r.label: r for r in training.report(rows).collect()}
    assert got["micro"].precision == 0.75 and got["micro"].recall == 0.6 and got["macro"].recall == 0.5 and got["weighted"].recall == 0.6 and got["weighted"].support == 5
    files.write_summary(spark.createDataFrame([("m1", 0.1, 0.2, 0.3, 0.4), ("m2", 0.5, 0.6, 0.7, 0.8)], "model string, precision double, recall double, f1 double, f2 double"), str(tmp_path / "s"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "s")).collect()]
    assert lines[0].startswith("m2") and "F2 0.8000" in lines[0] and len(lines) == 2


def test_hot_note_scores(spark):
    """A note with many runs: the same outcomes whatever the split; blank and null items count as absent."""
    from dimskog.operators import scoring

    gold = spark.createDataFrame([(1, "n", "should_redact", "Anna", "direct"), (2, "n", "should_not_flag", "hund", None), (3, "n", "should_redact", " ", "quasi"), (4, "m", "should_redact", None, "direct")], "item_id long, note string, item_group string, text string, pii_type string")
    red = spark.createDataFrame([(f"r{i}", "n", "Anna hund" if i % 2 else "[PERSON] hund") for i in range(60)] + [("r0", "m", None)], "run_label string, note string, redacted string")
    found = spark.createDataFrame([(f"r{i}", "n", "Anna E", "x") for i in range(60)], "run_label string, note string, original string, label string")
    out = scoring.item_outcomes(gold, red, found)
    assert out.count() == 181 and out.where("item_id = 1 and hit and detected").count() == 30 and out.where("item_id = 2 and hit").count() == 60 and out.where("item_id = 3 and hit").count() == 60
    lost = {(r.run_label, r.kind): r["items"] for r in scoring.misses(out, gold).collect()}
    assert len(lost) == 30 and lost["r1", "direct"] == ["Anna"]


def test_stream_equals_batch(spark, tmp_path):
    from dimskog.streaming import notes

    src = spark.createDataFrame([(1, "d1", "Ring 0701234567", "2024-01-01 10:00:00"), (2, "d2", None, "2024-01-02 10:00:00"), (3, "d3", "Född 811212-3456", "2024-01-02 11:00:00")], "note_id long, doc_id string, text string, r string")
    src = src.select("note_id", "doc_id", "text", F.to_timestamp("r").alias("received_at"))
    src.write.parquet(str(tmp_path / "in"))
    stream = notes.redacted(notes.read_notes(spark, str(tmp_path / "in"), src.schema))
    q = stream.writeStream.format("memory").queryName("red").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r.note_id, r.redacted) for r in spark.table("red").collect()} == {(r.note_id, r.redacted) for r in notes.redacted(src).collect()}
    q = notes.label_counts(notes.read_notes(spark, str(tmp_path / "in"), src.schema)).writeStream.format("memory").queryName("cnt").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp2")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r.label, r.n) for r in spark.table("cnt").collect()} == {("private_phone", 1), ("account_number", 1)}


def test_catalogue_names_agree():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
