"""Token models, prompts, chunked sweeps and the command line."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from dimskog.operators import backend, model, prompts
from dimskog.plans import cli, pipeline


def test_model_detector(spark):
    text = "Anna Ek bor i Uppsala. " + "Fyllnad här. " * 40 + "Sedan kom Anna, kanske till Uppsala."
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "inget")], "id long, text string")
    want = [("Anna Ek", "private_person"), ("Uppsala", "private_address"), ("Anna", "private_person"), ("Uppsala", "private_address")]
    for limit, sentence in ((10_000, True), (200, True), (200, False)):
        got = model.detect(docs, "id", limit=limit, by_sentence=sentence).orderBy("start").collect()
        assert [(r.text, r.label) for r in got] == want and all(text[r.start : r.end] == r.text for r in got)
    chunks = model.chunked(docs.where("id = 1"), "id", 200).orderBy("chunk_no").collect()
    assert "".join(c.text for c in chunks) == text and all(text[c.start :].startswith(c.text) for c in chunks) and len(chunks) > 1


def test_model_stage_in_the_pipeline(spark):
    docs = spark.createDataFrame([(1, "Anna Ek ringde 0701234567.")], "id long, text string")
    options = pipeline.Options("full", model=lambda d, k: model.detect(d, k))
    assert pipeline.deidentify(docs, "id", options)["redacted"].first().redacted == "[PERSON] ringde [TELEFON]."


def test_prompts():
    assert prompts.kind(True, ["x"]) == "targeted" and prompts.kind(True, None) == "full" and prompts.kind(False, []) == "quasi"
    p = prompts.detection("T", ["b", "a", "a"], omit_generalize=True)
    assert "(a, b)" in p and "generalize" not in p and p.endswith("T")
    assert "”x”" in prompts.detection("T", [], quotes=["x"])
    assert len(prompts.chat("s", "u")) == 2 and prompts.chat("s", "u", False)[0]["content"] == "s\n\nu"


def test_sweep_cuts_long_texts(spark):
    text = "En snickare kom. " + "Fyllnad utan något. " * 120 + "Även en snickare."
    docs = spark.createDataFrame([(1, text), (2, "snickare")], "id long, text string")
    found = backend.resolve_all(docs, backend.sweep(docs, "id"), "id").where("id = 1").orderBy("start").collect()
    assert [r.start for r in found] == [text.index("snickare"), text.rindex("snickare")]
    assert backend.sweep(docs, "id", direct=True).where("id = 1").count() == 1


def test_command_line(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Anna ringde 0701234567, snickare.", encoding="utf-8")
    a = cli.arguments(["--notes", f"{tmp_path}/a.txt", "--out", f"{tmp_path}/out", "--mode", "no_bert", "--review", "--gazetteer", "/saknas.csv"])
    cli.run(spark, a)
    assert spark.read.parquet(f"{tmp_path}/out/redacted").first().redacted == "Anna ringde [TELEFON], hantverkare."
    audit = spark.read.json(f"{tmp_path}/out/audit").orderBy("position").collect()
    assert [r.label for r in audit] == ["private_phone", "demographics"]
    tasks = [t for f in (tmp_path / "out/review").glob("part-*") for t in json.loads(f.read_text(encoding="utf-8"))]
    assert len(tasks) == 1 and len(tasks[0]["predictions"][0]["result"]) == 6 and tasks[0]["data"]["output_file"] == "a.redacted.txt"
    assert spark.read.text(f"{tmp_path}/out/review_page").where(F.col("value").contains("<Labels")).count() == 1
    assert not (tmp_path / "out/reasoning").exists()


CALLS = "/tmp/dimskog-test-calls"


class Counting(backend.MockBackend):
    """A backend that writes a line for every call it gets, and breaks on some texts."""

    def detect(self, text, request=backend.Request()):
        with open(f"{CALLS}/{'asked' if request.quotes else 'detect'}", "a") as f:
            f.write(text[:12].replace("\n", " ") + "\n")
        if "krasch" in text:
            raise RuntimeError("no memory")
        if request.quotes:
            return backend.json_of([{"text": q, "label": "private_person", "risk": "high"} for q in request.quotes])
        return "<think>jaså</think>" + super().detect(text, request)

    def judge(self, redacted_text, thinking=False):
        with open(f"{CALLS}/judge", "a") as f:
            f.write(redacted_text[:12] + "\n")
        return backend.json_of([{"quote": w, "reason": "namn"} for w in ("Anna", "Bosse [PERSON]") if w in redacted_text] + [{"quote": "  ", "reason": ""}, {"reason": "tom"}])


class Counted(model.DictionaryModel):
    def predict(self, text):
        with open(f"{CALLS}/model", "a") as f:
            f.write(text[:12] + "\n")
        return super().predict(text)


backend.register("counting", "tests.test_model:Counting")


def calls(kind):
    from pathlib import Path

    return sorted(Path(f"{CALLS}/{kind}").read_text().split("\n")[:-1]) if Path(f"{CALLS}/{kind}").exists() else []


@pytest.fixture()
def log():
    shutil.rmtree(CALLS, ignore_errors=True)
    os.makedirs(CALLS)
    yield
    shutil.rmtree(CALLS, ignore_errors=True)


def test_each_text_is_seen_once(spark, tmp_path, log):
    """Model and backend see each text once in a command-line run that writes everything."""
    (tmp_path / "in").mkdir()
    for i in range(12):
        (tmp_path / "in" / f"n{i:02d}.txt").write_text(f"n{i:02d} är snickare, ring 0701234567.", encoding="utf-8")
    args = ["--notes", f"{tmp_path}/in/*.txt", "--out", f"{tmp_path}/out", "--backend", "counting", "--model", "tests.test_model:Counted", "--review"]
    out = cli.run(spark, cli.arguments(args))
    out["entities"].count(), out["redacted"].count(), out["fragments"].count()
    assert [c[:3] for c in calls("detect")] == [c[:3] for c in calls("model")] == [f"n{i:02d}" for i in range(12)]
    trail = spark.read.json(f"{tmp_path}/out/reasoning").collect()
    assert len(trail) == 12 and {r.reasoning for r in trail} == {"jaså"}


def test_a_failing_call_marks_its_document(spark, log):
    docs = spark.createDataFrame([(1, "En snickare."), (2, "En krasch, 0701234567."), (3, None)], "id long, text string")
    out = pipeline.deidentify(docs, "id", pipeline.Options("no_bert", ("counting",)))
    assert {r.id: (r.redacted, r.needs_review) for r in out["redacted"].collect()} == {1: ("En hantverkare.", False), 2: ("En krasch, [TELEFON].", True), 3: (None, False)}
    assert [(r.id, r.backend, r.task, r.error) for r in out["errors"].collect()] == [(2, "counting", "detect", "RuntimeError: no memory")]


def test_judges_and_retry(spark, log):
    """Flagged quotes are asked about, found again and redacted; what stays flagged needs review; clean documents are left alone."""
    docs = spark.createDataFrame([(1, "Anna kom. Även Anna."), (2, "Lugnt."), (3, "Bosse 0701234567"), (4, "Bosse [PERSON] Annaliese")], "id long, text string")
    out = pipeline.deidentify(docs, "id", pipeline.Options("no_bert", ("counting",), judges=("counting",)))
    red = {r.id: (r.redacted, r.needs_review) for r in out["redacted"].collect()}
    assert red[1] == ("[PERSON] kom. Även [PERSON].", False) and red[2] == ("Lugnt.", False) and red[3] == ("Bosse [TELEFON]", False)
    assert red[4][1] and {r.quote for r in out["flags"].collect()} == {"Anna"}  # inside a word, so nothing can be placed; the other quote has only a placeholder
    assert calls("asked").count("Anna kom. Äv") == 1 and "Lugnt." not in calls("asked") and calls("judge").count("Lugnt.") == 1
    assert len(out["audit"].where("id = 1").collect()) == 2
    assert out["calls"].where("task = 'judge' and id = 4").count() == 3  # two rounds and the last look


def test_generalization_stage(spark):
    docs = spark.createDataFrame([(1, "En snickare och 0701234567."), (2, "inget")], "id long, text string")
    options = pipeline.Options("no_bert", generalize_backend="mock")
    assert {r.id: r.redacted for r in pipeline.deidentify(docs, "id", options)["redacted"].collect()}[1] == "En generaliserad demographics och [TELEFON]."
    off = pipeline.deidentify(docs, "id", pipeline.Options("no_bert", generalize_backend="mock", no_generalize=True))
    assert off["redacted"].where("id = 1").first().redacted == "En [DEMOGRAFISK-UPPGIFT] och [TELEFON]."
    assert [r.generalized_to for r in off["audit"].orderBy("position").collect()] == ["[DEMOGRAFISK-UPPGIFT]", "[TELEFON]"]


def test_llm_only_has_no_gazetteer(spark):
    docs = spark.createDataFrame([(1, "Anna i Uppsala, 0701234567.")], "id long, text string")
    names = spark.createDataFrame([("uppsala", "Uppsala", "private_address")], "key string, name string, label string")
    assert pipeline.deidentify(docs, "id", pipeline.Options("llm_only"), names)["audit"].count() == 0
    assert pipeline.deidentify(docs, "id", pipeline.Options("no_bert"), names)["audit"].count() == 2


def complete(path):
    """A transport: echoes what it was asked, for the prompt's sake."""

    def answer(messages, budget, settings):
        return backend.json_of([{"text": "Anna", "label": f"{path}|{len(messages)}|{budget}|{settings.get('enable_thinking')}", "risk": "high", "generalize": messages[-1]["content"][-4:]}])

    return answer


def test_registered_chat_models(spark):
    assert len(backend.REGISTRY) == 13 and {f for f, _, _ in backend.REGISTRY.values()} == set(backend.FAMILIES)
    with pytest.raises(ValueError):
        pipeline.Options(backends=("qwen",))  # nothing to speak to it with
    with pytest.raises(ValueError):
        pipeline.Options(backends=("okänd",))
    docs = spark.createDataFrame([(1, "x Anna")], "id long, text string")
    for name, turns, think in (("qwen", 2, "True"), ("gemma", 1, "None")):
        out = pipeline.deidentify(docs, "id", pipeline.Options("llm_only", (name,), thinking=True, transport="tests.test_model:complete"))
        r = out["entities"].first()
        assert r.label == f"{backend.REGISTRY[name][1]}|{turns}|{backend.budget_of(2, 0, True)}|{think}" and r.generalized == "Anna"


def test_chunks_by_the_tokens_of_a_model(spark):
    docs = spark.createDataFrame([(1, "Ord. " * 100), (2, "kort")], "id long, text string")
    got = model.chunked(docs, "id", 40, factory="tests.test_model:Tokens").orderBy("id", "chunk_no").collect()
    assert [r.text for r in got if r.id == 2] == ["kort"] and "".join(r.text for r in got if r.id == 1) == "Ord. " * 100
    assert all(len(r.text.split()) <= 34 for r in got) and len([r for r in got if r.id == 1]) == 3


class Tokens(model.DictionaryModel):
    def count(self, text):
        return len(text.split())
