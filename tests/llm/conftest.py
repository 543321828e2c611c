import shutil

import pytest


@pytest.fixture(scope="session")
def data(spark, tmp_path_factory):
    """Writes named tables of rows into a fresh folder and returns it."""

    def write(**tables):
        folder = str(tmp_path_factory.mktemp("data"))
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
        return folder

    return write


NOTES = "note_id long, doc_id string, text string, source_file string, unit_code string, written_at timestamp, received_at timestamp"
ROWS = "row_id long, split string, source string, source_text string, privacy_mask array<struct<start_pos:int,end_pos:int,label:string>>, extra string, text string"
GAZETTEER = "wikidata_id string, label_en string, label_sv string, category string"
LIMITS = "limit_id int, tbl string, field_name string, size_unit string, max_size int, overlap_size int"


@pytest.fixture(scope="session")
def tables(data):
    """A data folder with notes, sv_pure3, gazetteer and size_limits from plain rows."""

    def build(notes=(), rows=(), gazetteer=(), limits=None):
        limits = limits or [(1, "notes", "text", "code points", 60, 10), (2, "sv_pure3", "source_text", "code points", 40, 5), (3, "documents", "text", "tokens", 16, 0)]
        return data(
            notes=([(i, f"d{i}", t, None, u, None, None) for i, t, u in notes], NOTES),
            sv_pure3=([(i, sp, so, t, m, "x", "clash") for i, sp, so, t, m in rows], ROWS),
            gazetteer=(list(gazetteer), GAZETTEER),
            size_limits=(limits, LIMITS),
        )

    return build


@pytest.fixture(scope="session", autouse=True)
def clean():
    yield
    import tempfile

    shutil.rmtree(f"{tempfile.gettempdir()}/dimskog-checkpoints", ignore_errors=True)
