import json
import uuid

import pytest

from verbalance import jobs
from verbalance.plans.intake_batch import IntakeStore
from verbalance.sinks import tables as sink

DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"


def make_recognizer():
    return lambda content, path: content.decode("utf-8")


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    (folder / "a.wav").write_bytes(b"hello world")
    (folder / "b.wav").write_bytes(b"\xff")
    return folder


def test_intake_and_stream(spark, drop, tmp_path, capsys):
    common = ["--input", str(drop), "--recognizer", "tests.test_jobs:make_recognizer"]
    jobs.main(["intake", *common, "--store", str(tmp_path / "batch")])
    assert "successful" in capsys.readouterr().out
    jobs.main(
        ["stream", *common, "--store", str(tmp_path / "s"), "--checkpoint", str(tmp_path / "c")]
    )
    for name in ("batch", "s"):
        rows = IntakeStore(spark, str(tmp_path / name)).bronze().collect()
        assert sorted((r["audio_filename"], r["status"], r["error_type"]) for r in rows) == [
            ("a.wav", "success", None),
            ("b.wav", "failed", "UnicodeDecodeError"),
        ]


def test_reconcile_and_table(spark, tmp_path, capsys):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    reference = spark.sql(
        """select 'ab' as audio_id, 'a.wav' as audio_file, 'hello world' as expected_transcription,
                  timestamp '2024-01-01 00:00:00' as created_at"""
    )
    sink.append_table(
        reference, url, "audio_reference", driver=DRIVER,
        createTableColumnTypes="audio_id VARCHAR(64)",
    )
    bronze = tmp_path / "bronze"
    bronze.mkdir()
    record = {"audio_id": "ab", "audio_filename": "a.wav", "status": "success",
              "transcription": "Hello  world!"}
    (bronze / "a.json").write_text(json.dumps(record, indent=4))
    (bronze / "broken.json").write_text("{")
    (bronze / "processing_audit.json").write_text('[{"audio_file": "a.wav"}]')
    database = ["--url", url, "--option", f"driver={DRIVER}", "--split-key", '"audio_id"']
    jobs.main(["table", *database])
    assert "Record count: 1" in capsys.readouterr().out
    jobs.main(
        ["reconcile", *database, "--bronze", str(bronze), "--json",
         "--results", str(tmp_path / "results"), "--audit-table", "pipeline_audit"]
    )
    out = capsys.readouterr().out
    assert "unreadable records: 1" in out and "TRANSCRIPTION_MATCH" in out
    audit = spark.read.format("jdbc").options(url=url, dbtable="pipeline_audit", driver=DRIVER)
    assert [r["run_status"] for r in audit.load().collect()] == ["SUCCESS"]
