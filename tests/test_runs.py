from datetime import datetime

import pytest

from tests.conftest import rows_of
from verbalance.operators import summaries
from verbalance.plans.reconciliation import QualityGateError, run_reconciliation
from verbalance.plans.run_audit import audited_run
from verbalance.schemas import GOLD_COLUMNS, RUN_AUDIT
from verbalance.sinks.datasets import dataset_appender
from verbalance.sources.records import read_dataset, rows_frame
from verbalance.schemas import BRONZE


@pytest.fixture
def bronze(spark):
    rows = [
        {"audio_id": "1", "audio_filename": "a.wav", "status": "success", "transcription": "A b"},
        {"audio_id": "1", "audio_filename": "b.wav", "status": "success", "transcription": "A b"},
        {"audio_id": "2", "audio_filename": "c.wav", "status": "success", "transcription": "x"},
        {"audio_id": "3", "audio_filename": "d.wav", "status": "failed", "word_count": 0},
        {"audio_id": "4", "status": None},
    ]
    return rows_frame(spark, rows, BRONZE)


@pytest.fixture
def reference(spark):
    return spark.sql(
        """select * from values ('1', 'a.wav', 'a b!', timestamp '2024-01-01 00:00:00'),
                                ('1', 'a.wav', 'a', timestamp '2024-01-01 00:00:00'),
                                ('2', 'c.wav', 'y', timestamp '2024-01-01 00:00:00')
           as t(audio_id, audio_file, expected_transcription, created_at)"""
    )


def test_reconciliation_run(spark, tmp_path, bronze, reference):
    audit = str(tmp_path / "run_audit")
    result = run_reconciliation(
        spark, bronze, lambda: reference, str(tmp_path / "store"), dataset_appender(audit)
    )
    assert result.gold.columns == list(GOLD_COLUMNS)
    assert result.gold.count() == 5  # copies are multiplied and kept
    assert rows_of(result.joined_duplicates) == [("1", 4)]
    assert rows_of(result.bronze_duplicates) == rows_of(result.reference_duplicates) == [("1", 2)]
    kept = result.deduplicated.select("audio_id", "audio_file", "quality_status")
    assert [row[:2] for row in rows_of(kept)] == [("1", "a.wav"), ("2", "c.wav")]
    assert rows_of(result.gates) == [
        ("bronze_duplicates", 1, False),
        ("joined_duplicates", 1, False),
        ("reference_duplicates", 1, False),
    ]
    checks = result.bronze_checks.first().asDict()
    assert checks == {
        "bronze_count": 5,
        "silver_count": 3,
        "null_audio_file": 1,
        "null_status": 1,
        "null_transcription": 2,
        "zero_word_count": 1,
        "non_success": 1,
    }
    assert result.quality_summary.first() == (5, 2, 3, 40.0, 60.0)
    assert result.reconciliation_summary.first() == (5, 0, 5, 0.0)
    assert rows_of(result.reason_breakdown) == [
        ("TRANSCRIPTION_MATCH", 2),
        ("TRANSCRIPTION_REVIEW", 1),
        ("WORD_COUNT_DIFFERENCE", 2),
    ]
    row = read_dataset(spark, audit, RUN_AUDIT).first()
    assert (row["run_id"], row["run_status"]) == (result.run_id, "SUCCESS")
    assert tuple(row)[5:9] == (5, 3, 5, 5)


def test_strict_run_stops_at_duplicates(spark, tmp_path, bronze, reference):
    audit = str(tmp_path / "run_audit")
    with pytest.raises(QualityGateError):
        run_reconciliation(
            spark, bronze, lambda: reference, str(tmp_path / "s"), dataset_appender(audit), True
        )
    row = read_dataset(spark, audit, RUN_AUDIT).first()
    assert tuple(row)[4:9] == ("FAILED", 5, 3, 5, None)


def test_unreachable_reference_leaves_one_failed_row(spark, tmp_path, bronze):
    audit = str(tmp_path / "run_audit")

    def unreachable():
        raise ConnectionError("no database")

    with pytest.raises(ConnectionError):
        run_reconciliation(spark, bronze, unreachable, str(tmp_path / "s"), dataset_appender(audit))
    rows = read_dataset(spark, audit, RUN_AUDIT).collect()
    assert len(rows) == 1
    assert tuple(rows[0])[4:] == ("FAILED", 5, 3, None, None, "no database", "ConnectionError")


def test_lost_audit_row_does_not_hide_the_first_error(spark, caplog):
    def refuse(frame):
        raise OSError("audit table is gone")

    with pytest.raises(ValueError, match="first"):
        with audited_run(spark, refuse):
            raise ValueError("first")
    assert "was not written" in caplog.text


def test_times_come_from_the_clock(spark, tmp_path):
    moments = iter([datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1, 500000)])
    audit = str(tmp_path / "run_audit")
    with audited_run(spark, dataset_appender(audit), lambda: next(moments)):
        pass
    row = read_dataset(spark, audit, RUN_AUDIT).first()
    assert (row["run_start_time"], row["run_duration_seconds"]) == (datetime(2024, 1, 1), 1.5)


def test_summary_of_written_gold_reads_labels_only(spark, tmp_path, bronze, reference, capsys):
    result = run_reconciliation(
        spark, bronze, lambda: reference, str(tmp_path / "s"), dataset_appender(str(tmp_path / "a"))
    )
    capsys.readouterr()
    summaries.quality_summary(result.gold).explain()
    assert "ReadSchema: struct<quality_status:string>" in capsys.readouterr().out


def test_a_lost_driver_leaves_a_failed_row(spark, tmp_path):
    """A run in a process of its own that is killed; the next run closes it, once."""
    import os
    import signal
    import subprocess
    import sys
    import time

    audit, markers = str(tmp_path / "audit"), str(tmp_path / "markers")
    script = tmp_path / "lost.py"
    script.write_text(
        "import sys, time\n"
        "from verbalance.session import build_session\n"
        "from verbalance.plans.run_audit import audited_run\n"
        "from verbalance.sinks.datasets import dataset_appender\n"
        "spark = build_session('lost', 'local[1]', spark_ui_enabled='false')\n"
        f"with audited_run(spark, dataset_appender({audit!r}), run_id='lost', markers={markers!r}):\n"
        "    print('running', flush=True)\n"
        "    time.sleep(600)\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    process = subprocess.Popen(
        [sys.executable, str(script)], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL,
        env={**os.environ, "PYTHONPATH": root}, text=True,
    )
    try:
        assert process.stdout.readline().strip() == "running"
    finally:
        os.kill(process.pid, signal.SIGKILL)
        process.wait()
    append = dataset_appender(audit)
    for _ in range(2):
        with audited_run(spark, append, markers=markers):
            pass
    rows = read_dataset(spark, audit, RUN_AUDIT).collect()
    lost = [r for r in rows if r["run_id"] == "lost"]
    assert len(rows) == 3 and len(lost) == 1
    assert (lost[0]["run_status"], lost[0]["error_type"]) == ("FAILED", "RunLost")
    assert lost[0]["run_end_time"] >= lost[0]["run_start_time"]
    assert not [n for n in os.listdir(markers) if n.endswith(".json")]


def test_a_retried_append_and_a_row_written_before_the_driver_was_lost(spark, tmp_path):
    from verbalance.sinks import control

    append, markers = dataset_appender(str(tmp_path / "audit")), str(tmp_path / "markers")

    def twice(frame):
        append(frame)
        append(frame)

    with audited_run(spark, twice, run_id="done", markers=markers):
        pass
    # The driver was lost after the row was written and before the marker was removed.
    begun = {"run_id": "done", "run_start_time": "2024-01-01T00:00:00"}
    control.write_json(spark, f"{markers}/done.json", begun)
    with audited_run(spark, append, run_id="next", markers=markers):
        pass
    rows = read_dataset(spark, str(tmp_path / "audit"), RUN_AUDIT).collect()
    assert sorted((r["run_id"], r["run_status"]) for r in rows) == [("done", "SUCCESS"), ("next", "SUCCESS")]


def test_reports_are_read_from_storage(spark, tmp_path, bronze, reference):
    store = str(tmp_path / "store")
    result = run_reconciliation(spark, bronze, lambda: reference, store, dataset_appender(str(tmp_path / "a")))
    folder = f"{store}/run_id={result.run_id}"
    for name in result._fields[1:]:
        stored = spark.read.parquet(f"{folder}/{name}")
        assert rows_of(stored) == rows_of(getattr(result, name)), name
    assert spark.read.parquet(f"{folder}/deduplicated").count() == 2
