import pytest

from tests.conftest import rows_of
from verbalance.plans.intake_batch import latest_bronze
from verbalance.schemas import BRONZE
from verbalance.sinks import control
from verbalance.sinks.current import CurrentTable
from verbalance.sinks.datasets import write_batch
from verbalance.sources.records import read_dataset, rows_frame


@pytest.fixture
def place(spark, tmp_path):
    path = str(tmp_path / "bronze")
    table = CurrentTable(spark, str(tmp_path / "current"), buckets=8)

    def arrive(batch, *records):
        rows = [
            {"audio_filename": name, "processing_timestamp": at, "transcription": text, "batch_id": batch}
            for name, at, text in records
        ]
        write_batch(rows_frame(spark, rows, BRONZE), path, batch)

    return table, path, lambda: read_dataset(spark, path, BRONZE), arrive


def test_it_holds_what_ranking_all_of_bronze_gives(place):
    table, path, bronze, arrive = place
    arrive("b1", *[(f"n{i}.wav", "1", f"first {i}") for i in range(40)], (None, "1", "no name"))
    assert table.refresh(path, bronze) == ["b1"]
    arrive("b2", ("n3.mp3", "2", "later"), ("n4.wav", "0", "earlier"), (None, "2", "no name"))
    arrive("b3", ("n3.wav", "2", "tie"), ("new.wav", "1", "new"))
    assert table.refresh(path, bronze) == ["b2", "b3"] and table.refresh(path, bronze) == []
    found = rows_of(table.read().select(*BRONZE.names))
    assert found == rows_of(latest_bronze(bronze())) and len(found) == 43


def test_only_buckets_with_new_names_are_written_again(spark, place):
    table, path, bronze, arrive = place
    arrive("b1", *[(f"n{i}.wav", "1", "x") for i in range(60)])
    table.refresh(path, bronze)
    _, before = control.latest_version(spark, table.root)
    arrive("b2", ("n3.wav", "2", "y"))
    table.refresh(path, bronze)
    _, after = control.latest_version(spark, table.root)
    changed = [b for b in before["folders"] if after["folders"][b] != before["folders"][b]]
    assert len(before["folders"]) == 8 and len(changed) == 1


def test_reading_shuffles_nothing(spark, place, capsys):
    table, path, bronze, arrive = place
    arrive("b1", ("a.wav", "1", "x"), ("b.wav", "1", "y"))
    table.refresh(path, bronze)
    capsys.readouterr()
    table.read().explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Window" not in plan


def test_a_version_that_was_not_committed_is_not_seen(spark, place, monkeypatch):
    table, path, bronze, arrive = place
    assert table.read().count() == 0
    arrive("b1", ("a.wav", "1", "x"))
    table.refresh(path, bronze)
    arrive("b2", ("a.wav", "2", "y"))
    with monkeypatch.context() as patch:
        def broken(*args):
            raise ConnectionError("lost")

        patch.setattr(control, "commit_version", broken)
        with pytest.raises(ConnectionError):
            table.refresh(path, bronze)
    assert [r["transcription"] for r in table.read().collect()] == ["x"]
    assert table.refresh(path, bronze) == ["b2"]
    assert [r["transcription"] for r in table.read().collect()] == ["y"]


def test_a_batch_taken_in_again_is_replaced(place):
    table, path, bronze, arrive = place
    arrive("b1", ("a.wav", "1", "old a"), ("b.wav", "1", "b"))
    arrive("b2", ("a.wav", "2", "new a"))
    table.refresh(path, bronze)
    table.forget("b2")
    arrive("b2", ("c.wav", "2", "c"))
    assert table.refresh(path, bronze) == ["b1", "b2"]
    assert sorted(r["transcription"] for r in table.read().collect()) == ["b", "c", "old a"]
