import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from verbalance.schemas import INTAKE_AUDIT
from verbalance.sinks import compaction, control
from verbalance.sinks.datasets import write_batch, write_batches
from verbalance.sources.records import read_dataset


def batches(spark, first, last, rows=3):
    frame = spark.range(first * rows, last * rows).select(
        F.format_string("b%04d", (F.col("id") / rows).cast("int")).alias("batch_id"),
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("audio_file"),
        F.lit("success").alias("status"),
    )
    missing = [n for n in INTAKE_AUDIT.names if n not in frame.columns]
    nulls = {n: F.lit(None).cast("string") for n in missing}
    return frame.withColumns(nulls).select(*INTAKE_AUDIT.names).repartition(3, "batch_id")


@pytest.fixture
def place(spark, tmp_path):
    path = str(tmp_path / "audit")
    write_batches(batches(spark, 0, 200), path)
    return path


def read(spark, path):
    return read_dataset(spark, path, INTAKE_AUDIT)


def test_two_hundred_batches_give_few_files_and_the_same_rows(spark, place):
    before = rows_of(read(spark, place))
    assert len(read(spark, place).inputFiles()) >= 200 and len(before) == 600
    closed = compaction.compact(spark, place, INTAKE_AUDIT)
    assert len(closed) == 198 and len(read(spark, place).inputFiles()) <= 8
    assert rows_of(read(spark, place)) == before
    assert compaction.compact(spark, place, INTAKE_AUDIT) == []
    # Later batches are read beside, and rewritten in their turn.
    write_batches(batches(spark, 200, 260), place)
    assert read(spark, place).count() == 780
    assert len(compaction.compact(spark, place, INTAKE_AUDIT)) == 60
    found = read(spark, place)
    assert found.count() == found.distinct().count() == 780 and len(found.inputFiles()) <= 10
    assert found.where("batch_id = 'b0007'").count() == found.where("batch_id = 'b0259'").count() == 3


def test_one_that_breaks_off_changes_nothing(spark, place, monkeypatch):
    before = rows_of(read(spark, place))

    def broken(*args):
        raise ConnectionError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(control, "commit_version", broken)
        with pytest.raises(ConnectionError):
            compaction.compact(spark, place, INTAKE_AUDIT)
    assert rows_of(read(spark, place)) == before
    compaction.compact(spark, place, INTAKE_AUDIT)
    assert rows_of(read(spark, place)) == before


def test_closed_batches_stay_closed(spark, place):
    compaction.compact(spark, place, INTAKE_AUDIT)
    with pytest.raises(ValueError, match="closed"):
        write_batch(batches(spark, 5, 6), place, "b0005")
    write_batch(batches(spark, 199, 200).limit(1), place, "b0199")
    assert read(spark, place).count() == 598


def test_few_batches_are_left_alone(spark, tmp_path):
    path = str(tmp_path / "few")
    assert compaction.compact(spark, path, INTAKE_AUDIT) == []
    write_batches(batches(spark, 0, 10), path)
    assert compaction.compact(spark, path, INTAKE_AUDIT) == []
    assert len(compaction.compact(spark, path, INTAKE_AUDIT, least=3, open_batches=0)) == 10
    assert read(spark, path).count() == 30


def test_the_last_batches_of_every_stream_stay_open(spark, tmp_path):
    path = str(tmp_path / "streams")
    for stream in "ab":
        rows = batches(spark, 0, 4).withColumn("batch_id", F.concat(F.lit(f"stream_{stream}_"), "batch_id"))
        write_batches(rows, path)
    closed = compaction.compact(spark, path, INTAKE_AUDIT, least=1)
    assert closed == [f"stream_{s}_b000{i}" for s in "ab" for i in range(2)]
