import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from verbalance.operators import intake, recognize
from verbalance.plans import intake_batch
from verbalance.sources import files


def recognizer_for_bytes():
    def make():
        def recognize(content, path):
            if content.startswith(b"poison"):
                raise RuntimeError("cannot decode " + path.rsplit("/", 1)[-1])
            return content.decode("utf-8")

        return recognize

    return make


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    for name, content in {
        "a.wav": b"hello  big world",
        "b.MP3": b"poison",
        "c.ogg": " \n".encode(),
        "d e.flac": "déjà vu".encode(),
        "notes.txt": b"not audio",
    }.items():
        (folder / name).write_bytes(content)
    (folder / "below").mkdir()
    (folder / "below" / "x.wav").write_bytes(b"not looked at")
    (folder / "day=1").mkdir()
    (folder / "day=1" / "x.wav").write_bytes(b"not looked at")
    return folder


@pytest.fixture
def store(spark, tmp_path):
    return intake_batch.IntakeStore(spark, str(tmp_path / "store"))


def run(spark, drop, store, batch_id):
    found = files.discover(spark, str(drop))
    return intake_batch.take_in(found, store, batch_id, recognizer_for_bytes(), min_tasks=2)


def summary(frame):
    return tuple(frame.select("total_files", "successful", "failed", "skipped").first())


def test_discovery(spark, drop):
    found = files.discover(spark, str(drop))
    names = sorted(r["path"].rsplit("/", 1)[-1] for r in found.collect())
    assert names == ["a.wav", "b.MP3", "c.ogg", "d e.flac"]
    for spelled in (f"{drop}/", f"file:{drop}", f"file://{drop}"):
        assert files.discover(spark, spelled).count() == 4
    with pytest.raises(files.NoAudioFound):
        files.discover(spark, str(drop.parent))
    one = files.discover(spark, str(drop / "b.MP3")).collect()
    assert [r["length"] for r in one] == [6]


def test_discovery_reads_no_content(spark, drop, capsys):
    capsys.readouterr()
    files.discover(spark, str(drop)).explain()
    assert "ReadSchema: struct<path:string,length:bigint>" in capsys.readouterr().out


@pytest.mark.parametrize("name", ["notes.txt", "nowhere", "empty"])
def test_nothing_found_is_an_error(spark, drop, name):
    (drop.parent / "incoming" / "empty").mkdir()
    with pytest.raises(files.NoAudioFound):
        files.discover(spark, str(drop / name))


def test_batch(spark, drop, store):
    assert summary(run(spark, drop, store, "20240101_000000")) == (4, 2, 2, 0)
    records = {r["audio_filename"]: r for r in store.bronze().collect()}
    good, poison, blank = records["a.wav"], records["b.MP3"], records["c.ogg"]
    assert good["audio_id"] == hashlib.sha256(b"hello  big world").hexdigest()
    assert (good["transcription"], good["word_count"], good["transcription_length"]) == (
        "hello  big world", 3, 16)
    assert (good["file_type"], good["file_size_bytes"], good["status"]) == ("wav", 16, "success")
    assert (good["source"], good["model"], good["language"], good["pipeline_version"]) == (
        "local_audio", "whisper-base", "en", "1.0")
    assert good["processing_duration_seconds"] >= 0
    assert (poison["status"], poison["error"], poison["error_type"]) == (
        "failed", "cannot decode b.MP3", "RuntimeError")
    assert poison["audio_id"] and poison["transcription"] is None and poison["word_count"] == 0
    assert (blank["error"], blank["error_type"]) == ("Transcription is empty.", "EmptyTranscription")
    assert records["d e.flac"]["transcription"] == "déjà vu"

    audit = {r["audio_file"]: r for r in store.audit().collect()}
    assert audit["a.wav"]["transcription"] and audit["a.wav"]["audio_id"] is None
    assert audit["b.MP3"]["error_type"] == "RuntimeError" and audit["b.MP3"]["audio_id"] is None
    assert audit["c.ogg"]["audio_id"] and audit["c.ogg"]["error_type"] is None

    texts = spark.read.parquet(store.transcripts_path)
    assert rows_of(texts.select("base_name", "transcription")) == [
        ("a", "hello  big world"), ("d e", "déjà vu")]
    moves = spark.read.parquet(store.moves_path).groupBy("disposition").count()
    assert rows_of(moves) == [("failed", 2), ("processed", 2)]


def test_second_batch_tries_failures_again_and_skips_the_rest(spark, drop, store):
    run(spark, drop, store, "20240101_000000")
    (drop / "b.MP3").write_bytes(b"fine now")
    assert summary(run(spark, drop, store, "20240102_000000")) == (4, 1, 1, 2)
    skipped = store.audit().where("status = 'skipped'").select("audio_file", "reason")
    reason = "Already successfully processed"
    assert rows_of(skipped) == [("a.wav", reason), ("d e.flac", reason)]
    # The failure stays in the history, and both batches are kept.
    assert store.bronze().where("audio_filename = 'b.MP3'").count() == 2
    latest = store.latest()
    assert latest.columns == store.bronze().columns
    assert rows_of(latest.select("audio_filename", "status")) == [
        ("a.wav", "success"), ("b.MP3", "success"), ("c.ogg", "failed"), ("d e.flac", "success")]


def test_running_a_batch_again_replaces_it(spark, drop, store):
    first = summary(run(spark, drop, store, "20240101_000000"))
    assert summary(run(spark, drop, store, "20240101_000000")) == first
    assert store.bronze().count() == 4 and store.audit().count() == 4


def test_retry_without_any_success_leaves_no_old_transcript(spark, drop, store):
    run(spark, drop, store, "20240101_000000")
    for name in ("a.wav", "d e.flac"):
        (drop / name).write_bytes(b"poison")
    assert summary(run(spark, drop, store, "20240101_000000")) == (4, 0, 4, 0)
    assert spark.read.schema("base_name string, batch_id string").parquet(
        store.transcripts_path
    ).isEmpty()


def test_file_that_cannot_be_read_gets_no_record(spark, drop, store):
    found = files.discover(spark, str(drop)).union(
        spark.createDataFrame([(f"file:{drop}/gone.wav", 1)], "path string, length bigint")
    )
    with pytest.raises(Exception, match="FileNotFoundError"):
        intake_batch.take_in(found, store, "20240101_000000", recognizer_for_bytes())
    assert store.bronze().isEmpty() and store.audit().isEmpty()


def test_store_that_tasks_cannot_open_stops_the_run(spark, store):
    found = spark.createDataFrame([("dbfs:/in/a.wav", 1)], "path string, length bigint")
    with pytest.raises(recognize.UnsupportedStorage, match="dbfs"):
        intake_batch.take_in(found, store, "20240101_000000", recognizer_for_bytes())
    assert store.bronze().isEmpty()
    recognize.check_storage(spark.sql("select 's3a://b/a.wav' path union all select '/in/b.wav'"))


def test_model_that_cannot_be_loaded_fails_each_file(spark, drop):
    def make():
        raise OSError("no model")

    tried = recognize.transcribe(files.discover(spark, str(drop)), make).collect()
    assert {(r["error"], r["error_type"]) for r in tried} == {("no model", "OSError")}


def test_output_that_cannot_be_stored_fails_alone(spark):
    def make():
        outputs = {"0": "good", "1": b"bytes", "2": "\ud800", "3": None}

        def recognize(content, path):
            if path == "4":
                raise ValueError("bad \ud800")
            return outputs[path]

        return recognize

    frame = spark.range(5).selectExpr("cast(id as string) path", "1L length", "x'00' content")
    tried = recognize.transcribe(frame, make)
    assert rows_of(tried.select("path", "text", "error_type")) == [
        ("0", "good", None),
        ("1", None, "TypeError"),
        ("2", None, "UnicodeEncodeError"),
        ("3", None, None),
        ("4", None, "ValueError"),
    ]
    checked = intake.validate_text(tried).where("path = '3'").first()
    assert checked["error_type"] == "EmptyTranscription"


def test_model_is_loaded_once_per_task(spark, tmp_path):
    log = str(tmp_path / "loads")

    def make():
        with open(log, "a") as out:
            out.write("load\n")
        return lambda content, path: "text"

    frame = spark.range(300).selectExpr("cast(id as string) path", "1L length", "x'00' content")
    assert recognize.transcribe(frame.coalesce(1), make).count() == 300
    assert open(log).read() == "load\n"


@pytest.mark.parametrize(
    "outcomes, expected",
    [
        ([True, True, True], ["success", "skipped", "skipped"]),
        ([False, True, False], ["failed", "success", "skipped"]),
        ([False, False], ["failed", "failed"]),
    ],
)
def test_files_of_one_base_name(spark, outcomes, expected):
    rows = [(f"/d/a.{i}", "a", ok) for i, ok in enumerate(outcomes)] + [("/d/b.1", "b", True)]
    frame = spark.createDataFrame(rows, "path string, base_name string, recognized boolean")
    got = intake.settle(frame).where("base_name = 'a'").orderBy("path").select("status").collect()
    assert [r[0] for r in got] == expected


def test_prior_success_needs_an_id(spark):
    prior = spark.createDataFrame(
        [("a", "success", "1"), ("a", "success", "2"), ("b", "success", None),
         ("c", "success", ""), ("d", "failed", "1"), ("z", "success", "1")],
        "base_name string, status string, audio_id string",
    )
    found = spark.createDataFrame([(f"/d/{n}.wav", n) for n in "abcde"], "path string, base_name string")
    work = (found, prior)
    assert rows_of(intake.pending(*work).select("base_name")) == [("b",), ("c",), ("d",), ("e",)]
    assert rows_of(intake.already_done(*work).select("base_name")) == [("a",)]
    marked = intake.mark_done(*work)
    assert rows_of(marked.where("done").select("path")) == [("/d/a.wav",)]
    assert marked.count() == 5


def test_history_is_not_shuffled_for_few_files(spark, tmp_path, capsys):
    path = str(tmp_path / "history")
    spark.sql("select 'a' base_name, 'success' status, '1' audio_id").write.parquet(path)
    listed = str(tmp_path / "listed")
    spark.sql("select '/d/a.wav' path, 'a' base_name").write.parquet(listed)
    found = spark.read.parquet(listed)
    capsys.readouterr()
    intake.completed_names(spark.read.parquet(path), found).explain()
    plan = capsys.readouterr().out
    # The first shuffle above the scan of the history comes after the semi join.
    assert plan.index("Exchange hashpartitioning") < plan.index("LeftSemi") < plan.index("FileScan")
    assert "Exchange hashpartitioning" not in plan[plan.index("LeftSemi") : plan.index("FileScan")]


def test_content_id_is_sha256(spark):
    got = spark.sql("select cast('abc' as binary) c").select(intake.content_id(F.col("c"))).first()[0]
    assert got == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_two_runs_of_one_second_are_stored_apart(spark, drop, store):
    from datetime import datetime

    moment = datetime(2024, 1, 1)
    for name in ("a.wav", "new.wav"):
        (drop / name).write_bytes(name.encode())
        intake_batch.run_intake(
            spark, str(drop), store, recognizer_for_bytes(), now=lambda: moment
        )
    names = {r["audio_filename"] for r in store.bronze().where("status = 'success'").collect()}
    assert {"a.wav", "new.wav"} <= names


@pytest.mark.parametrize("broken", [0, 1, 2, 3])
def test_a_run_that_breaks_off_is_made_up_for(spark, drop, store, monkeypatch, broken):
    """Whichever write fails, the next run leaves every record, transcript and audit row."""
    write, calls = intake_batch.write_batch, []

    def failing(*args):
        calls.append(args)
        if len(calls) == broken + 1:
            raise OSError("disk gone")
        write(*args)

    monkeypatch.setattr(intake_batch, "write_batch", failing)
    with pytest.raises(OSError):
        run(spark, drop, store, "20240101_000000")
    monkeypatch.setattr(intake_batch, "write_batch", write)
    run(spark, drop, store, "20240102_000000")
    done = {r["audio_filename"] for r in store.bronze().where("status = 'success'").collect()}
    audited = {r["audio_file"] for r in store.audit().where("status = 'success'").collect()}
    texts = {r["base_name"] for r in spark.read.parquet(store.transcripts_path).collect()}
    assert done == audited == {"a.wav", "d e.flac"} and texts == {"a", "d e"}
