"""Files that leave the drop folder, listings by tasks, and runs over an unchanged folder."""

import hashlib
import os

import pytest

from tests.conftest import rows_of
from tests.test_intake import recognizer_for_bytes, summary
from verbalance.operators import recognize
from verbalance.plans import intake_batch
from verbalance.plans.intake_batch import IntakeStore, run_intake
from verbalance.sinks import control, moves
from verbalance.sources import files, listing


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    for name, content in {"a.wav": b"hello", "b.MP3": b"poison", "c.ogg": b" ", "n.txt": b"no audio"}.items():
        (folder / name).write_bytes(content)
    return folder


@pytest.fixture
def store(spark, tmp_path):
    folders = {"processed": str(tmp_path / "processed"), "failed": str(tmp_path / "failed")}
    return IntakeStore(spark, str(tmp_path / "store"), folders)


def counting(tmp_path):
    """A recognizer that leaves a mark for each call."""
    marks = tmp_path / "marks"
    marks.mkdir(exist_ok=True)

    def make():
        import uuid

        inner = recognizer_for_bytes()()

        def recognize(content, path):
            (marks / uuid.uuid4().hex).write_bytes(b"")
            return inner(content, path)

        return recognize

    return make, lambda: len(list(marks.iterdir()))


def held(folder):
    return sorted(p.name for p in folder.iterdir()) if folder.exists() else []


def test_files_go_where_they_belong(spark, tmp_path, drop, store):
    assert summary(run_intake(spark, str(drop), store, recognizer_for_bytes())) == (3, 1, 2, 0)
    assert held(tmp_path / "processed") == ["a.wav"] and held(drop) == ["n.txt"]
    assert held(tmp_path / "failed") == ["b.MP3", "c.ogg"]
    assert (tmp_path / "processed" / "a.wav").read_bytes() == b"hello"
    # What comes again under a done name is skipped and stays; a failed one is tried again.
    (drop / "a.mp3").write_bytes(b"again")
    (drop / "b.MP3").write_bytes(b"fine")
    assert summary(run_intake(spark, str(drop), store, recognizer_for_bytes())) == (2, 1, 0, 1)
    assert held(drop) == ["a.mp3", "n.txt"] and held(tmp_path / "processed") == ["a.wav", "b.MP3"]
    # The earlier failure stays where it was moved to.
    assert held(tmp_path / "failed") == ["b.MP3", "c.ogg"]


def test_broken_off_moves_are_resumed(spark, tmp_path, drop, store, monkeypatch):
    def broken(*args):
        raise ConnectionError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(moves, "follow", broken)
        with pytest.raises(ConnectionError):
            run_intake(spark, str(drop), store, recognizer_for_bytes())
    assert held(drop) == ["a.wav", "b.MP3", "c.ogg", "n.txt"] and store.bronze().count() == 3
    # One file was moved before, and another one came under the name of the second.
    (tmp_path / "processed").mkdir()
    os.rename(drop / "a.wav", tmp_path / "processed" / "a.wav")
    (drop / "b.MP3").write_bytes(b"another file")
    make, calls = counting(tmp_path)
    assert summary(run_intake(spark, str(drop), store, make)) == (1, 1, 0, 0)
    assert calls() == 1 and held(drop) == ["n.txt"]
    assert held(tmp_path / "processed") == ["a.wav", "b.MP3"] and held(tmp_path / "failed") == ["c.ogg"]
    results = spark.read.parquet(store.moved_path).select("result")
    assert sorted(r[0] for r in results.collect()) == ["moved", "moved", "moved", "replaced"]
    with pytest.raises(files.NoAudioFound):
        run_intake(spark, str(drop), store, make)


def test_moves_without_bronze_are_not_made(spark, tmp_path, drop, store, monkeypatch):
    def broken(*args):
        raise ConnectionError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(intake_batch.intake, "bronze_records", broken)
        with pytest.raises(ConnectionError):
            run_intake(spark, str(drop), store, recognizer_for_bytes())
    store.finish_open_moves()
    assert held(drop) == ["a.wav", "b.MP3", "c.ogg", "n.txt"]


def test_an_unchanged_folder_calls_no_recognizer_and_writes_no_rows(spark, tmp_path, drop):
    store = IntakeStore(spark, str(tmp_path / "store"))
    make, calls = counting(tmp_path)
    assert summary(run_intake(spark, str(drop), store, make, only_new=True)) == (3, 1, 2, 0)
    before = [rows_of(store.audit()), rows_of(store.bronze())]
    assert run_intake(spark, str(drop), store, make, only_new=True).count() == 0
    assert calls() == 3 and before == [rows_of(store.audit()), rows_of(store.bronze())]
    # A failed file that changed is tried again, one that did not is left alone.
    (drop / "b.MP3").write_bytes(b"fine now")
    assert summary(run_intake(spark, str(drop), store, make, only_new=True)) == (1, 1, 0, 0)
    assert calls() == 4


def test_a_broken_run_does_not_count_as_the_last_listing(spark, tmp_path, drop):
    store = IntakeStore(spark, str(tmp_path / "store"))

    def unusable():
        raise SystemExit("no worker")

    with pytest.raises(Exception):
        run_intake(spark, str(drop), store, unusable, only_new=True)
    assert summary(run_intake(spark, str(drop), store, recognizer_for_bytes(), only_new=True)) == (3, 1, 2, 0)


def test_nested_folders_are_listed_by_tasks(spark, tmp_path):
    root = tmp_path / "deep"
    for i in range(5):
        folder = root / f"d {i}" / "é"
        folder.mkdir(parents=True)
        for j in range(4):
            (folder / f"{j}.wav").write_bytes(b"x" * j)
    (root / "top.txt").write_bytes(b"t")
    os.symlink(root / "top.txt", root / "link.wav")
    found = listing.list_files(spark, f"file:{root}", str(tmp_path / "l1"), recursive=True)
    assert found.count() == 22
    assert rows_of(found.where("path like '%/d 3/%'").select("path", "length")) == [
        (f"file:{root}/d 3/é/{j}.wav", j) for j in range(4)
    ]
    flat = listing.list_files(spark, f"file:{root}", str(tmp_path / "l2"))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in flat.collect()) == ["link.wav", "top.txt"]
    # Spelled as Spark's own listing does it, which leaves out empty files.
    spelled = {r["path"] for r in spark.read.format("binaryFile").load(f"{root}/d 1/é").select("path").collect()}
    assert spelled == {r["path"] for r in found.where("path like '%/d 1/%' and length > 0").collect()}


def test_changes_between_two_listings(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "abc":
        (tmp_path / "in" / name).write_bytes(b"1")
    before = listing.list_files(spark, str(tmp_path / "in"), str(tmp_path / "l1"))
    (tmp_path / "in" / "a").unlink()
    (tmp_path / "in" / "b").write_bytes(b"22")
    (tmp_path / "in" / "d").write_bytes(b"")
    os.utime(tmp_path / "in" / "c", (5, 5))
    after = listing.list_files(spark, str(tmp_path / "in"), str(tmp_path / "l2"))
    found = [(r["path"][-1], r["change"]) for r in listing.changes(before, after).collect()]
    assert sorted(found) == [("a", "gone"), ("b", "changed"), ("c", "changed"), ("d", "new")]
    assert listing.changes(after, after).count() == 0


def test_an_intake_of_nested_folders(spark, tmp_path):
    (tmp_path / "in" / "x" / "y").mkdir(parents=True)
    (tmp_path / "in" / "x" / "y" / "deep.wav").write_bytes(b"deep")
    (tmp_path / "in" / "flat.wav").write_bytes(b"flat")
    store = IntakeStore(spark, str(tmp_path / "store"))
    assert summary(run_intake(spark, str(tmp_path / "in"), store, recognizer_for_bytes(), recursive=True)) == (2, 2, 0, 0)


def test_a_large_file_is_hashed_in_pieces(spark, tmp_path):
    """Two gigabytes of zeros through a stream; the worker's peak memory hardly grows."""
    size = 2 * 1024**3
    with open(tmp_path / "big.wav", "wb") as file:
        file.truncate(size)
    (tmp_path / "a.wav").write_bytes(b"first")

    def make():
        import resource

        def length_and_peak(stream, path):
            total = 0
            while part := stream.read(1 << 20):
                total += len(part)
            return f"{total} {resource.getrusage(resource.RUSAGE_SELF).ru_maxrss}"

        return length_and_peak

    rows = spark.createDataFrame(
        [(str(tmp_path / n), 0) for n in ("a.wav", "big.wav")], "path string, length bigint"
    ).coalesce(1)
    found = recognize.transcribe(rows, make, by_stream=True).collect()
    (first, before), (total, after) = [map(int, r["text"].split()) for r in found]
    assert (first, total) == (5, size) and after - before < 200 * 1024
    digest = hashlib.sha256()
    for _ in range(2048):
        digest.update(bytes(1024**2))
    assert found[1]["audio_id"] == digest.hexdigest()


def test_files_of_a_store_that_only_spark_opens(spark, tmp_path, drop, monkeypatch):
    store = IntakeStore(spark, str(tmp_path / "store"))
    monkeypatch.setattr(recognize, "ARROW_SCHEMES", {"s3": "s3"})
    assert summary(run_intake(spark, str(drop), store, recognizer_for_bytes())) == (3, 1, 2, 0)


def test_versions_of_a_control_file(spark, tmp_path):
    root = str(tmp_path / "v")
    assert control.latest_version(spark, root) == (0, None)
    control.commit_version(spark, root, 1, {"a": "é"})
    control.commit_version(spark, root, 2, [2])
    assert control.latest_version(spark, root) == (2, [2])
    assert control.names(spark, f"{root}/none") == []
