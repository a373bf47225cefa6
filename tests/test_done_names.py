import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_intake import recognizer_for_bytes
from verbalance.operators import intake
from verbalance.plans.intake_batch import IntakeStore, take_in
from verbalance.sinks import control
from verbalance.sinks.done_names import DoneNames


def named(spark, names, batch="b1"):
    return spark.createDataFrame([(n, batch) for n in names], "base_name string, batch_id string")


@pytest.fixture
def index(spark, tmp_path):
    return DoneNames(spark, str(tmp_path / "index"), buckets=16)


def read_folders(frame):
    return {f.rsplit("/", 2)[-2] for f in frame.inputFiles()}


def test_only_buckets_that_may_hold_a_name_are_read(spark, index):
    index.add(named(spark, [f"name {i}" for i in range(400)]), ["b1"])
    asked = named(spark, ["name 7", "name 8", "other"])
    own = {r[0] for r in asked.select(F.pmod(F.xxhash64("base_name"), F.lit(16))).collect()}
    found = index.lookup(asked)
    assert read_folders(found) <= {f"bucket={b}" for b in own} and len(found.inputFiles()) < 16
    held = found.join(asked.select("base_name"), "base_name", "left_semi")
    assert rows_of(held) == [("name 7", "b1"), ("name 8", "b1")]


def test_the_filter_spares_buckets_without_the_name(spark, index):
    index.add(named(spark, [f"name {i}" for i in range(400)]), ["b1"])
    strangers = [index.touched(named(spark, [f"stranger {i}"])) for i in range(6)]
    assert sum(map(len, strangers)) <= 1
    assert index.lookup(named(spark, ["stranger 0"])).count() <= 400 / 4


def test_no_name_is_ever_missed(spark, index):
    names = [f"n{i}-é" for i in range(300)]
    for batch in range(6):
        index.add(named(spark, names[batch * 50 : batch * 50 + 50], f"b{batch}"), [f"b{batch}"])
    assert index.batches() == {f"b{i}" for i in range(6)}
    found = index.lookup(named(spark, names)).select("base_name").distinct()
    assert found.count() == 300
    _, state = control.latest_version(spark, index.root)
    assert len(state["runs"]) < 6 and sum(r["names"] for r in state["runs"]) == 300


def test_adding_a_batch_again_and_dropping_one(spark, index):
    index.add(named(spark, ["a", "b"]), ["b1"])
    index.add(named(spark, ["x"]), ["b1"])
    index.add(named(spark, ["c"], "b2"), ["b2", "without names"])
    assert rows_of(index.lookup(named(spark, ["a", "b", "c", "x"]))) == [("a", "b1"), ("b", "b1"), ("c", "b2")]
    index.drop("b1")
    assert index.batches() == {"b2", "without names"}
    assert rows_of(index.lookup(named(spark, ["a", "c"]))) == [("c", "b2")]


def test_two_writers_do_not_overwrite_each_other(spark, index):
    index.add(named(spark, ["a"]), ["b1"])
    with pytest.raises(control.Conflict):
        control.commit_version(spark, index.root, 1, {})


def test_an_empty_index_and_null_names(spark, index):
    asked = named(spark, ["a", None])
    assert index.lookup(asked).count() == 0
    index.add(named(spark, [None, "a"]), ["b1"])
    assert rows_of(index.lookup(asked)) == [("a", "b1")]


def files(spark, *rows):
    return spark.createDataFrame(
        [(p, len(c), bytearray(c)) for p, c in rows], "path string, length bigint, content binary"
    )


def test_a_batch_uses_the_index_and_makes_good_for_one_that_broke_off(spark, tmp_path):
    store = IntakeStore(spark, str(tmp_path / "store"))
    first = files(spark, ("/d/a.wav", b"hello"), ("/d/b.wav", b"poison"))
    take_in(first, store, "b1", recognizer_for_bytes(), min_tasks=1)
    assert store.index.batches() == set()
    second = files(spark, ("/d/a.mp3", b"again"), ("/d/b.mp3", b"fine"))
    summary = take_in(second, store, "b2", recognizer_for_bytes(), min_tasks=1)
    assert tuple(summary.select("total_files", "successful", "skipped").first()) == (2, 1, 1)
    # The batch before was taken up only now.
    assert store.index.batches() == {"b1"}


def test_a_batch_taken_in_again_does_not_skip_itself(spark, tmp_path):
    store = IntakeStore(spark, str(tmp_path / "store"))
    one = files(spark, ("/d/a.wav", b"hello"))
    for batch in ("b1", "b2", "b1"):
        take_in(one, store, batch, recognizer_for_bytes(), min_tasks=1)
    # The second batch skipped the file, and the first does so no more than before.
    statuses = {(r["batch_id"], r["status"]) for r in store.audit().collect()}
    assert statuses == {("b1", "success"), ("b2", "skipped")}
    assert store.index.batches() == {"b2"}


def test_names_of_the_index_mark_as_the_history_does(spark, index):
    listed = spark.createDataFrame([(f"/d/n{i}.wav", f"n{i}") for i in range(60)], "path string, base_name string")
    prior = spark.createDataFrame(
        [(f"n{i}", "success" if i % 3 else "failed", "x" if i % 5 else None) for i in range(40)],
        "base_name string, status string, audio_id string",
    )
    done = prior.where("status = 'success' and audio_id <> ''").select("base_name", F.lit("b1").alias("batch_id"))
    index.add(done, ["b1"])
    by_index = intake.mark_names(listed, index.lookup(listed))
    assert rows_of(by_index.select("path", "done")) == rows_of(intake.mark_done(listed, prior).select("path", "done"))
