"""Counts without the join against counts over the joined rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from verbalance.operators import dedup, quality, reconcile, skew, summaries, tallies

TEXTS = [None, "", " ", "a b", "A, b!", "a  b", "a b c", "zz", "\n a b", "é", "ü"]


def make_sides(spark, seed, silver_rows, reference_rows):
    rng = random.Random(seed)

    def key():
        return rng.choice(["hot"] * 6 + ["a", "b", "c", "d", None])

    bronze = [
        (key(), f"f{i}.wav", f"b{i % 3}", rng.choice(["success"] * 4 + ["failed", None]), rng.choice(TEXTS))
        for i in range(silver_rows)
    ]
    reference = [(key(), f"r{i}.wav", rng.choice(TEXTS)) for i in range(reference_rows)]
    bronze = spark.createDataFrame(
        bronze,
        "audio_id string, audio_file string, batch_id string, status string, transcription string",
    )
    return bronze, spark.createDataFrame(
        reference, "audio_id string, audio_file string, expected_transcription string"
    )


@pytest.fixture(params=[(1, 60, 40), (2, 200, 3), (3, 0, 5), (4, 20, 0)])
def sides(request, spark):
    return make_sides(spark, *request.param)


def test_summaries_of_sides_equal_summaries_of_joined_rows(sides):
    bronze, reference = sides
    silver = reconcile.silver(bronze)
    validated = reconcile.validate(reconcile.join_expected(silver, reference))
    for of_sides, of_rows in (
        (summaries.reconciliation_of_sides, summaries.reconciliation_summary),
        (summaries.quality_of_sides, summaries.quality_summary),
        (summaries.reasons_of_sides, summaries.reason_breakdown),
    ):
        got, expected = of_sides(silver, reference), of_rows(validated)
        assert got.columns == expected.columns
        assert got.collect() == expected.collect()


def test_counts_from_tallies_equal_counts_of_stages(sides):
    bronze, reference = sides
    silver = reconcile.silver(bronze)
    joined = reconcile.join_expected(silver, reference)
    keys = tallies.key_tallies(bronze, reference)
    counts = tallies.stage_counts(keys).first()
    assert counts["bronze_count"] == bronze.count()
    assert counts["silver_count"] == silver.count()
    assert counts["reference_count"] == reference.count()
    assert counts["joined_count"] == joined.count()
    assert counts["before_dedup_count"] - counts["after_dedup_count"] == counts["duplicates_removed"]
    assert counts["after_dedup_count"] == joined.dropDuplicates(["audio_id"]).count()
    assert rows_of(tallies.joined_duplicates(keys)) == rows_of(quality.duplicates(joined))
    gates = {r["check_name"]: (r["failing_groups"], r["passed"]) for r in tallies.gate_results(keys).collect()}
    for name, frame in (("bronze", bronze), ("reference", reference), ("joined", joined)):
        groups = quality.duplicates(frame).count()
        assert gates[f"{name}_duplicates"] == (groups, groups == 0)


def test_labels_without_texts_equal_labels_with_texts(sides):
    bronze, reference = sides
    silver = reconcile.silver(bronze)
    with_texts = reconcile.validate(reconcile.join_expected(silver, reference))
    labelled = reconcile.validate_labels(silver, reference)
    names = sorted(labelled.columns)
    assert rows_of(labelled.select(*names)) == rows_of(with_texts.select(*names))


def test_hot_keys_change_nothing(spark):
    bronze, reference = make_sides(spark, 5, 120, 60)
    silver = reconcile.silver(bronze)
    hot = skew.find_hot(silver, reference, "audio_id", per_split=10)
    assert hot is not None
    plain = reconcile.gold(reconcile.validate(reconcile.join_expected(silver, reference)))
    spread = reconcile.gold(reconcile.validate(reconcile.join_expected(silver, reference, hot)))
    assert rows_of(spread) == rows_of(plain)
    labels = reconcile.validate_labels(silver, reference)
    assert rows_of(reconcile.validate_labels(silver, reference, hot).select(*labels.columns)) == rows_of(labels)


def test_properties_of_summaries(spark):
    bronze, reference = make_sides(spark, 6, 150, 50)
    silver = reconcile.silver(bronze)
    validated = reconcile.validate(reconcile.join_expected(silver, reference))
    match = summaries.reconciliation_of_sides(silver, reference).first()
    status = summaries.quality_of_sides(silver, reference).first()
    reasons = summaries.reasons_of_sides(silver, reference).collect()
    assert match["match_count"] + match["mismatch_count"] == match["total_records"]
    assert status["pass_count"] + status["review_count"] == status["total_records"]
    assert sum(r["record_count"] for r in reasons) == match["total_records"]
    exact = validated.where("transcription_match = 'MATCH'")
    assert exact.where("normalized_match <> 'MATCH'").isEmpty()


def test_summary_of_no_rows(spark):
    bronze, reference = make_sides(spark, 7, 0, 0)
    silver = reconcile.silver(bronze)
    assert summaries.reconciliation_of_sides(silver, reference).first() == (0, None, None, None)
    assert summaries.quality_of_sides(silver, reference).first() == (0, None, None, None, None)
    assert summaries.reasons_of_sides(silver, reference).collect() == []


def test_null_expected_text_is_a_mismatch_to_review(spark):
    bronze = spark.createDataFrame(
        [("x", "x.wav", "b", "success", "a b")],
        "audio_id string, audio_file string, batch_id string, status string, transcription string",
    )
    reference = spark.createDataFrame(
        [("x", "x.wav", None)], "audio_id string, audio_file string, expected_transcription string"
    )
    row = reconcile.validate(reconcile.join_expected(reconcile.silver(bronze), reference)).first()
    assert row["transcription_match"] == row["normalized_match"] == "MISMATCH"
    assert row["normalized_word_count_difference"] is None
    assert (row["quality_status"], row["quality_reason"]) == ("REVIEW", "TRANSCRIPTION_REVIEW")


def test_texts_without_word_characters_match(spark):
    bronze = spark.createDataFrame(
        [("x", "x.wav", "b", "success", "é")],
        "audio_id string, audio_file string, batch_id string, status string, transcription string",
    )
    reference = spark.createDataFrame(
        [("x", "x.wav", "ü")], "audio_id string, audio_file string, expected_transcription string"
    )
    row = reconcile.validate(reconcile.join_expected(reconcile.silver(bronze), reference)).first()
    assert (row["transcription_match"], row["normalized_match"]) == ("MISMATCH", "MATCH")


def test_deduplicated_is_the_first_joined_row_per_key(spark):
    bronze, reference = make_sides(spark, 8, 100, 40)
    silver = reconcile.silver(bronze)
    joined = reconcile.validate(reconcile.join_expected(silver, reference))
    order = [F.asc_nulls_first("audio_file"), F.asc_nulls_first("batch_id")]
    order += [
        F.asc_nulls_first(F.sha2(c, 256)) for c in ("transcription_clean", "expected_transcription")
    ]
    expected = dedup.first_per_key(joined, "audio_id", order)
    got = reconcile.deduplicated(silver, reference)
    assert rows_of(got) == rows_of(expected.select(*got.columns))


def test_copies_are_dropped_before_the_shuffle(spark):
    frame = spark.range(100).selectExpr("id % 3 as key", "id")
    plan = dedup.first_per_key(frame, "key", [F.col("id")])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    final, exchange, partial = (
        physical.index(word) for word in ("1, Final", "Exchange hashpartitioning", "1, Partial")
    )
    assert final < exchange < partial


def shuffled_columns(frame, capsys):
    """Names of the columns that go through a shuffle, for each one in the plan."""
    capsys.readouterr()
    frame.explain("formatted")
    blocks = capsys.readouterr().out.split("\n\n")
    shuffles = [b for b in blocks if re.match(r"\s*\(\d+\) Exchange", b)]
    return [set(re.findall(r"(\w+)#\d+", re.search(r"Input \[.*", b)[0])) for b in shuffles]


def test_texts_are_not_shuffled_for_labels(spark, capsys):
    bronze, reference = make_sides(spark, 9, 20, 20)
    silver = reconcile.silver(bronze)
    texts = {"transcription", "transcription_clean", "expected_transcription"}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (
            reconcile.validate_labels(silver, reference),
            reconcile.deduplicated(silver, reference),
            summaries.reasons_of_sides(silver, reference),
            tallies.key_tallies(bronze, reference),
        ):
            shuffled = shuffled_columns(frame, capsys)
            assert shuffled and not any(texts & columns for columns in shuffled)
        gold = reconcile.gold(reconcile.validate(reconcile.join_expected(silver, reference)))
        # Gold needs the texts, but only one copy of each is moved.
        assert [texts & columns for columns in shuffled_columns(gold, capsys)] == [
            {"transcription_clean"},
            {"expected_transcription"},
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sides_normalized_before_the_join_give_the_same_rows(spark):
    bronze, reference = make_sides(spark, 11, 60, 40)
    silver = reconcile.silver(bronze)
    plain = reconcile.gold(reconcile.validate(reconcile.join_expected(silver, reference)))
    hot = skew.find_hot(silver, reference, "audio_id", per_split=5)
    for given in (None, hot):
        sides_first = reconcile.gold(reconcile.validate_sides(silver, reference, given))
        assert sides_first.schema == plain.schema and rows_of(sides_first) == rows_of(plain)


def test_texts_are_normalized_once_however_many_rows_copies_give(spark, tmp_path, monkeypatch):
    from checks import queries
    from verbalance.functions import text

    spark.range(60).selectExpr(
        "id as doc_id", "'One, two.' as text", "'en' as lang", "'web' as source", "9L as n_chars"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    texts = spark.sparkContext.accumulator(0)

    def counted(words):
        texts.add(1)
        return words and words.lower()

    monkeypatch.setattr(text, "normalize", F.udf(counted, "string"))
    joined = len(queries.gold(spark, str(tmp_path)).collect())
    assert joined > 2000 and 0 < texts.value <= 4 * 60
