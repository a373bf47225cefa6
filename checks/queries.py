"""The registered queries: one per operator, each over whole tables.

A query that covers a source or a sink writes a table below the cluster's shared
folder and reads it back through the code under check.
"""

from pyspark.sql import functions as F

from checks import fixtures as fx
from verbalance import fixed, session
from verbalance.functions import labels, measures, paths, text
from verbalance.operators import (
    dedup,
    intake,
    quality,
    recognize,
    reconcile,
    skew,
    summaries,
    tallies,
)
from verbalance.plans.intake_batch import IntakeStore, run_intake
from verbalance.plans.run_audit import audited_run
from verbalance.schemas import BRONZE, INTAKE_AUDIT, RUN_AUDIT
from verbalance.sinks import datasets
from verbalance.sinks.current import CurrentTable
from verbalance.sinks.done_names import DoneNames
from verbalance.sources import files as file_source
from verbalance.sources import listing, records
from verbalance.streaming import incremental

LABEL_COLUMNS = (
    "audio_id",
    "audio_file",
    "transcription_match",
    "normalized_match",
    "cleaned_word_count",
    "expected_word_count",
    "word_count_difference",
    "generated_normalized_word_count",
    "expected_normalized_word_count",
    "normalized_word_count_difference",
    "quality_status",
    "quality_reason",
)


# --- inputs -----------------------------------------------------------------


def _bronze(spark, sf_dir):
    return reconcile.with_audio_file(fx.bronze(spark, sf_dir))


def _silver(spark, sf_dir):
    return reconcile.silver(_bronze(spark, sf_dir))


def _reference(spark, sf_dir):
    return reconcile.prepare_reference(fx.table(spark, sf_dir, "fx_reference"))


def _sides(spark, sf_dir):
    silver, reference = _silver(spark, sf_dir), _reference(spark, sf_dir)
    hot = skew.find_hot(
        silver,
        reference,
        "audio_id",
        left_bytes=F.octet_length("transcription"),
        right_bytes=F.octet_length("expected_transcription"),
    )
    return silver, reference, hot


def _joined(spark, sf_dir):
    return reconcile.join_expected(*_sides(spark, sf_dir))


def _validated(spark, sf_dir):
    return reconcile.validate_sides(*_sides(spark, sf_dir))


def _labelled(spark, sf_dir):
    return reconcile.validate_labels(*_sides(spark, sf_dir))


def _tallies(spark, sf_dir):
    return tallies.key_tallies(_bronze(spark, sf_dir), _reference(spark, sf_dir))


def _audio(spark, sf_dir):
    files = file_source.audio_only(fx.table(spark, sf_dir, "fx_files"))
    return intake.with_file_facts(files)


def _recognizer():
    """A stand-in recognizer that takes the bytes of a file for its speech, and a clock.

    They are local functions, so that they are shipped with the task.
    """

    def make_recognizer():
        return lambda content, path: content.decode("utf-8")

    def clock():
        return "2024-01-01T00:00:00"

    return make_recognizer, clock


def _attempts(files):
    """Recognized and validated files; written, as the recognizer must run only once."""
    tried = recognize.transcribe(files, *_recognizer())
    path = session.scratch_path(files.sparkSession, "attempts")
    return intake.validate_text(intake.with_file_facts(session.written(tried, path)))


def _all_attempts(spark, sf_dir):
    return _attempts(file_source.audio_only(fx.table(spark, sf_dir, "fx_files")))


def _outcome(spark, sf_dir):
    """All audio files of a batch with their status, as intake writes them."""
    files, prior, hot = _work(spark, sf_dir)
    # Decided on names; the rows that hold content are looked up by path.
    marked = session.written(
        intake.mark_done(files.drop("content"), prior, hot), session.scratch_path(spark, "marked")
    )
    todo = files.join(marked.where("not done").select("path"), "path", "left_semi")
    skipped = (
        marked.where("done")
        .withColumn("ingestion_timestamp", F.lit(fx.STARTED))
        .withColumn("status", F.lit(fixed.SKIPPED))
        .drop("doc_id", "done")
    )
    settled = intake.settle(_attempts(todo), hot)
    return intake.with_batch_stamps(
        settled.unionByName(skipped, allowMissingColumns=True), fx.BATCH
    )


# --- sources and sinks --------------------------------------------------------


def intake_discover(spark, sf_dir):
    return file_source.audio_only(fx.table(spark, sf_dir, "fx_files")).select("path", "length")


def bronze_scan(spark, sf_dir):
    path = session.scratch_path(spark, "bronze_json")
    fx.bronze(spark, sf_dir).write.json(path, ignoreNullFields=True)
    return records.read_json_records(spark, path, multi_line=False)


def _reference_table(spark, sf_dir):
    return session.written(
        fx.table(spark, sf_dir, "fx_reference"), session.scratch_path(spark, "reference")
    )


def reference_scan(spark, sf_dir):
    return _reference_table(spark, sf_dir).select(
        "audio_id",
        "audio_file",
        "expected_transcription",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
    )


def reference_smoke_count(spark, sf_dir):
    return _reference_table(spark, sf_dir).agg(F.count(F.lit(1)).alias("record_count"))


def audit_history_scan(spark, sf_dir):
    path = session.scratch_path(spark, "intake_audit")
    datasets.write_batch(intake.audit_rows(_outcome(spark, sf_dir)), path, fx.BATCH)
    return records.read_audit_history(spark, path)


def intake_audit_append(spark, sf_dir):
    path = session.scratch_path(spark, "intake_audit")
    rows = session.written(
        intake.audit_rows(_outcome(spark, sf_dir)), session.scratch_path(spark, "audit_rows")
    )
    datasets.write_batch(rows, path, fx.BATCH)
    # The second batch is tried again; its rows are replaced, not doubled.
    for _ in range(2):
        datasets.write_batch(rows, path, "20240102_000000")
    return records.read_audit_history(spark, path)


def bronze_latest(spark, sf_dir):
    path = session.scratch_path(spark, "bronze")
    datasets.write_batches(_shared_names(spark, sf_dir), path)
    stored = records.read_dataset(spark, path, BRONZE)
    latest = dedup.latest_records(stored, paths.base_name(F.col("audio_filename")))
    return latest.select(
        "base_name", "batch_id", "audio_id", "audio_filename", "status", "processing_timestamp"
    )


def bronze_current(spark, sf_dir):
    """The rows of ``bronze_latest`` from the table that is kept; its batches come in two parts."""
    root = session.scratch_path(spark, "current")
    rows = session.written(_shared_names(spark, sf_dir), f"{root}/rows")
    table, path = CurrentTable(spark, f"{root}/current"), f"{root}/bronze"
    batches = sorted(r[0] for r in rows.select("batch_id").distinct().collect())
    for part in (batches[::2], batches[1::2]):
        datasets.write_batches(rows.where(F.col("batch_id").isin(part)), path)
        table.refresh(path, lambda: records.read_dataset(spark, path, BRONZE))
    return table.read().select(
        paths.base_name(F.col("audio_filename")).alias("base_name"),
        "batch_id",
        "audio_id",
        "audio_filename",
        "status",
        "processing_timestamp",
    )


def _shared_names(spark, sf_dir):
    """Bronze with three records per base name, told apart by their extension."""
    number = F.regexp_extract("audio_filename", r"\d+", 0).cast("bigint")
    extension = F.when(number % 3 == 0, ".wav").when(number % 3 == 1, ".mp3").otherwise(".ogg")
    shared = F.concat(F.lit("doc_"), (number - number % 3).cast("string"), extension)
    return fx.bronze(spark, sf_dir).withColumn("audio_filename", shared)


def transcript_export(spark, sf_dir):
    path = session.scratch_path(spark, "transcripts")
    datasets.write_batch(intake.transcripts(_outcome(spark, sf_dir)), path, fx.BATCH)
    return spark.read.parquet(path).select("base_name", "transcription")


def disposition_split(spark, sf_dir):
    path = session.scratch_path(spark, "dispositions")
    moves = intake.dispositions(_outcome(spark, sf_dir)).select("path", "status", "disposition")
    datasets.write_split(moves, path, "disposition")
    return spark.read.parquet(path).select("path", "status", "disposition")


def _audit_values(spark, path):
    return records.read_dataset(spark, path, RUN_AUDIT).drop(
        "run_id", "run_start_time", "run_end_time", "run_duration_seconds"
    )


def _record_counts(run, counts):
    row = counts.first()
    run.record(
        bronze_record_count=row["bronze_count"],
        silver_record_count=row["silver_count"],
        joined_record_count=row["joined_count"],
        final_record_count=row["gold_count"],
    )


def run_audit(spark, sf_dir):
    path = session.scratch_path(spark, "run_audit")
    with audited_run(spark, datasets.dataset_appender(path)) as run:
        _record_counts(run, stage_counts(spark, sf_dir))
    return _audit_values(spark, path)


def run_audit_failure(spark, sf_dir):
    """A run whose second step fails: the counts of the first step are kept."""
    path = session.scratch_path(spark, "run_audit")
    try:
        with audited_run(spark, datasets.dataset_appender(path)) as run:
            row = quality.bronze_checks(_bronze(spark, sf_dir)).first()
            run.record(
                bronze_record_count=row["bronze_count"], silver_record_count=row["silver_count"]
            )
            raise ConnectionError("reference table is not reachable")
    except ConnectionError:
        return _audit_values(spark, path)


def run_audit_roundtrip(spark, sf_dir):
    """A successful and a failed run appended to the same table."""
    path = session.scratch_path(spark, "run_audit")
    append = datasets.dataset_appender(path)
    with audited_run(spark, append) as run:
        _record_counts(run, stage_counts(spark, sf_dir))
    try:
        with audited_run(spark, append):
            raise ValueError("no bronze")
    except ValueError:
        return _audit_values(spark, path)


# --- bronze and silver --------------------------------------------------------


def bronze_view(spark, sf_dir):
    return _bronze(spark, sf_dir).select(
        "audio_file", "status", "transcription", "word_count", "processing_duration_seconds"
    )


def bronze_dq(spark, sf_dir):
    gaps = reconcile.with_audio_file(fx.table(spark, sf_dir, "fx_gaps"))
    return quality.bronze_checks(gaps)


def silver(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        "audio_id", "audio_file", "batch_id", "transcription_clean", "cleaned_word_count"
    )


def silver_view(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        "audio_file", "word_count", "transcription_clean", "cleaned_word_count"
    )


def reference_prepared(spark, sf_dir):
    return _reference(spark, sf_dir)


def bronze_validate(spark, sf_dir):
    raw = fx.table(spark, sf_dir, "fx_texts").withColumns(
        {"error": F.lit(None).cast("string"), "error_type": F.lit(None).cast("string")}
    )
    return intake.validate_text(raw).select(
        "doc_id",
        F.when(F.col("recognized"), fixed.SUCCESS).otherwise(fixed.FAILED).alias("status"),
        "transcription",
        "transcription_length",
        "word_count",
        "error",
        "error_type",
    )


def bronze_metrics(spark, sf_dir):
    words = F.col("text")
    return fx.table(spark, sf_dir, "fx_texts").select(
        "doc_id",
        F.length(words).alias("transcription_length"),
        text.unicode_word_count(words).alias("word_count"),
    )


def processing_duration(spark, sf_dir):
    start, end = F.col("ingestion_timestamp"), F.col("processing_timestamp")
    return fx.table(spark, sf_dir, "fx_bronze").select(
        "audio_filename",
        measures.record_duration(start, end).alias("processing_duration_seconds"),
        measures.elapsed_seconds(start, end).alias("elapsed_seconds"),
    )


# --- text rules ---------------------------------------------------------------


def text_clean(spark, sf_dir):
    cleaned = text.clean(F.col("text"))
    return (
        fx.table(spark, sf_dir, "fx_texts")
        .select("doc_id", cleaned.alias("cleaned"))
        .withColumn("word_count", text.space_word_count(F.col("cleaned")))
    )


def text_normalize(spark, sf_dir):
    normal = text.normalize(F.col("text"))
    return (
        fx.table(spark, sf_dir, "fx_texts")
        .select("doc_id", normal.alias("normalized"))
        .withColumn("word_count", text.space_word_count(F.col("normalized")))
    )


# --- join, labels, gold ---------------------------------------------------------


def silver_reference_join(spark, sf_dir):
    return _joined(spark, sf_dir).select(
        "audio_id", "audio_file", "transcription_clean", "expected_transcription"
    )


def transcription_match(spark, sf_dir):
    joined = _joined(spark, sf_dir)
    label = labels.match_label(F.col("transcription_clean"), F.col("expected_transcription"))
    return joined.select(
        "audio_file",
        "transcription_clean",
        "expected_transcription",
        label.alias("transcription_match"),
    )


def normalized_match(spark, sf_dir):
    return _validated(spark, sf_dir).select(
        "audio_file", "generated_normalized", "expected_normalized", "normalized_match"
    )


def word_counts(spark, sf_dir):
    return _labelled(spark, sf_dir).select(
        "audio_file",
        "cleaned_word_count",
        "expected_word_count",
        "word_count_difference",
        "generated_normalized_word_count",
        "expected_normalized_word_count",
        "normalized_word_count_difference",
    )


def quality_classification(spark, sf_dir):
    return _labelled(spark, sf_dir).select(
        "audio_id", "audio_file", "normalized_match", "quality_status", "quality_reason"
    )


def validation_view(spark, sf_dir):
    return _labelled(spark, sf_dir).select(*LABEL_COLUMNS)


def gold(spark, sf_dir):
    return reconcile.gold(_validated(spark, sf_dir))


# --- checks and summaries ---------------------------------------------------------


def bronze_duplicates(spark, sf_dir):
    return quality.duplicates(_bronze(spark, sf_dir))


def reference_duplicates(spark, sf_dir):
    return quality.duplicates(_reference(spark, sf_dir))


def joined_duplicates(spark, sf_dir):
    return tallies.joined_duplicates(_tallies(spark, sf_dir))


def stage_counts(spark, sf_dir):
    return tallies.stage_counts(_tallies(spark, sf_dir))


def dq_gate_results(spark, sf_dir):
    return tallies.gate_results(_tallies(spark, sf_dir))


def dedup_counts(spark, sf_dir):
    return stage_counts(spark, sf_dir).select(
        "before_dedup_count", "after_dedup_count", "duplicates_removed"
    )


def dedup_rows(spark, sf_dir):
    rows = reconcile.deduplicated(_silver(spark, sf_dir), _reference(spark, sf_dir))
    return rows.select(
        "audio_id",
        "audio_file",
        "batch_id",
        "transcription_match",
        "normalized_match",
        "quality_status",
        "quality_reason",
    )


def reconciliation_summary(spark, sf_dir):
    return summaries.reconciliation_of_sides(_silver(spark, sf_dir), _reference(spark, sf_dir))


def quality_summary(spark, sf_dir):
    return summaries.quality_of_sides(_silver(spark, sf_dir), _reference(spark, sf_dir))


def quality_reason_breakdown(spark, sf_dir):
    return summaries.reasons_of_sides(_silver(spark, sf_dir), _reference(spark, sf_dir))


# --- intake ---------------------------------------------------------------------


def intake_file_metadata(spark, sf_dir):
    stamped = intake.with_batch_stamps(_audio(spark, sf_dir), fx.BATCH)
    return stamped.select(
        "path",
        intake.content_id(F.col("content")).alias("audio_id"),
        "audio_file",
        "base_name",
        "file_type",
        "file_size_bytes",
        "source",
        "batch_id",
        F.lit(fx.STARTED).alias("ingestion_timestamp"),
        "model",
        "language",
        "pipeline_version",
    )


def _work(spark, sf_dir):
    files = _audio(spark, sf_dir)
    hot = skew.find_hot(files, None, "base_name")
    return files, fx.table(spark, sf_dir, "fx_prior"), hot


def intake_pending(spark, sf_dir):
    return intake.pending(*_work(spark, sf_dir)).select("path", "base_name")


def intake_skipped(spark, sf_dir):
    return intake.already_done(*_work(spark, sf_dir)).select("path", "base_name")


def intake_done_index(spark, sf_dir):
    """The decision of ``intake_pending`` and ``intake_skipped`` by the index of done names."""
    files = _audio(spark, sf_dir).select("path", "base_name")
    prior = fx.table(spark, sf_dir, "fx_prior")
    done = prior.where((F.col("status") == fixed.SUCCESS) & (F.col("audio_id") != ""))
    index = DoneNames(spark, session.scratch_path(spark, "done_names"))
    index.add(done.select("base_name", F.lit("earlier").alias("batch_id")), ["earlier"])
    return intake.mark_names(files, index.lookup(files)).select("path", "base_name", "done")


def _dropped(files, folder):
    """Write the content of each row to a file of its name in ``folder``."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, made = fs.LocalFileSystem(), False
        place = "/" + folder.removeprefix("file:").lstrip("/")
        for batch in batches:
            if not made:
                system.create_dir(place)
                made = True
            for row in batch.to_pylist():
                with system.open_output_stream(f"{place}/{row['path'].rsplit('/', 1)[-1]}") as out:
                    out.write(row["content"] or b"")
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    files.select("path", "content").mapInArrow(run, "files bigint").agg(F.sum("files")).collect()


def intake_second_run(spark, sf_dir):
    """Files dropped in a folder and taken in twice: the second run finds nothing to do.

    Tells of each file its status, how many audit rows it has, and the folder it is in at the end.
    """
    root = session.scratch_path(spark, "second_run")
    place = file_source.qualified(spark, root)
    _dropped(file_source.audio_only(fx.table(spark, sf_dir, "fx_files")), f"{place}/incoming")
    folders = {name: f"{place}/{name}" for name in ("processed", "failed")}
    store = IntakeStore(spark, f"{root}/store", folders)
    for _ in range(2):
        run_intake(spark, f"{root}/incoming", store, *_recognizer(), only_new=True)
    found = None
    for name in ("incoming", "processed", "failed"):
        files = listing.list_files(spark, f"{place}/{name}", f"{root}/listed-{name}")
        files = files.select(
            paths.file_name(F.col("path")).alias("audio_file"), F.lit(name).alias("folder")
        )
        found = files if found is None else found.unionByName(files)
    told = store.audit().groupBy("audio_file").agg(
        F.max("status").alias("status"), F.count(F.lit(1)).alias("audit_rows")
    )
    return found.join(told, "audio_file", "full_outer").select(
        "audio_file", "status", "audit_rows", "folder"
    )


def intake_collision(spark, sf_dir):
    files = _all_attempts(spark, sf_dir).select("path", "base_name", "recognized")
    hot = skew.find_hot(files, None, "base_name")
    return intake.settle(files, hot).select("path", "base_name", "status")


def intake_batch_summary(spark, sf_dir):
    return intake.batch_summary(_outcome(spark, sf_dir))


def batch_transcribe(spark, sf_dir):
    return _all_attempts(spark, sf_dir).select(
        "path", "audio_id", "transcription", "transcription_length", "word_count"
    )


def batch_transcribe_errors(spark, sf_dir):
    return (
        _all_attempts(spark, sf_dir)
        .where("not recognized")
        .select("path", "audio_id", "error", "error_type")
    )


def intake_incremental(spark, sf_dir):
    """Two drops of all files; in the second one every file can be recognized.

    The first drop leaves failures behind. In the second, under new paths, those
    are tried again and every base name that is done is skipped.
    """
    root = session.scratch_path(spark, "incremental")
    drop, store = f"{root}/drop", IntakeStore(spark, f"{root}/store")
    files = file_source.audio_only(fx.table(spark, sf_dir, "fx_files")).drop("doc_id")
    again = files.withColumn(
        "path", F.replace("path", F.lit("incoming"), F.lit("incoming_again"))
    ).withColumn("content", F.encode(F.concat(F.lit("again "), F.col("path")), "utf-8"))
    for arrived in (files, again):
        arrived.write.mode("append").parquet(drop)
        stream = spark.readStream.schema(files.schema).parquet(drop)
        incremental.start_intake(
            stream, store, f"{root}/checkpoint", *_recognizer()
        ).awaitTermination()
    return (
        store.audit()
        .withColumn("base_name", paths.base_name(F.col("audio_file")))
        .groupBy("base_name")
        .agg(
            F.count_if(F.col("status") == fixed.SUCCESS).alias("successful"),
            F.count_if(F.col("status") == fixed.FAILED).alias("failed"),
            F.count_if(F.col("status") == fixed.SKIPPED).alias("skipped"),
            F.max("transcription").alias("transcription"),
        )
    )


QUERIES = {
    function.__name__: function
    for function in (
        intake_discover,
        bronze_scan,
        reference_scan,
        reference_smoke_count,
        audit_history_scan,
        bronze_latest,
        bronze_current,
        transcript_export,
        run_audit_roundtrip,
        intake_audit_append,
        disposition_split,
        bronze_view,
        silver_view,
        reference_prepared,
        validation_view,
        gold,
        silver,
        bronze_dq,
        bronze_validate,
        silver_reference_join,
        intake_pending,
        intake_skipped,
        intake_done_index,
        intake_second_run,
        intake_collision,
        bronze_duplicates,
        reference_duplicates,
        joined_duplicates,
        stage_counts,
        reconciliation_summary,
        quality_summary,
        quality_reason_breakdown,
        dedup_counts,
        dedup_rows,
        intake_batch_summary,
        text_clean,
        word_counts,
        text_normalize,
        bronze_metrics,
        transcription_match,
        normalized_match,
        quality_classification,
        intake_file_metadata,
        processing_duration,
        batch_transcribe,
        batch_transcribe_errors,
        intake_incremental,
        run_audit,
        run_audit_failure,
        dq_gate_results,
    )
}
