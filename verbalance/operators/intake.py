"""Which files to take in, and the rows that follow from recognizing them."""

from pyspark.sql import functions as F

from verbalance import fixed
from verbalance.functions import measures, paths, text
from verbalance.operators import skew
from verbalance.schemas import BRONZE, INTAKE_AUDIT


def content_id(content):
    """SHA-256 hex of the original bytes."""
    return F.sha2(content, 256)


def with_file_facts(files):
    """Add names, type and size to ``path, length``."""
    path = F.col("path")
    return (
        files.withColumn("audio_file", paths.file_name(path))
        .withColumn("base_name", paths.base_name(path))
        .withColumn("file_type", paths.file_type(path))
        .withColumn("file_size_bytes", F.col("length"))
    )


def with_batch_stamps(files, batch_id):
    """Add the stamps every record of a batch carries."""
    return (
        files.withColumn("source", F.lit(fixed.SOURCE))
        .withColumn("batch_id", F.lit(batch_id))
        .withColumn("model", F.lit(fixed.MODEL))
        .withColumn("language", F.lit(fixed.LANGUAGE))
        .withColumn("pipeline_version", F.lit(fixed.RECORD_VERSION))
    )


def completed_names(prior, files):
    """Base names of ``files`` that have an earlier successful record with an id, each once.

    If ``files`` is a written table that Spark finds small enough to broadcast, the
    history is scanned without a shuffle.
    """
    completed = prior.where(
        (F.col("status") == fixed.SUCCESS) & (F.col("audio_id") != "")
    ).select("base_name")
    names = files.select("base_name").distinct()
    return completed.join(names, "base_name", "left_semi").distinct()


def _by_name(files, names, how, hot):
    return skew.balanced_join(files, names, "base_name", how, hot=hot, left_spread=("path",))


def pending(files, prior, hot=None):
    """Files still to be recognized."""
    return _by_name(files, completed_names(prior, files), "left_anti", hot)


def already_done(files, prior, hot=None):
    """Files to be skipped because of an earlier record."""
    return _by_name(files, completed_names(prior, files), "left_semi", hot)


def mark_done(files, prior, hot=None):
    """All files with a flag ``done``: pending and skipped ones in one join."""
    return mark_names(files, completed_names(prior, files), hot)


def mark_names(files, names, hot=None):
    """All files with a flag ``done``, true for those of ``names`` (``base_name``)."""
    wanted = files.select("base_name").distinct()
    done = names.select("base_name").join(wanted, "base_name", "left_semi").distinct()
    return _by_name(files, done.withColumn("done", F.lit(True)), "left", hot).withColumn(
        "done", F.coalesce("done", F.lit(False))
    )


def settle(attempts, hot=None):
    """The outcome of files that share a base name within one batch.

    Files count in path order: up to the first success they have failed, after it
    they are skipped. ``recognized`` tells whether an attempt gave text.
    """
    firsts = (
        attempts.where("recognized").groupBy("base_name").agg(F.min("path").alias("first_success"))
    )
    first = F.col("first_success")
    return (
        _by_name(attempts, firsts, "left", hot)
        .withColumn(
            "status",
            F.when(F.col("path") == first, fixed.SUCCESS)
            .when(F.col("path") > first, fixed.SKIPPED)
            .otherwise(fixed.FAILED),
        )
        .drop("first_success")
    )


def validate_text(attempts):
    """Turn recognizer output into record fields; blank output is a failure.

    Takes ``text`` and the ``error``, ``error_type`` a recognizer raised.
    """
    raised = F.col("error_type").isNotNull()
    blank = text.is_blank(F.col("text"))
    recognized = ~raised & ~blank
    words = F.col("text")
    return (
        attempts.withColumn("recognized", recognized)
        .withColumn("error", F.when(~raised & blank, fixed.EMPTY_ERROR).otherwise(F.col("error")))
        .withColumn(
            "error_type", F.when(~raised & blank, fixed.EMPTY_ERROR_TYPE).otherwise(F.col("error_type"))
        )
        .withColumn("transcription", F.when(F.col("recognized"), words))
        .withColumn(
            "transcription_length",
            F.when(F.col("recognized"), F.length(words)).otherwise(0).cast("bigint"),
        )
        .withColumn(
            "word_count",
            F.when(F.col("recognized"), text.unicode_word_count(words)).otherwise(0).cast("bigint"),
        )
        .drop("text")
    )


def bronze_records(settled):
    """The records of a settled batch. A skipped file writes none."""
    return (
        settled.where(F.col("status") != fixed.SKIPPED)
        .withColumn("audio_filename", F.col("audio_file"))
        .withColumn(
            "processing_duration_seconds",
            measures.record_duration(F.col("ingestion_timestamp"), F.col("processing_timestamp")),
        )
        .select(*[F.col(f.name).cast(f.dataType) for f in BRONZE.fields])
    )


def audit_rows(settled):
    """Intake audit rows: each kind of row fills its own columns, the rest is NULL."""
    status = F.col("status")
    failed = status == fixed.FAILED
    empty = failed & (F.col("error_type") == fixed.EMPTY_ERROR_TYPE)
    columns = {
        "audio_id": F.when(empty, F.col("audio_id")),
        "audio_file": F.col("audio_file"),
        "status": status,
        "batch_id": F.col("batch_id"),
        "processed_at": F.col("ingestion_timestamp"),
        "reason": F.when(status == fixed.SKIPPED, fixed.SKIP_REASON),
        "transcription": F.when(status == fixed.SUCCESS, F.col("transcription")),
        "error": F.when(failed, F.col("error")),
        "error_type": F.when(failed & ~empty, F.col("error_type")),
    }
    return settled.select(*[columns[name].alias(name) for name in INTAKE_AUDIT.names])


def transcripts(settled):
    """Base name and text of each success."""
    return settled.where(F.col("status") == fixed.SUCCESS).select(
        "base_name", "transcription", "batch_id"
    )


def dispositions(settled, *others):
    """Where each source file belongs, and columns to know it by."""
    place = (
        F.when(F.col("status") == fixed.SUCCESS, fixed.DISPOSITION_PROCESSED)
        .when(F.col("status") == fixed.FAILED, fixed.DISPOSITION_FAILED)
        .otherwise(fixed.DISPOSITION_INCOMING)
    )
    return settled.select("path", "status", "batch_id", place.alias("disposition"), *others)


def batch_summary(rows):
    """Totals per batch over audit rows or settled files."""
    status = F.col("status")
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(status == fixed.SUCCESS).alias("successful"),
        F.count_if(status == fixed.FAILED).alias("failed"),
        F.count_if(status == fixed.SKIPPED).alias("skipped"),
    )
