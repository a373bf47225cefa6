"""Declared schemas. Field names and order are fixed values of the stored data."""

from pyspark.sql.types import StructType


def _schema(fields):
    """``name type`` pairs as a schema; parsing DDL would need a running session."""
    schema = StructType()
    for field in fields.split(","):
        name, kind, *required = field.split()
        schema.add(name, kind, nullable=not required)
    return schema


# One record per taken-in file. Times are ISO-8601 strings.
BRONZE = _schema(
    """
    audio_id string, audio_filename string, source string, file_type string,
    file_size_bytes long, batch_id string, ingestion_timestamp string,
    processing_timestamp string, model string, language string, status string,
    processing_duration_seconds double, transcription string,
    transcription_length long, word_count long, error string,
    error_type string, pipeline_version string
    """
)

# Intake audit, the union of the columns of all four row kinds.
INTAKE_AUDIT = _schema(
    """
    audio_id string, audio_file string, status string, batch_id string,
    processed_at string, reason string, transcription string, error string,
    error_type string
    """
)

# One row per run, for successful and failed runs alike.
RUN_AUDIT = _schema(
    """
    run_id string required, run_start_time timestamp required,
    run_end_time timestamp, run_duration_seconds double,
    run_status string required, bronze_record_count long,
    silver_record_count long, joined_record_count long,
    final_record_count long, error_message string, error_type string
    """
)

# Columns of the gold dataset in order.
GOLD_COLUMNS = (
    "audio_id",
    "audio_file",
    "transcription_clean",
    "expected_transcription",
    "transcription_match",
    "cleaned_word_count",
    "expected_word_count",
    "word_count_difference",
    "generated_normalized",
    "expected_normalized",
    "normalized_match",
    "generated_normalized_word_count",
    "expected_normalized_word_count",
    "normalized_word_count_difference",
    "quality_status",
    "quality_reason",
)
