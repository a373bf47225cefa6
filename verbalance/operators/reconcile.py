"""Silver, the join with the expected texts, labels and gold."""

from pyspark.sql import functions as F

from verbalance import fixed
from verbalance.functions import labels, text
from verbalance.operators import dedup, skew
from verbalance.schemas import GOLD_COLUMNS

# Columns that tell rows of one audio_id apart.
SILVER_SPREAD = ("audio_file", "batch_id")
REFERENCE_SPREAD = ("_expected_file",)


def with_audio_file(bronze):
    return bronze.withColumn("audio_file", F.col("audio_filename"))


def silver(bronze):
    """Successful records with cleaned text and its word count."""
    return (
        bronze.where(F.col("status") == fixed.SUCCESS)
        .withColumn("transcription_clean", text.clean(F.col("transcription")))
        .withColumn("cleaned_word_count", text.space_word_count(F.col("transcription_clean")))
    )


def prepare_reference(table):
    """The expected texts without the columns that are not compared."""
    return table.drop("created_at")


def join_expected(silver_rows, reference, hot=None):
    """Inner join on ``audio_id``; copies on either side multiply rows.

    The file name of the silver side wins; that of the reference only tells its
    rows apart and is not shuffled.
    """
    return skew.balanced_join(
        silver_rows,
        reference.withColumnRenamed("audio_file", "_expected_file"),
        "audio_id",
        hot=hot,
        left_spread=SILVER_SPREAD,
        right_spread=REFERENCE_SPREAD,
    ).drop("_expected_file")


def _normalized(df, words, normal):
    return df.withColumn(normal, text.normalize(F.col(words))).withColumn(
        f"{normal}_word_count", text.space_word_count(F.col(normal))
    )


def _with_generated(silver_rows):
    return _normalized(silver_rows, "transcription_clean", "generated_normalized")


def _with_expected(reference):
    counted = reference.withColumn(
        "expected_word_count", text.space_word_count(F.col("expected_transcription"))
    )
    return _normalized(counted, "expected_transcription", "expected_normalized")


def validate(joined):
    """Compare texts and word counts and classify each joined row."""
    return joined.transform(_with_generated).transform(_with_expected).transform(_compared)


def validate_sides(silver_rows, reference, hot=None):
    """The rows of :func:`validate` from the sides of the join.

    Each text is normalized and counted once, before copies multiply it; of a joined row
    texts are only compared.
    """
    joined = join_expected(_with_generated(silver_rows), _with_expected(reference), hot)
    return _compared(joined)


def _compared(joined):
    return (
        joined.withColumn(
            "transcription_match",
            labels.match_label(F.col("transcription_clean"), F.col("expected_transcription")),
        )
        .withColumn(
            "normalized_match",
            labels.match_label(F.col("generated_normalized"), F.col("expected_normalized")),
        )
        .transform(_differences_and_quality)
    )


def _reduced(df, words, count, side):
    """Word counts and content prints in place of a text."""
    normal = f"{side}_normalized"
    return (
        df.withColumn(normal, text.normalize(F.col(words)))
        .withColumn(f"{side}_print", text.content_print(F.col(words)))
        .withColumn(f"{side}_normal_print", text.content_print(F.col(normal)))
        .withColumn(count, text.space_word_count(F.col(words)))
        .withColumn(f"{normal}_word_count", text.space_word_count(F.col(normal)))
        .drop(words, normal, "transcription")
    )


def reduced_silver(silver_rows):
    return _reduced(silver_rows, "transcription_clean", "cleaned_word_count", "generated")


def reduced_reference(reference):
    return _reduced(reference, "expected_transcription", "expected_word_count", "expected")


def validate_reduced(joined):
    """The labels and counts of :func:`validate` from reduced sides."""
    return (
        joined.withColumn(
            "transcription_match",
            labels.match_label(F.col("generated_print"), F.col("expected_print")),
        )
        .withColumn(
            "normalized_match",
            labels.match_label(F.col("generated_normal_print"), F.col("expected_normal_print")),
        )
        .drop("generated_print", "expected_print")
        .drop("generated_normal_print", "expected_normal_print")
        .transform(_differences_and_quality)
    )


def validate_labels(silver_rows, reference, hot=None):
    """The labels and counts of :func:`validate` without the texts.

    Each side is reduced before the join, so the texts are never shuffled.
    """
    joined = join_expected(reduced_silver(silver_rows), reduced_reference(reference), hot)
    return validate_reduced(joined)


def _differences_and_quality(df):
    return (
        df.withColumn(
            "word_count_difference",
            text.count_difference(F.col("cleaned_word_count"), F.col("expected_word_count")),
        )
        .withColumn(
            "normalized_word_count_difference",
            text.count_difference(
                F.col("generated_normalized_word_count"),
                F.col("expected_normalized_word_count"),
            ),
        )
        .withColumn("quality_status", labels.quality_status(F.col("normalized_match")))
        .withColumn(
            "quality_reason",
            labels.quality_reason(
                F.col("normalized_match"), F.col("normalized_word_count_difference")
            ),
        )
    )


def gold(validated):
    """The business output. It keeps duplicates, as does the join it comes from."""
    return validated.select(*GOLD_COLUMNS)


def deduplicated(silver_rows, reference):
    """Labels of one joined row per ``audio_id``, without the texts.

    Each side is cut to its first row per key before the join. That picks the
    same row as ordering the joined rows by the silver columns and then by the
    expected print, but copies are never multiplied.
    """
    first_silver = dedup.first_per_key(
        reduced_silver(silver_rows),
        "audio_id",
        [F.asc_nulls_first(c) for c in (*SILVER_SPREAD, "generated_print")],
    )
    first_expected = dedup.first_per_key(
        reduced_reference(reference), "audio_id", [F.asc_nulls_first("expected_print")]
    )
    return validate_reduced(join_expected(first_silver, first_expected))
