"""Data checks on bronze and on any keyed frame."""

from pyspark.sql import functions as F

from verbalance import fixed


def duplicates(df, key="audio_id"):
    """Keys that occur more than once; NULL counts as a key."""
    return df.groupBy(key).count().where("count > 1")


def bronze_checks(bronze):
    """Record, silver and quality counts of bronze in one pass."""
    status = F.col("status")
    return bronze.agg(
        F.count(F.lit(1)).alias("bronze_count"),
        F.count_if(status == fixed.SUCCESS).alias("silver_count"),
        F.count_if(F.col("audio_file").isNull()).alias("null_audio_file"),
        F.count_if(status.isNull()).alias("null_status"),
        F.count_if(F.col("transcription").isNull()).alias("null_transcription"),
        F.count_if(F.col("word_count") == 0).alias("zero_word_count"),
        F.count_if(status != fixed.SUCCESS).alias("non_success"),
    )
