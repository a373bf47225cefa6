"""Summaries of validated rows.

The first three functions read validated rows, such as a written gold table. The
``*_of_sides`` functions give the same numbers from silver and reference rows
without joining them.
"""

from pyspark.sql import functions as F

from verbalance import fixed
from verbalance.functions.measures import count_where, percentage
from verbalance.operators.tallies import agreeing_pairs


def _reconciliation(counts):
    return counts.withColumn(
        "match_percentage", percentage(F.col("match_count"), F.col("total_records"))
    )


def _quality(counts):
    return counts.withColumn(
        "pass_percentage", percentage(F.col("pass_count"), F.col("total_records"))
    ).withColumn("review_percentage", percentage(F.col("review_count"), F.col("total_records")))


def reconciliation_summary(validated):
    label = F.col("transcription_match")
    return _reconciliation(
        validated.agg(
            F.count(F.lit(1)).alias("total_records"),
            count_where(label == fixed.MATCH).alias("match_count"),
            count_where(label == fixed.MISMATCH).alias("mismatch_count"),
        )
    )


def quality_summary(validated):
    status = F.col("quality_status")
    return _quality(
        validated.agg(
            F.count(F.lit(1)).alias("total_records"),
            count_where(status == fixed.PASS).alias("pass_count"),
            count_where(status == fixed.REVIEW).alias("review_count"),
        )
    )


def reason_breakdown(validated):
    return (
        validated.groupBy("quality_reason")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy("quality_reason")
    )


def _known(count):
    """A sum over no rows is NULL, not zero."""
    return F.when(F.col("pairs") > 0, count)


def reconciliation_of_sides(silver_rows, reference):
    pairs = agreeing_pairs(silver_rows, reference, ("pairs", "exact"))
    return _reconciliation(
        pairs.select(
            F.col("pairs").alias("total_records"),
            _known(F.col("exact")).alias("match_count"),
            _known(F.col("pairs") - F.col("exact")).alias("mismatch_count"),
        )
    )


def quality_of_sides(silver_rows, reference):
    pairs = agreeing_pairs(silver_rows, reference, ("pairs", "normalized"))
    return _quality(
        pairs.select(
            F.col("pairs").alias("total_records"),
            _known(F.col("normalized")).alias("pass_count"),
            _known(F.col("pairs") - F.col("normalized")).alias("review_count"),
        )
    )


def reasons_of_sides(silver_rows, reference):
    """Equal normalized texts have equal counts, so the three reasons split the pairs."""
    pairs = agreeing_pairs(silver_rows, reference, ("pairs", "normalized", "counted", "words"))
    other_count = F.col("counted") - F.col("words")
    reasons = {
        fixed.REASON_MATCH: F.col("normalized"),
        fixed.REASON_WORDS: other_count,
        fixed.REASON_REVIEW: F.col("pairs") - F.col("normalized") - other_count,
    }
    rows = F.array(
        *[
            F.struct(F.lit(reason).alias("quality_reason"), count.alias("record_count"))
            for reason, count in reasons.items()
        ]
    )
    return pairs.select(F.inline(rows)).where("record_count > 0").orderBy("quality_reason")
