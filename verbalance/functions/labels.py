"""Comparison labels. A NULL on either side never matches."""

from pyspark.sql import functions as F

from verbalance import fixed


def match_label(left, right):
    return F.when(left == right, fixed.MATCH).otherwise(fixed.MISMATCH)


def quality_status(normalized_match):
    return F.when(normalized_match == fixed.MATCH, fixed.PASS).otherwise(fixed.REVIEW)


def quality_reason(normalized_match, word_count_difference):
    """A NULL difference falls through to review."""
    return (
        F.when(normalized_match == fixed.MATCH, fixed.REASON_MATCH)
        .when(word_count_difference > 0, fixed.REASON_WORDS)
        .otherwise(fixed.REASON_REVIEW)
    )
