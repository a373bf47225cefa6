"""Small aggregate and time expressions."""

from pyspark.sql import functions as F

from verbalance import fixed


def count_where(condition):
    """Rows where ``condition`` is true; NULL on no rows, as a sum is."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def percentage(part, total):
    """Share in per cent with two decimals; NULL when there is nothing to share."""
    return F.when(total != 0, F.round(part / total * 100, 2))


def elapsed_seconds(start, end):
    """Seconds between two ISO-8601 strings, with and without a fraction."""
    micros = F.timestamp_diff(
        "MICROSECOND", F.to_timestamp_ntz(start), F.to_timestamp_ntz(end)
    )
    return micros / F.lit(1e6)


def record_duration(start, end):
    return F.round(elapsed_seconds(start, end), 2)


def batch_id(moment):
    """Batch id of a run that starts at ``moment`` (a Python datetime)."""
    return moment.strftime(fixed.BATCH_ID_FORMAT)
