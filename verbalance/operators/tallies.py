"""Counts over the join of silver and reference rows, without running the join.

The inner join on ``audio_id`` gives ``s * r`` rows for a key with ``s`` silver
and ``r`` reference rows. Pairs that agree in some value are the same product per
key and value. So every count over the joined rows follows from counts of each
side, which are combined before the shuffle: no text is moved, no pair is built,
and a key that holds a third of all rows collapses to one row per map task.
"""

from pyspark.sql import functions as F

from verbalance import fixed
from verbalance.functions import text


def key_tallies(bronze, reference):
    """Rows per ``audio_id``: bronze, silver and reference."""
    intake = bronze.select(
        "audio_id",
        F.lit(1).alias("bronze_rows"),
        F.when(F.col("status") == fixed.SUCCESS, 1).otherwise(0).alias("silver_rows"),
        F.lit(0).alias("reference_rows"),
    )
    expected = reference.select(
        "audio_id",
        F.lit(0).alias("bronze_rows"),
        F.lit(0).alias("silver_rows"),
        F.lit(1).alias("reference_rows"),
    )
    counts = ("bronze_rows", "silver_rows", "reference_rows")
    return (
        intake.unionByName(expected)
        .groupBy("audio_id")
        .agg(*[F.sum(name).alias(name) for name in counts])
    )


def joined_rows():
    """Joined rows of one key of :func:`key_tallies`; a NULL key joins nothing."""
    pairs = F.col("silver_rows") * F.col("reference_rows")
    return F.when(F.col("audio_id").isNotNull(), pairs).otherwise(F.lit(0).cast("bigint"))


def stage_counts(tallies):
    """Record counts of all stages, as one row."""

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0))

    return (
        tallies.withColumn("joined_rows", joined_rows())
        .agg(
            total("bronze_rows").alias("bronze_count"),
            total("silver_rows").alias("silver_count"),
            total("reference_rows").alias("reference_count"),
            total("joined_rows").alias("joined_count"),
            F.count_if(F.col("joined_rows") > 0).alias("after_dedup_count"),
        )
        .withColumn("before_dedup_count", F.col("joined_count"))
        .withColumn("duplicates_removed", F.col("joined_count") - F.col("after_dedup_count"))
        .withColumn("gold_count", F.col("joined_count"))
    )


def side_duplicates(tallies, rows):
    """Keys that occur more than once on one side; NULL counts as a key."""
    return tallies.select("audio_id", F.col(rows).alias("count")).where("count > 1")


def joined_duplicates(tallies):
    """Keys that occur more than once in the joined rows, in key order."""
    return (
        tallies.select("audio_id", joined_rows().alias("count"))
        .where("count > 1")
        .orderBy("audio_id")
    )


def gate_results(tallies):
    """One row per duplicate check: groups that fail it and whether it passed."""
    checks = {
        "bronze_duplicates": F.col("bronze_rows"),
        "reference_duplicates": F.col("reference_rows"),
        "joined_duplicates": joined_rows(),
    }
    row = tallies.agg(*[F.count_if(rows > 1).alias(name) for name, rows in checks.items()])
    results = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failing_groups")) for n in checks]
    )
    return row.select(F.inline(results)).withColumn("passed", F.col("failing_groups") == 0)


# What two joined texts can agree in. A NULL value agrees with nothing.
FACETS = ("pairs", "exact", "normalized", "counted", "words")


def _facet_values():
    words, normal = F.col("words"), F.col("normal")
    return {
        "pairs": F.lit(""),
        "exact": F.sha2(words, 256),
        "normalized": F.sha2(normal, 256),
        "counted": F.when(words.isNotNull(), F.lit("")),
        "words": text.space_word_count(normal).cast("string"),
    }


def agreeing_pairs(silver, reference, facets=FACETS):
    """One row: for each facet, the joined rows whose two sides agree in it.

    Facets are ``pairs`` (all joined rows), ``exact`` (cleaned against expected
    text), ``normalized``, ``counted`` (both word counts known) and ``words``
    (equal normalized word counts). Facet, value and key are shuffled as one
    32-byte digest.
    """

    def side(df, column, silver_row):
        values = _facet_values()
        rows = F.array(
            *[F.struct(F.lit(f).alias("facet"), values[f].alias("value")) for f in facets]
        )
        group = F.concat("facet", F.lit("|"), "value", F.lit("|"), "audio_id")
        return (
            df.where(F.col("audio_id").isNotNull())
            .withColumn("words", F.col(column))
            .withColumn("normal", text.normalize(F.col("words")))
            .select("audio_id", F.inline(rows))
            .where(F.col("value").isNotNull())
            .select(
                "facet",
                text.content_print(group).alias("group"),
                F.lit(int(silver_row)).alias("silver_rows"),
                F.lit(int(not silver_row)).alias("reference_rows"),
            )
        )

    both = side(silver, "transcription_clean", True).unionByName(
        side(reference, "expected_transcription", False)
    )
    agreed = (
        both.groupBy("facet", "group")
        .agg(F.sum("silver_rows").alias("s"), F.sum("reference_rows").alias("r"))
        .withColumn("pairs", F.col("s") * F.col("r"))
    )
    return agreed.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("facet") == f, F.col("pairs"))), F.lit(0)).alias(f)
            for f in facets
        ]
    )
