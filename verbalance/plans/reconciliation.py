"""The reconciliation run: bronze and expected texts to gold, reports and audit row.

Every figure comes from a query over the data. Counters observed while writing
would be off once a lost executor's tasks are run again.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalance import session
from verbalance.operators import quality, reconcile, skew, summaries, tallies
from verbalance.plans.run_audit import audited_run, utc_now


# About what one key and its counts take in a shuffle.
KEY_BYTES = 100


class QualityGateError(RuntimeError):
    """A strict run found duplicate keys."""


class Reconciliation(NamedTuple):
    run_id: str
    gold: DataFrame
    bronze_checks: DataFrame
    gates: DataFrame
    stage_counts: DataFrame
    bronze_duplicates: DataFrame
    reference_duplicates: DataFrame
    joined_duplicates: DataFrame
    reconciliation_summary: DataFrame
    quality_summary: DataFrame
    reason_breakdown: DataFrame
    deduplicated: DataFrame


def run_reconciliation(
    spark, bronze, load_reference, store, append_audit, strict=False, clock=utc_now
):
    """Run the whole reconciliation and write its results below ``store``.

    ``load_reference()`` gives the table of expected texts, so that a failing
    connection is part of the audited run. Bronze should be a columnar dataset;
    land JSON records first, since three passes are made over them. Gates only
    report unless ``strict``. Each report is written to a folder of its name.
    """
    with audited_run(spark, append_audit, clock, markers=f"{store}/_runs") as run:
        folder = f"{store}/run_id={run.run_id}"
        bronze = reconcile.with_audio_file(bronze)
        checks = session.written(quality.bronze_checks(bronze), f"{folder}/bronze_checks")
        seen = checks.first()
        run.record(bronze_record_count=seen["bronze_count"], silver_record_count=seen["silver_count"])

        # Written once, so that the database is read once and both passes see the same rows.
        expected_path = f"{folder}/reference"
        reference = session.written(
            reconcile.prepare_reference(load_reference()), expected_path
        )
        with session.shuffles_for(spark, KEY_BYTES * (seen["bronze_count"] + reference.count())):
            keys = session.written(tallies.key_tallies(bronze, reference), f"{folder}/key_tallies")
        counts = session.written(tallies.stage_counts(keys), f"{folder}/stage_counts")
        stages = counts.first()
        run.record(joined_record_count=stages["joined_count"])
        gates = session.written(tallies.gate_results(keys), f"{folder}/gates")
        failed = [row["check_name"] for row in gates.where("not passed").collect()]
        if strict and failed:
            raise QualityGateError(f"duplicate keys: {', '.join(sorted(failed))}")

        # Transcriptions are taken to be as long as the texts expected for them.
        expected_bytes = session.stored_bytes(spark, expected_path)
        row_bytes = expected_bytes / max(stages["reference_count"], 1)
        hot = skew.hot_from_counts(
            keys.where("audio_id is not null"),
            F.xxhash64("audio_id"),
            F.col("silver_rows"),
            F.col("reference_rows"),
            skew.rows_per_split(row_bytes),
            F.col("silver_rows") * F.lit(row_bytes),
            F.col("reference_rows") * F.lit(row_bytes),
        )
        silver = reconcile.silver(bronze)
        # Each side moves its texts and their normal form.
        with session.shuffles_for(spark, 2 * (expected_bytes + row_bytes * stages["silver_count"])):
            gold = session.written(
                reconcile.gold(reconcile.validate_sides(silver, reference, hot)), f"{folder}/gold"
            )
        run.record(final_record_count=gold.count())

        def report(name, frame):
            return session.written(frame, f"{folder}/{name}")

        return Reconciliation(
            run_id=run.run_id,
            gold=gold,
            bronze_checks=checks,
            gates=gates,
            stage_counts=counts,
            bronze_duplicates=report(
                "bronze_duplicates", tallies.side_duplicates(keys, "bronze_rows")
            ),
            reference_duplicates=report(
                "reference_duplicates", tallies.side_duplicates(keys, "reference_rows")
            ),
            joined_duplicates=report("joined_duplicates", tallies.joined_duplicates(keys)),
            reconciliation_summary=report(
                "reconciliation_summary", summaries.reconciliation_summary(gold)
            ),
            quality_summary=report("quality_summary", summaries.quality_summary(gold)),
            reason_breakdown=report("reason_breakdown", summaries.reason_breakdown(gold)),
            deduplicated=report("deduplicated", reconcile.deduplicated(silver, reference)),
        )
