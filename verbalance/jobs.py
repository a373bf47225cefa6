"""Command line for spark-submit: ``jobs.py intake | stream | compact | history | reconcile | table``.

    spark-submit --py-files verbalance.zip verbalance/jobs.py intake \\
        --input s3a://audio/incoming --store s3a://audio/store \\
        --recognizer my_models:make_recognizer
    spark-submit --py-files verbalance.zip --jars driver.jar verbalance/jobs.py reconcile \\
        --bronze s3a://audio/store/bronze --results s3a://audio/results \\
        --url jdbc:... --option driver=... --split-key audio_id

The recognizer is a factory ``module:name`` that the workers can import.
"""

import argparse
import importlib

from verbalance import session
from verbalance.plans.intake_batch import IntakeStore, latest_bronze, run_intake
from verbalance.plans.reconciliation import run_reconciliation
from verbalance.schemas import BRONZE
from verbalance.sinks.datasets import dataset_appender
from verbalance.sinks.tables import table_appender
from verbalance.sources import files, records, tables
from verbalance.streaming.incremental import start_intake


def _named(dotted):
    module, name = dotted.split(":")
    return getattr(importlib.import_module(module), name)


def _pairs(options):
    return dict(option.split("=", 1) for option in options)


def _reference(spark, args):
    options = _pairs(args.option)
    whole = tables.read_table(spark, args.url, args.table, **options)
    parts = args.partitions or spark.sparkContext.defaultParallelism
    key = args.split_key
    if key is None and "audio_id" in whole.columns:
        key = tables.quoted(args.url, "audio_id")
    if key is None or parts == 1:
        return whole
    second = tables.quoted(args.url, "audio_file") if "audio_file" in whole.columns else None
    ranges = tables.balanced_ranges(spark, args.url, args.table, key, parts, second, **options)
    return tables.read_table(spark, args.url, args.table, ranges, **options)


def intake(spark, args):
    """Take in a drop directory, or one file, and show the batch summary."""
    run_intake(
        spark,
        args.input,
        _store(spark, args),
        _named(args.recognizer),
        recursive=args.recursive,
        only_new=args.only_new,
    ).show(truncate=False)


def compact(spark, args):
    """Rewrite the small files of closed batches into few larger ones."""
    bronze, audit = IntakeStore(spark, args.store).compact(args.least)
    print(f"compacted batches: {bronze} of bronze, {audit} of the audit")


def _store(spark, args):
    folders = {"processed": args.processed, "failed": args.failed}
    return IntakeStore(spark, args.store, {k: v for k, v in folders.items() if v})


def stream(spark, args):
    """Take in what arrived in a drop directory since the last start."""
    arriving = files.stream_audio(spark, args.input, args.max_files)
    start_intake(
        arriving, _store(spark, args), args.checkpoint, _named(args.recognizer)
    ).awaitTermination()


def history(spark, args):
    """Show the intake audit, with the rows of an old audit array if one is given."""
    store = IntakeStore(spark, args.store)
    rows = records.read_audit_history(spark, store.audit_path, args.legacy_file)
    rows.show(truncate=False)
    print("audit rows:", rows.count())


def reconcile(spark, args):
    """Run the reconciliation, write its reports and show them."""
    if args.json:
        read = records.read_legacy_bronze(
            spark, args.bronze, args.fill_file_name, keep_corrupt=True
        )
        bronze, corrupt = records.land(read, f"{args.results}/landed")
        print("unreadable records:", corrupt.count())
    else:
        bronze = records.read_dataset(spark, args.bronze, BRONZE)
    if args.latest:
        bronze = latest_bronze(bronze)
    if args.audit_table:
        append = table_appender(args.url, args.audit_table, **_pairs(args.option))
    else:
        append = dataset_appender(f"{args.results}/run_audit")
    result = run_reconciliation(
        spark, bronze, lambda: _reference(spark, args), args.results, append, args.strict
    )
    print("run:", result.run_id)
    for report in (
        result.bronze_checks,
        result.gates,
        result.stage_counts,
        result.reconciliation_summary,
        result.quality_summary,
        result.reason_breakdown,
        result.bronze_duplicates,
        result.reference_duplicates,
        result.joined_duplicates,
    ):
        report.show(truncate=False)


def table(spark, args):
    """Show the first rows of a table and its row count."""
    found = _reference(spark, args)
    found.show(truncate=False)
    print("Record count:", found.count())


def parser():
    top = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)

    def command(run, *groups):
        sub = commands.add_parser(run.__name__, help=run.__doc__)
        sub.set_defaults(run=run)
        for group in groups:
            group(sub)
        return sub

    def drop(sub):
        for name in ("--input", "--store", "--recognizer"):
            sub.add_argument(name, required=True)
        sub.add_argument("--processed", help="folder that recognized files are moved to")
        sub.add_argument("--failed", help="folder that failed files are moved to")

    def database(sub):
        sub.add_argument("--url", required=True, help="JDBC address")
        sub.add_argument("--table", default="audio_reference")
        sub.add_argument("--option", action="append", default=[], help="connection key=value")
        sub.add_argument("--split-key", help="string column to read in ranges, as SQL spells it")
        sub.add_argument("--partitions", type=int, help="ranges to read at once; 1 for no ranges")

    batch = command(intake, drop)
    batch.add_argument("--recursive", action="store_true", help="folders below the input as well")
    batch.add_argument("--only-new", action="store_true", help="only what the last run did not see")
    small = command(compact)
    small.add_argument("--store", required=True)
    small.add_argument("--least", type=int, default=50, help="do nothing for fewer batches")
    past = command(history)
    past.add_argument("--store", required=True)
    past.add_argument("--legacy-file", help="audit array of the single-machine job")
    streaming = command(stream, drop)
    streaming.add_argument("--checkpoint", required=True)
    streaming.add_argument("--max-files", type=int, default=100_000)
    run = command(reconcile, database)
    run.add_argument("--bronze", required=True)
    run.add_argument("--json", action="store_true", help="bronze is a directory of JSON records")
    run.add_argument("--fill-file-name", action="store_true", help="read old names of failed records")
    run.add_argument("--latest", action="store_true", help="only the last record per base name")
    run.add_argument("--results", required=True)
    run.add_argument("--audit-table", help="append the audit row to this table of the database")
    run.add_argument("--strict", action="store_true", help="stop at duplicate keys")
    command(table, database)
    return top


def main(argv=None):
    args = parser().parse_args(argv)
    args.run(session.build_session(f"verbalance-{args.command}"), args)


if __name__ == "__main__":
    main()
