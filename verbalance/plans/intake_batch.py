"""One intake batch: found files to bronze records, transcripts, audit rows and moved files."""

import uuid

from pyspark.sql import functions as F

from verbalance import fixed, session
from verbalance.functions import measures, paths
from verbalance.operators import dedup, intake, recognize, skew
from verbalance.plans.run_audit import utc_now
from verbalance.schemas import BRONZE, INTAKE_AUDIT
from verbalance.sinks import compaction, control, current, done_names, moves
from verbalance.sinks.datasets import write_batch
from verbalance.sources import files as file_source
from verbalance.sources import listing
from verbalance.sources.records import read_dataset

BYTES_PER_TASK = 256 * 1024 * 1024
FILES_PER_TASK = 1000
_LISTED = "path string, length bigint, modified timestamp"


def latest_bronze(bronze):
    name = paths.base_name(F.col("audio_filename"))
    return dedup.latest_records(bronze, name).select(*BRONZE.names)


class IntakeStore:
    """Where the datasets of intake are kept.

    ``folders`` tells where files go once they are taken in, by disposition, such as
    ``{"processed": ..., "failed": ...}``; files of a disposition without a folder stay.
    """

    def __init__(self, spark, root, folders=None):
        self.spark = spark
        self.folders = folders
        self.bronze_path = f"{root}/bronze"
        self.audit_path = f"{root}/intake_audit"
        self.transcripts_path = f"{root}/transcripts"
        self.moves_path = f"{root}/dispositions"
        self.moved_path = f"{root}/moved"
        self.arrivals_path = f"{root}/arrivals"
        self.listings_path = f"{root}/listings"
        self.work_path = f"{root}/work"
        self.index = done_names.DoneNames(spark, f"{root}/done_names")
        self.current = current.CurrentTable(spark, f"{root}/current")

    def bronze(self):
        return read_dataset(self.spark, self.bronze_path, BRONZE)

    def latest(self):
        """The last record of each base name, as if each record replaced the one before.

        New batches are merged first; what is read is one row per name, without a shuffle.
        """
        self.current.refresh(self.bronze_path, self.bronze)
        return self.current.read()

    def audit(self):
        return read_dataset(self.spark, self.audit_path, INTAKE_AUDIT)

    def compact(self, least=50):
        """Rewrite closed batches of bronze and of the audit; returns how many of each."""
        return [
            len(compaction.compact(self.spark, path, schema, least))
            for path, schema in ((self.bronze_path, BRONZE), (self.audit_path, INTAKE_AUDIT))
        ]

    def done(self, files, batch_id):
        """Base names, among others those of ``files``, that other batches recorded as done."""
        done_names.catch_up(self.index, self.bronze_path, self.bronze)
        return self.index.lookup(files.select("base_name").distinct()).where(
            F.col("batch_id") != batch_id
        )

    def write(self, outcome, batch_id):
        """Write an outcome, which is a written table, as the datasets of its batch."""
        write_batch(intake.transcripts(outcome), self.transcripts_path, batch_id)
        write_batch(intake.audit_rows(outcome), self.audit_path, batch_id)
        intent = moves.with_targets(intake.dispositions(outcome, "length"), self.folders)
        write_batch(intent, self.moves_path, batch_id)
        if batch_id in self.index.batches():
            self.index.drop(batch_id)
        self.current.forget(batch_id)
        # Bronze makes a file done: a run that breaks off before is made again in full. One that
        # breaks off after it is finished by the next run, which follows open intents first.
        # The index takes it up when a run next asks.
        write_batch(intake.bronze_records(outcome), self.bronze_path, batch_id)
        if self.folders:
            moves.follow(self.spark, self.moves_path, self.moved_path, batch_id)

    def finish_open_moves(self):
        """Move what earlier batches meant to move; only batches that got as far as bronze count."""
        if self.folders:
            confirmed = control.batch_ids(self.spark, self.moved_path)
            for batch_id in control.batch_ids(self.spark, self.moves_path, confirmed):
                if control.complete(self.spark, f"{self.bronze_path}/batch_id={batch_id}"):
                    moves.follow(self.spark, self.moves_path, self.moved_path, batch_id)


def _task_count(work):
    """Enough tasks that each gets a bounded number of files and of bytes."""
    size = work.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    ).first()
    return 1 + max(size["files"] // FILES_PER_TASK, size["bytes"] // BYTES_PER_TASK)


def take_in(files, store, batch_id, make_recognizer, clock=None, started=None, min_tasks=None):
    """Process ``path, length[, content]`` rows as one batch and return its summary.

    Steps that are expensive or not repeatable are written before they are used:
    the work list and the recognizer's output. Running a batch id again replaces
    its partition in each dataset.
    """
    spark = files.sparkSession
    started = started or utc_now().isoformat()
    work_path = f"{store.work_path}/batch_id={batch_id}"
    if "content" not in files.columns:
        recognize.check_storage(files)
    # Written, so that Spark knows its size when it plans the join with the history.
    listed = session.written(
        files.select("path", "length").transform(intake.with_file_facts), f"{work_path}/found"
    )
    hot = skew.find_hot(listed, None, "base_name")
    work = session.written(
        intake.mark_names(listed, store.done(listed, batch_id), hot), f"{work_path}/list"
    )
    todo = work.where("not done")
    if "content" in files.columns:
        # The decisions are joined to the rows that hold content; those stay in their partitions
        # wherever Spark can broadcast the decisions.
        spread = files.join(todo.select("path"), "path", "left_semi")
    else:
        # A fixed number of tasks: the rows are small, the work per row is not.
        tasks = max(_task_count(todo), min_tasks or spark.sparkContext.defaultParallelism)
        spread = todo.repartition(tasks, "path")
    attempts_path = f"{work_path}/attempts"
    attempts = session.written(
        recognize.transcribe(spread, make_recognizer, clock), attempts_path
    )

    facts = intake.with_file_facts(attempts)
    checked = intake.validate_text(facts)
    settled = intake.settle(checked, hot)
    skipped = work.where("done").select(
        "path",
        "length",
        "audio_file",
        "base_name",
        "file_type",
        "file_size_bytes",
        F.lit(started).alias("ingestion_timestamp"),
        F.lit(fixed.SKIPPED).alias("status"),
    )
    outcome = intake.with_batch_stamps(
        settled.unionByName(skipped, allowMissingColumns=True), batch_id
    )
    with session.shuffles_for(spark, session.stored_bytes(spark, attempts_path)):
        outcome = session.written(outcome, f"{work_path}/outcome")
    store.write(outcome, batch_id)
    return intake.batch_summary(outcome)


def _listed_by_tasks(spark, location, store, recursive):
    """The audio files of a folder, the listing they are from, and that of the last run.

    None where tasks cannot list: for a single file, or a scheme they cannot open.
    """
    root = file_source.qualified(spark, location)
    if not file_source.is_folder(spark, location) or not recognize.can_open(root):
        return None
    number, last = control.latest_version(spark, store.listings_path)
    folder = f"{store.listings_path}/{uuid.uuid4().hex}"
    listed = listing.list_files(spark, root, folder, recursive)
    known = (last or {}).get(root)
    return file_source.audio_only(listed), known, (number + 1, {**(last or {}), root: folder})


def run_intake(
    spark, location, store, make_recognizer, clock=None, now=utc_now, recursive=False, only_new=False
):
    """Take in a drop directory, or one file, as it is now.

    Moves that an earlier run left open are made first. ``only_new`` leaves out files that are as
    they were in the listing of the last run that came to its end; without any new or changed file
    nothing is written. Two runs of one second are stored apart.
    """
    moment = now()
    batch_id = f"{measures.batch_id(moment)}_{uuid.uuid4().hex[:12]}"
    store.finish_open_moves()
    by_tasks = _listed_by_tasks(spark, location, store, recursive) if recursive or only_new else None
    if by_tasks is None:
        found = file_source.discover(spark, location)
        if not recognize.can_open(file_source.qualified(spark, location)):
            found = file_source.discover(spark, location, with_content=True)
    else:
        found, known, version = by_tasks
        if found.isEmpty():
            raise file_source.NoAudioFound(f"no audio files in {location}")
        if only_new and known:
            before = spark.read.schema(_LISTED).parquet(known)
            found = listing.changes(before, found).where("change in ('new', 'changed')")
            if found.isEmpty():
                return intake.batch_summary(store.audit().where(F.lit(False)))
        found = found.select("path", "length")
    summary = take_in(found, store, batch_id, make_recognizer, clock, moment.isoformat())
    if by_tasks is not None:
        control.commit_version(spark, store.listings_path, *version)
    return summary
