"""Incremental intake: each start takes in the files that arrived since the last one.

Two streams follow each other. The first writes down what arrived, in micro-batches of any
size. The second takes all that one start wrote down as one micro-batch, by base name, and
keeps per name whether it is done and by which path. So files that share a name are
tried in path order however they were dealt to micro-batches, and neither stream reads what
earlier starts recorded.
"""

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from verbalance import fixed, session
from verbalance.functions import paths
from verbalance.operators import intake, recognize
from verbalance.plans.run_audit import utc_now
from verbalance.sinks import control, done_names

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ARRIVED = "base_name string, path string, length bigint, content binary, done boolean"
_TAKEN = f"{recognize.ATTEMPT_SCHEMA}, base_name string, skipped boolean"
_TOLD = "done_"
# Fixed value: the name Spark notes in checkpoints that were begun by frames.
_FRAMES = "transformWithStateInPandasExec"


def epoch_batch_id(query_id, epoch):
    """The same id whenever a micro-batch is tried again, so its rows are replaced.

    The query's id is kept in its checkpoint, so streams into one store never meet.
    """
    return f"stream_{query_id}_{epoch:012d}"


def _by_name(make_recognizer, clock, frames):
    """A processor that tries the files of a name until one gives text, and remembers which did.

    It takes and gives rows, or ``frames`` of pandas, which take several times as long per name.
    """
    start = recognize.attempter(make_recognizer, clock)
    names = [field.split()[0] for field in _TAKEN.split(", ")]
    make_row = Row(*names)

    # Classes made in here are shipped with the task by value.
    class Taker(StatefulProcessor):
        def init(self, handle):
            self.winner = handle.getValueState("winner", "path string")
            self.attempt = start()

        def taken(self, key, rows):
            found = sorted(rows, key=lambda row: (row.path is None, row.path or ""))
            won = self.winner.get()
            # Names that others did come with a row of their own, and before any file.
            if won is None and any(row.done for row in found):
                won = ("",)
                self.winner.update(won)
            for row in found:
                if row.done:
                    continue
                if won is not None:
                    yield (row.path, int(row.length), *[None] * 6, key[0], True)
                    continue
                content = row.content if isinstance(row.content, (bytes, bytearray)) else None
                tried = self.attempt(row.path, int(row.length), content)
                yield (*tried, key[0], False)
                text, error_type = tried[5], tried[7]
                if error_type is None and text and text.strip():
                    won = (row.path,)
                    self.winner.update(won)

        def handleInputRows(self, key, rows, timerValues):
            for values in self.taken(key, rows):
                yield make_row(*values)

        def close(self):
            pass

    class FrameTaker(Taker):
        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            found = [row for frame in rows for row in frame.itertuples(index=False)]
            yield pd.DataFrame(list(self.taken(key, found)), columns=names)

    return FrameTaker() if frames else Taker()


def _keeps_frames(spark, checkpoint):
    """Whether the state of a checkpoint was written by frames: Spark only goes on as it began."""
    if not control.exists(spark, f"{checkpoint}/state/0/_metadata"):
        return False
    operators = spark.read.format("state-metadata").load(checkpoint)
    return not operators.where(F.col("operatorName") == _FRAMES).isEmpty()


def _arrivals(files, store, checkpoint):
    """Write down what arrived, one folder per micro-batch; one tried again replaces its own."""
    columns = [c for c in ("path", "length", "content") if c in files.columns]

    def write(rows, epoch):
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows.write.mode("overwrite").parquet(f"{store.arrivals_path}/{query}/{epoch:012d}")

    return (
        files.select(*columns)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/arrivals")
        .trigger(availableNow=True)
        .start()
    )


def _tell_done(store, folder, own):
    """Write the names that other runs got done since the last start, as arrivals of their own kind."""
    told = {n[len(_TOLD) :] for n in control.names(store.spark, folder) if n.startswith(_TOLD)}
    for batch_id in control.batch_ids(store.spark, store.bronze_path, told):
        if own and batch_id.startswith(own):
            continue
        names = done_names.done_in(store.bronze().where(F.col("batch_id") == batch_id))
        rows = names.select("base_name", F.lit("").alias("path"), F.lit(True).alias("done"))
        rows.write.mode("overwrite").parquet(f"{folder}/{_TOLD}{batch_id}")


def _own_prefix(spark, checkpoint):
    """How the batch ids of a query start; None if it never ran."""
    facts = f"{checkpoint}/metadata"
    if control.exists(spark, facts):
        return f"stream_{control.read_json(spark, facts)['id']}_"
    return None


def start_intake(files, store, checkpoint, make_recognizer, clock=None, min_tasks=None):
    """Take in a stream of ``path, length[, content]`` and stop when it is drained.

    The checkpoint remembers which paths were seen and, by base name, what is done; names that
    batch runs or other streams got done are told to it at each start, once. So a failed
    file dropped again under a new path is tried again and a successful one is skipped.
    Names are dealt to ``min_tasks`` tasks, by default one per core, for as long as the checkpoint lives.
    """
    spark = store.spark
    store.finish_open_moves()
    arriving = _arrivals(files, store, checkpoint)
    arriving.awaitTermination()
    folder = f"{store.arrivals_path}/{arriving.id}"
    control.make_folder(spark, folder)
    _tell_done(store, folder, _own_prefix(spark, f"{checkpoint}/names"))
    arrived = (
        spark.readStream.schema(_ARRIVED)
        .option("recursiveFileLookup", True)
        .option("maxFileAge", "36500d")
        .parquet(folder)
        .withColumn("done", F.coalesce("done", F.lit(False)))
    )
    named = arrived.withColumn(
        "base_name", F.coalesce("base_name", paths.base_name(F.col("path")))
    )
    frames, by_name = _keeps_frames(spark, f"{checkpoint}/names"), named.groupBy("base_name")
    take = by_name.transformWithStateInPandas if frames else by_name.transformWithState
    taken = take(
        _by_name(make_recognizer, clock, frames),
        outputStructType=_TAKEN,
        outputMode="Append",
        timeMode="None",
    )
    started = utc_now().isoformat()

    def write(rows, epoch):
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch_id = epoch_batch_id(query, epoch)
        path = f"{store.work_path}/batch_id={batch_id}/outcome"
        rows.transform(_outcome, started).transform(intake.with_batch_stamps, batch_id).write.mode(
            "overwrite"
        ).parquet(path)
        outcome = rows.sparkSession.read.parquet(path)
        if not outcome.isEmpty():
            store.write(outcome, batch_id)

    tasks = str(min_tasks or spark.sparkContext.defaultParallelism)
    with session.settings(spark, {_PROVIDER: ROCKSDB, "spark.sql.shuffle.partitions": tasks}):
        return (
            taken.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{checkpoint}/names")
            .trigger(availableNow=True)
            .start()
        )


def _outcome(taken, started):
    """Attempts and skipped files as the rows of a settled batch."""
    skipped = F.col("skipped")
    checked = intake.validate_text(taken.transform(intake.with_file_facts))
    status = F.when(skipped, fixed.SKIPPED).when(F.col("recognized"), fixed.SUCCESS)
    return (
        checked.withColumn("status", status.otherwise(fixed.FAILED))
        .withColumn("ingestion_timestamp", F.coalesce("ingestion_timestamp", F.lit(started)))
        .withColumn("error", F.when(~skipped, F.col("error")))
        .withColumn("error_type", F.when(~skipped, F.col("error_type")))
        .drop("skipped")
    )
