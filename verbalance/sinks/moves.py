"""Moving source files where they belong, by a journal that can be followed again.

The intent of a batch is written first: which file goes where. Then tasks move the files,
and what became of each is written, which confirms the batch. A run that broke off
between the two left an intent without a confirmation; it is followed again, and files
that are already there are left alone.
"""

from pyspark.sql import functions as F

from verbalance import fixed
from verbalance.functions import paths
from verbalance.operators.recognize import ARROW_SCHEMES
from verbalance.sinks.datasets import write_batch

MOVED = "path string, target string, result string"
FILES_PER_TASK = 1000


def with_targets(dispositions, folders):
    """Add ``target``: the file's name in the folder of its disposition; null where it stays.

    ``folders`` maps a disposition to a folder, such as ``{"processed": ..., "failed": ...}``.
    """
    target = F.lit(None).cast("string")
    for disposition, folder in (folders or {}).items():
        to = F.concat(F.lit(folder.rstrip("/") + "/"), paths.file_name(F.col("path")))
        target = F.when(F.col("disposition") == disposition, to).otherwise(target)
    stays = F.col("disposition") == fixed.DISPOSITION_INCOMING
    return dispositions.withColumn("target", F.when(~stays, target))


def _move():
    schemes = dict(ARROW_SCHEMES)

    # Shipped with the task by value, like the recognizer.
    def run(batches):
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        def place(path):
            if path.startswith("/"):
                return fs.LocalFileSystem(), path
            if path.startswith("file:"):
                return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
            scheme, rest = path.split(":", 1)
            return fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{quote(rest, safe=':/@')}")

        made = set()

        def move(path, target, length):
            system, source = place(path)
            _, goal = place(target)
            there, moved = system.get_file_info([source, goal])
            if there.type == fs.FileType.NotFound:
                return "moved" if moved.type == fs.FileType.File else "missing"
            if there.size != length:
                # Another file has come under this name since.
                return "replaced"
            folder = goal.rsplit("/", 1)[0]
            if folder not in made:
                system.create_dir(folder)
                made.add(folder)
            system.move(source, goal)
            return "moved"

        for batch in batches:
            rows = batch.to_pylist()
            results = [move(r["path"], r["target"], r["length"]) for r in rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "path": pa.array([r["path"] for r in rows], pa.string()),
                    "target": pa.array([r["target"] for r in rows], pa.string()),
                    "result": pa.array(results, pa.string()),
                }
            )

    return run


def follow(spark, moves_path, confirmed_path, batch_id):
    """Move the files of one batch's intent and confirm it."""
    intent = spark.read.parquet(f"{moves_path}/batch_id={batch_id}").where("target is not null")
    tasks = 1 + intent.count() // FILES_PER_TASK
    moved = intent.repartition(tasks, "path").select("path", "target", "length")
    write_batch(moved.mapInArrow(_move(), MOVED), confirmed_path, batch_id)

