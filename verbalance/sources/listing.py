"""Listings made by tasks, kept as tables, and what changed between two of them."""

from pyspark.sql import functions as F

from verbalance import session
from verbalance.operators.recognize import ARROW_SCHEMES

LISTED = "path string, length bigint, modified timestamp, is_folder boolean"
ENTRIES_AT_ONCE = 10_000


def _list_folders():
    schemes, at_once = dict(ARROW_SCHEMES), ENTRIES_AT_ONCE
    names = [field.split()[0] for field in LISTED.split(", ")]

    # Shipped with the task by value, like the recognizer.
    def run(batches):
        import os
        from datetime import datetime, timezone
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        def local(folder):
            with os.scandir(folder) as entries:
                for entry in entries:
                    facts = entry.stat()
                    modified = datetime.fromtimestamp(facts.st_mtime, timezone.utc)
                    is_folder = entry.is_dir()
                    yield entry.name, None if is_folder else facts.st_size, modified, is_folder

        def remote(folder):
            scheme, rest = folder.split(":", 1)
            uri = f"{schemes.get(scheme, scheme)}:{quote(rest, safe=':/@')}"
            system, place = fs.FileSystem.from_uri(uri)
            for info in system.get_file_info(fs.FileSelector(place, allow_not_found=True)):
                is_folder = info.type == fs.FileType.Directory
                yield info.base_name, info.size, info.mtime, is_folder

        def entries(folder):
            if folder.startswith("/"):
                return local(folder)
            if folder.startswith("file:"):
                return local("/" + folder[len("file:") :].lstrip("/"))
            return remote(folder)

        types = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()]

        def batch_of(rows):
            arrays = [pa.array(values, t) for values, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for folder in batch.column("path").to_pylist():
                rows = []
                for name, *facts in entries(folder):
                    rows.append((f"{folder.rstrip('/')}/{name}", *facts))
                    if len(rows) >= at_once:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return run


def list_files(spark, location, target, recursive=False):
    """Write ``path, length, modified`` of the files in ``location`` to ``target`` and return them.

    Tasks list the folders, those of one depth at a time; the driver holds neither files nor
    folders. ``location`` is spelled as paths shall be; its scheme must be one that tasks can open.
    """
    found = None
    level = spark.createDataFrame([(location,)], "path string")
    while True:
        entries = session.written(
            level.mapInArrow(_list_folders(), LISTED), session.scratch_path(spark, "listing")
        )
        files = entries.where("not is_folder")
        found = files if found is None else found.unionByName(files)
        folders = entries.where("is_folder").select("path")
        count = folders.count() if recursive else 0
        if not count:
            break
        # One folder of many files must not keep others waiting.
        level = folders.repartition(min(count, 8 * spark.sparkContext.defaultParallelism), "path")
    return session.written(found.select("path", "length", "modified"), target)


def changes(before, after):
    """``path, length, modified, change``: files that are ``new``, ``changed`` or ``gone``.

    A file changed if its length or its time did. Both listings are shuffled once, by path.
    """
    old = before.select("path", F.struct("length", "modified").alias("old"))
    new = after.select("path", F.struct("length", "modified").alias("new"))
    change = (
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "gone")
        .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    )
    facts = F.coalesce("new", "old")
    return (
        old.join(new, "path", "full_outer")
        .withColumn("change", change)
        .where("change is not null")
        .select("path", facts["length"].alias("length"), facts["modified"].alias("modified"), "change")
    )
