"""Small files of closed batches, rewritten into few sized ones.

A manifest says which batches a rewritten folder stands for. ``records.read_dataset`` reads
those folders and the partitions of all other batches, by the manifest that is the latest
when the read is planned: it sees the rows of a batch in one place or the other, never in both. The
partitions that were rewritten are left as they are, for readers that planned before.
"""

import math
import uuid

from pyspark.sql import functions as F

from verbalance.sinks import control

FILE_BYTES = 128 * 1024 * 1024
# Batches that may still be written again.
OPEN_BATCHES = 2


def _writer(batch):
    """The stream that a batch is from; batch runs are one."""
    return batch.rsplit("_", 1)[0] if batch.startswith("stream_") else ""


def compact(spark, path, schema, least=50, open_batches=OPEN_BATCHES):
    """Rewrite the closed batches of a dataset that are not rewritten yet; returns their ids.

    Batches are closed in order of their ids, the last ``open_batches`` of each stream and of all batch
    runs stay open. Nothing is done for
    fewer than ``least``. One that breaks off leaves a folder that no manifest names. Rows are
    moved once; those of a batch stay together, so that a filter on ``batch_id`` skips files.
    """
    number, state = control.latest_version(spark, path)
    state = state or {"folders": [], "batches": []}
    by_writer = {}
    for batch in control.batch_ids(spark, path, state["batches"]):
        by_writer.setdefault(_writer(batch), []).append(batch)
    closed = sorted(b for own in by_writer.values() for b in own[: max(len(own) - open_batches, 0)])
    if len(closed) < max(least, 1):
        return []
    partitions = [f"{path}/batch_id={batch}" for batch in closed]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*partitions)
    # Sizes come from a listing; no content is read.
    sizes = spark.read.format("binaryFile").load(partitions).agg(F.sum("length")).first()[0]
    files = max(1, math.ceil((sizes or 0) / FILE_BYTES))
    folder = f"_compacted/{uuid.uuid4().hex}"
    (
        rows.select(*schema.names)
        .repartitionByRange(files, "batch_id", F.monotonically_increasing_id())
        .sortWithinPartitions("batch_id")
        .write.parquet(f"{path}/{folder}")
    )
    content = {"folders": [*state["folders"], folder], "batches": sorted([*state["batches"], *closed])}
    control.commit_version(spark, path, number + 1, content)
    return closed
