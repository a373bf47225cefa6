"""Session settings and the shared folder for written intermediate tables."""

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024

# Results depend on these two; the rest is left to the cluster's own defaults.
REQUIRED = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(name="verbalance", master=None, **settings):
    """A session with the settings the results depend on; ``settings`` use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark):
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session that names none gets a folder of its own; a cluster must
    name one, since executors cannot see the driver's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder all executors see")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="verbalance-"))
    return context.getCheckpointDir()


def scratch_path(spark, label):
    """A path below the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/verbalance/{label}-{uuid.uuid4().hex}"


def written(df, path):
    """Write ``df`` once and return the written table.

    Unlike a cached frame the table outlives lost executors, and later readers
    prune its columns.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, *keys):
    """Use all cores on a source with fewer splits than the cluster has cores.

    One unsplittable file would otherwise be worked on by one task. A table with
    enough splits is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def stored_bytes(spark, path):
    """Size of a written table, taken from its file listing."""
    sizes = spark.read.format("binaryFile").load(path).agg(F.sum("length"))
    return sizes.first()[0] or 0


@contextmanager
def settings(spark, values):
    """Settings of the session for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffles_for(spark, size):
    """Use enough shuffle partitions for ``size`` bytes, never fewer than configured.

    Adaptive execution merges partitions that turn out small but splits none,
    except for skew.
    """
    key = "spark.sql.shuffle.partitions"
    needed = math.ceil(size / BYTES_PER_SHUFFLE_PARTITION)
    return settings(spark, {key: str(max(int(spark.conf.get(key)), needed))})
