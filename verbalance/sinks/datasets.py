"""Parquet datasets that grow by one partition per batch."""

from verbalance.sinks import control
from verbalance.sources.records import read_dataset


def write_batch(df, path, batch_id):
    """Write the rows of one batch, replacing all that an earlier try of it left.

    No row is moved: each task writes its own files. A batch without rows leaves
    an empty partition. A batch that was compacted is closed.
    """
    _, compacted = control.latest_version(df.sparkSession, path)
    if compacted and batch_id in compacted["batches"]:
        raise ValueError(f"batch {batch_id} of {path} is closed")
    df.drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_batches(df, path):
    """Write rows of several batches, replacing those batches."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def write_split(df, path, column):
    """Write ``df`` split by ``column`` into one folder per value."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def append_rows(df, path):
    df.write.mode("append").parquet(path)


def dataset_appender(path):
    """A sink for run audit rows; a run whose row is there is not added again."""

    def append(df):
        known = read_dataset(df.sparkSession, path, df.schema).select("run_id")
        append_rows(df.join(known, "run_id", "left_anti").select(*df.columns), path)

    return append
