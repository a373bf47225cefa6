"""Stored records: bronze, intake audit, and rows held by the caller."""

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbalance import session
from verbalance.functions import paths
from verbalance.schemas import BRONZE, INTAKE_AUDIT
from verbalance.sinks import control

_CORRUPT = "_corrupt_record"
# Fixed value: the audit array of the single-machine job lies next to its records.
LEGACY_AUDIT = "processing_audit.json"
_log = logging.getLogger(__name__)


def read_json_records(spark, path, schema=BRONZE, multi_line=True, keep_corrupt=False):
    """JSON records by declared schema: absent keys give NULL, other keys are dropped.

    ``multi_line`` reads one object, or one array of objects, per file; without it
    each line is a record and large files are split. An unreadable record gives a
    row of NULLs; ``keep_corrupt`` keeps its text in ``_corrupt_record``.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(path)
    )


def read_legacy_bronze(spark, directory, fill_file_name=False, keep_corrupt=False):
    """One JSON file per record, in a directory that may also hold the audit array.

    Failed records carry their file name as ``audio_file``. It is ignored unless
    ``fill_file_name`` is set.
    """
    schema = T.StructType([*BRONZE.fields, T.StructField("audio_file", T.StringType())])
    found = read_json_records(spark, f"{directory}/*.json", schema, keep_corrupt=keep_corrupt)
    found = found.where(paths.file_name(F.col("_metadata.file_path")) != LEGACY_AUDIT)
    if fill_file_name:
        found = found.withColumn("audio_filename", F.coalesce("audio_filename", "audio_file"))
    return found.drop("audio_file")


def land(read, target):
    """Write the records of a ``keep_corrupt`` read: readable and unreadable ones.

    Text is parsed once; later passes read columns of the written table.
    """
    landed = session.written(read, target)
    corrupt = F.col(_CORRUPT).isNotNull()
    return landed.where(~corrupt).drop(_CORRUPT), landed.where(corrupt).select(_CORRUPT)


def read_dataset(spark, path, schema):
    """A stored parquet dataset; no rows, with the schema, where there is none yet.

    Of batches that were compacted the rewritten rows are read.
    """
    _, compacted = control.latest_version(spark, path)
    if compacted:
        return _partly_compacted(spark, path, schema, compacted)
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _partly_compacted(spark, path, schema, compacted):
    folders = [f"{path}/{folder}" for folder in compacted["folders"]]
    rows = spark.read.schema(schema).parquet(*folders).select(*schema.names)
    others = control.batch_ids(spark, path, compacted["batches"])
    if not others:
        return rows
    partitions = [f"{path}/batch_id={batch}" for batch in others]
    reader = spark.read.schema(schema).option("basePath", path)
    return rows.unionByName(reader.parquet(*partitions).select(*schema.names))


def read_audit_history(spark, dataset, legacy_file=None):
    """Earlier intake audit rows: the stored dataset and, if given, an old JSON array.

    An old array that cannot be parsed is reported and gives no rows. The dataset
    is only ever added to, so nothing is lost by going on.
    """
    history = read_dataset(spark, dataset, INTAKE_AUDIT)
    if legacy_file is None:
        return history
    read = read_json_records(spark, legacy_file, INTAKE_AUDIT, keep_corrupt=True)
    rows, corrupt = land(read, session.scratch_path(spark, "legacy_audit"))
    if not corrupt.isEmpty():
        _log.warning("unreadable intake audit history in %s", legacy_file)
    return history.unionByName(rows)


def rows_frame(spark, rows, schema):
    """A frame of a few rows held by the driver, such as one audit record.

    Keys the schema lacks are refused and absent keys are NULL, so rows of
    different kinds always give the same columns.
    """
    names = set(schema.names)
    for row in rows:
        unknown = set(row) - names
        if unknown:
            raise ValueError(f"columns not in the schema: {sorted(unknown)}")
    return spark.createDataFrame([tuple(row.get(n) for n in schema.names) for row in rows], schema)
