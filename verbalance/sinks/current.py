"""The latest record of each base name, kept as a table instead of being worked out by each reader.

Names are in buckets by hash. A refresh takes up the batches that are new, and writes again
only the buckets that one of their names is in: a new folder holds the merged buckets, and
a new version points to it. Readers see the buckets of one version, whole.
"""

import uuid

from pyspark.sql import functions as F

from verbalance.functions import paths
from verbalance.operators import dedup
from verbalance.schemas import BRONZE
from verbalance.sinks import control

BUCKETS = 64


class CurrentTable:
    """The current records of a store. ``buckets`` counts when the table is new.

    One writer at a time: a second one that commits the same version fails.
    """

    def __init__(self, spark, root, buckets=BUCKETS):
        self.spark = spark
        self.root = root
        self.new_buckets = buckets

    def _state(self):
        number, content = control.latest_version(self.spark, self.root)
        return number, content or {"buckets": self.new_buckets, "batches": [], "folders": {}}

    def _read(self, folders):
        if not folders:
            return self.spark.createDataFrame([], BRONZE)
        places = [f"{self.root}/records/{f}/bucket={b}" for b, f in sorted(folders.items())]
        reader = self.spark.read.schema(BRONZE).option("recursiveFileLookup", True)
        return reader.parquet(*places)

    def read(self):
        """One row per base name; records without a name are all there."""
        return self._read(self._state()[1]["folders"])

    def forget(self, batch):
        """Start anew if the table has a batch that is about to be taken in again.

        Which records its own had replaced is not kept, so the next refresh reads all of bronze.
        """
        number, state = self._state()
        if batch in state["batches"]:
            content = {"buckets": state["buckets"], "batches": [], "folders": {}}
            control.commit_version(self.spark, self.root, number + 1, content)

    def refresh(self, bronze_path, read_bronze):
        """Take up the batches of bronze that are not in the table yet; returns their ids."""
        number, state = self._state()
        new = control.batch_ids(self.spark, bronze_path, state["batches"])
        if not new:
            return []
        name = paths.base_name(F.col("audio_filename"))
        bucket = F.pmod(F.xxhash64(name), F.lit(state["buckets"])).cast("int")
        arrived = read_bronze().where(F.col("batch_id").isin(new))
        # No more than there are buckets.
        touched = {str(r[0]) for r in arrived.select(bucket).distinct().collect()}
        held = self._read({b: f for b, f in state["folders"].items() if b in touched})
        merged = dedup.latest_records(held.unionByName(arrived.select(*BRONZE.names)), name)
        folder = uuid.uuid4().hex
        (
            merged.drop("base_name")
            .withColumn("bucket", bucket)
            .repartition("bucket")
            .write.partitionBy("bucket")
            .parquet(f"{self.root}/records/{folder}")
        )
        content = {
            "buckets": state["buckets"],
            "batches": sorted({*state["batches"], *new}),
            "folders": {**state["folders"], **{b: folder for b in touched}},
        }
        control.commit_version(self.spark, self.root, number + 1, content)
        return new
