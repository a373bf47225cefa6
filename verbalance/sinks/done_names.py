"""Names that are done, in buckets, with a Bloom filter for each bucket.

A run is a folder of names, one partition per bucket, that is never changed. A new run
holds the names of some batches; small runs are merged, so that their number grows with the
logarithm of the names. A lookup reads the filters of the buckets its names are in, and of
those the names of buckets whose filter does not rule all of them out. Nothing else is read,
however long the history is.
"""

import uuid

from pyspark.sql import functions as F

from verbalance import fixed
from verbalance.functions import paths
from verbalance.sinks import control

BUCKETS = 256
# Bits per name and probes give one wrong hit in about 300 names.
BITS_PER_NAME, PROBES = 12, 6
WORD = 64
_NAMES = "base_name string, batch_id string, bucket int"
_FILTERS = "bucket int, words int, bits array<bigint>"


def _bucket(buckets):
    return F.pmod(F.xxhash64("base_name"), F.lit(buckets)).cast("int").alias("bucket")


def _probe(number, bits):
    return F.pmod(F.xxhash64(F.lit(number), "base_name"), bits)


def _filters(names):
    """One row per bucket: its filter as a dense array of 64-bit words."""
    sizes = names.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) * BITS_PER_NAME / WORD).cast("int").alias("words")
    )
    # One row per bucket at most.
    sized = names.join(F.broadcast(sizes), "bucket")
    bits = F.col("words") * F.lit(WORD)
    places = F.array(*[_probe(i, bits) for i in range(PROBES)])
    set_words = sized.select("bucket", "words", F.explode(places).alias("place")).select(
        "bucket",
        "words",
        F.floor(F.col("place") / WORD).cast("int").alias("word"),
        F.expr(f"shiftleft(1L, cast(place % {WORD} as int))").alias("bits"),
    )
    every_word = sizes.select(
        "bucket",
        "words",
        F.explode(F.sequence(F.lit(0), F.col("words") - 1)).alias("word"),
        F.lit(0).cast("bigint").alias("bits"),
    )
    whole = set_words.unionByName(every_word).groupBy("bucket", "words", "word").agg(
        F.bit_or("bits").alias("bits")
    )
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return whole.groupBy("bucket", "words").agg(ordered["bits"].alias("bits"))


def _may_hold(words, bits):
    hits = None
    for i in range(PROBES):
        place = _probe(i, words * F.lit(WORD))
        word = F.get(bits, F.floor(place / WORD).cast("int"))
        hit = F.getbit(word, place % WORD) == 1
        hits = hit if hits is None else hits & hit
    return hits


class DoneNames:
    """The index of a store. ``buckets`` counts when the index is new; afterwards its own number holds.

    One writer at a time: a second one that commits the same version fails.
    """

    def __init__(self, spark, root, buckets=BUCKETS):
        self.spark = spark
        self.root = root
        self.new_buckets = buckets

    def _state(self):
        number, content = control.latest_version(self.spark, self.root)
        return number, content or {"buckets": self.new_buckets, "runs": []}

    def batches(self):
        """Ids of the batches whose names are in the index."""
        return {b for run in self._state()[1]["runs"] for b in run["batches"]}

    def add(self, names, batches):
        """Add ``base_name, batch_id`` rows, all that the given batches have.

        Adding a batch again changes nothing.
        """
        number, state = self._state()
        known = {b for run in state["runs"] for b in run["batches"]}
        batches = sorted(set(batches) - known)
        if not batches:
            return
        rows = names.where(F.col("batch_id").isin(batches) & F.col("base_name").isNotNull())
        rows = rows.select("base_name", "batch_id").distinct()
        runs = list(state["runs"])
        run = self._write(rows, state["buckets"])
        merged = [run]
        # A run is merged with those before it that are not much larger, as long as there are any.
        while runs and runs[-1]["names"] <= 2 * sum(r["names"] for r in merged):
            merged.append(runs.pop())
        if len(merged) > 1:
            folders = [f"{self.root}/names/{r['folder']}" for r in merged if r["names"]]
            old = self._read(folders) if folders else rows.limit(0)
            run = self._write(old.select("base_name", "batch_id"), state["buckets"])
        run["batches"] = sorted(set(batches).union(*[r.get("batches", []) for r in merged]))
        control.commit_version(
            self.spark, self.root, number + 1, {"buckets": state["buckets"], "runs": [*runs, run]}
        )

    def drop(self, batch):
        """Forget a batch, which is about to be taken in again."""
        number, state = self._state()
        runs = []
        for run in state["runs"]:
            if batch in run["batches"]:
                left = self._read([f"{self.root}/names/{run['folder']}"]) if run["names"] else None
                kept = sorted(set(run["batches"]) - {batch})
                if left is not None:
                    run = self._write(
                        left.where(F.col("batch_id") != batch).select("base_name", "batch_id"),
                        state["buckets"],
                    )
                run = {**run, "batches": kept}
            runs.append(run)
        if runs != state["runs"]:
            content = {"buckets": state["buckets"], "runs": runs}
            control.commit_version(self.spark, self.root, number + 1, content)

    def _write(self, rows, buckets):
        folder = uuid.uuid4().hex
        path = f"{self.root}/names/{folder}"
        (
            rows.withColumn("bucket", _bucket(buckets))
            .repartition("bucket")
            .write.partitionBy("bucket")
            .parquet(path)
        )
        written = self.spark.read.schema(_NAMES).parquet(path)
        # Coalesced in order of the bucket, so that a file's statistics tell its buckets.
        filters = _filters(written).repartitionByRange("bucket").sortWithinPartitions("bucket")
        filters.write.parquet(f"{self.root}/filters/{folder}")
        return {"folder": folder, "names": written.count()}

    def _read(self, folders):
        return self.spark.read.schema(_NAMES).option("recursiveFileLookup", True).parquet(*folders)

    def touched(self, names):
        """``(folder, bucket)`` of the partitions that may hold one of ``names`` (``base_name``).

        At most as many as runs times buckets.
        """
        _, state = self._state()
        live = [r for r in state["runs"] if r["names"]]
        if not live:
            return []
        asked = names.select("base_name", _bucket(state["buckets"]))
        buckets = [r["bucket"] for r in asked.select("bucket").distinct().collect()]
        found = []
        for run in live:
            filters = self.spark.read.schema(_FILTERS).parquet(f"{self.root}/filters/{run['folder']}")
            hit = (
                asked.join(filters.where(F.col("bucket").isin(buckets)), "bucket")
                .where(_may_hold(F.col("words"), F.col("bits")))
                .select("bucket")
                .distinct()
            )
            found += [(run["folder"], r["bucket"]) for r in hit.collect()]
        return found

    def lookup(self, names):
        """Rows ``base_name, batch_id`` of the index that may be asked for; a few others besides.

        Only partitions that may hold a name asked for are in the plan.
        """
        folders = [f"{self.root}/names/{f}/bucket={b}" for f, b in self.touched(names)]
        if not folders:
            return self.spark.createDataFrame([], "base_name string, batch_id string")
        return self._read(folders).select("base_name", "batch_id")


def done_in(bronze):
    """``base_name, batch_id`` of the successful records with an id."""
    done = (F.col("status") == fixed.SUCCESS) & (F.col("audio_id") != "")
    return bronze.where(done).select(
        paths.base_name(F.col("audio_filename")).alias("base_name"), "batch_id"
    )


def catch_up(index, bronze_path, read_bronze):
    """Add the batches of bronze that the index does not have yet.

    Bronze is written before the index; a run that broke off between the two is made good here.
    Only the partitions of those batches are read.
    """
    missing = control.batch_ids(index.spark, bronze_path, index.batches())
    if missing:
        index.add(done_in(read_bronze().where(F.col("batch_id").isin(missing))), missing)
    return missing
