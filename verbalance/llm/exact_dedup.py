"""Exact deduplication as a stream over keyed state that is kept on disk and never expires.

The state holds, per digest, the smallest document id, where its content lies and
the number of rows. A digest that occurs again is a hit, and all texts of a hit are
compared byte for byte. Only DataFrame operations are used.
"""

from pyspark.sql import functions as F

from verbalance import session

BLANKS = r"[\x20\x09-\x0D]+"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Hit digests are 64 characters; a broadcast of so many takes about 25 MB.
BROADCAST_HITS = 200_000
CARRIED_SETTINGS = (
    "spark.sql.shuffle.partitions",
    "spark.sql.ansi.enabled",
    "spark.sql.session.timeZone",
)


def normalized(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def sha256(text):
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _streaming_session(spark):
    """A session of its own, so that its settings disturb no other job."""
    own = spark.newSession()
    for key in CARRIED_SETTINGS:
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rocksdb = "spark.sql.streaming.stateStore.rocksdb"
    own.conf.set(f"{rocksdb}.changelogCheckpointing.enabled", "true")
    own.conf.set(f"{rocksdb}.boundedMemoryUsage", "true")
    own.conf.set(f"{rocksdb}.maxMemoryUsageMB", "256")
    # Many small stores would each claim megabytes of disk ahead of use.
    own.conf.set(f"{rocksdb}.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return own


def stream_groups(spark, table, files_per_batch=1000):
    """``digest, keep_id, locator, members`` of a written table of digests.

    Every micro-batch writes the state of the digests it touched. State only
    grows: the last entry of a digest has the most members and the smallest id.
    """
    own = _streaming_session(spark)
    schema = spark.read.parquet(table).schema
    touched = session.scratch_path(spark, "dedup-touched")
    arriving = (
        own.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d")
        .parquet(table)
    )
    state = arriving.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"),
        F.min_by("locator", "doc_id").alias("locator"),
        F.sum("copies").alias("members"),
    )

    def keep(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{touched}/epoch={epoch}")

    run = (
        state.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", session.scratch_path(spark, "dedup-state"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    shape = "digest string, keep_id bigint, locator string, members bigint"
    if run.lastProgress is None:
        return spark.createDataFrame([], shape)
    return (
        spark.read.schema(shape)
        .parquet(touched)
        .groupBy("digest")
        .agg(
            F.min("keep_id").alias("keep_id"),
            F.min_by("locator", "keep_id").alias("locator"),
            F.max("members").alias("members"),
        )
    )


def _differing(docs, digest, hits):
    """Digests of hits whose texts are not all the same bytes."""
    texts = docs.select(normalized(F.col("text")).alias("norm"))
    texts = texts.select(digest(F.col("norm")).alias("digest"), "norm")
    if hits.count() <= BROADCAST_HITS:
        texts = texts.join(F.broadcast(hits), "digest", "left_semi")
    # Combined before the shuffle: a task sends two texts per digest, however many copies it has.
    return (
        texts.groupBy("digest")
        .agg(F.min("norm").alias("first"), F.max("norm").alias("last"))
        .where("first <> last")
        .select("digest")
    )


def exact_dedup(docs, digest=sha256, files_per_batch=1000):
    """One row per document with the document that stays for it.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. Texts are equal
    if they are after each run of ``[\\x20\\x09-\\x0D]`` became one space; null
    counts as empty. The smallest ``doc_id`` stays; null ids come last. Of rows
    that repeat one id and text, one stays. An empty table gives no rows.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, where the text that
    stays lies (``locator``), and how many rows share this id and text (``repeats``).
    """
    spark = docs.sparkSession
    norm = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        normalized(F.col("text")).alias("norm"),
        F.input_file_name().alias("locator"),
    )
    marks = (
        norm.select(
            "doc_id",
            digest(F.col("norm")).alias("digest"),
            sha256(F.col("norm")).alias("text_sha256"),
            "locator",
        )
        .groupBy("digest", "text_sha256", "doc_id")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("locator").alias("locator"))
    )
    table = session.scratch_path(spark, "dedup-digests")
    marks = session.written(marks, table)
    groups = stream_groups(spark, table, files_per_batch)
    groups = session.written(groups, session.scratch_path(spark, "dedup-groups"))

    hits = groups.where("members > 1").select("digest")
    differing = session.written(
        _differing(docs, digest, hits), session.scratch_path(spark, "dedup-differing")
    )
    same = ["digest"]
    if not differing.isEmpty():
        # Different texts share a digest: group these by their bytes as well.
        listed = norm.select("doc_id", digest(F.col("norm")).alias("digest"), "norm", "locator")
        listed = listed.join(differing, "digest", "left_semi").withColumn(
            "bytes", F.col("norm")
        )
        apart = listed.groupBy("digest", "bytes").agg(
            F.min("doc_id").alias("keep_id"),
            F.min_by("locator", "doc_id").alias("locator"),
            F.count(F.lit(1)).alias("members"),
        )
        marks = marks.join(differing, "digest", "left_anti").select(
            "digest", "text_sha256", "doc_id", "copies", F.lit("").alias("bytes")
        ).unionByName(
            listed.groupBy("digest", "bytes", "doc_id")
            .agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("text_sha256", sha256(F.col("bytes")))
        )
        groups = groups.join(differing, "digest", "left_anti").withColumn(
            "bytes", F.lit("")
        ).unionByName(apart)
        same = ["digest", "bytes"]
    joined = marks.select(*same, "text_sha256", "doc_id", "copies").join(groups, same)
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return joined.select(
        "doc_id", "keep_id", "members", "text_sha256", "locator", "copies", copy
    ).select(
        "doc_id",
        "keep_id",
        F.col("members").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
        "locator",
        F.col("copies").alias("repeats"),
    )


def kept_documents(docs):
    """The rows of ``docs`` that stay, whole; of rows that repeat one id and text, one stays."""
    stay = exact_dedup(docs).where("kept").select(
        F.col("doc_id").alias("stay_id"), "text_sha256", "repeats"
    )
    stay = session.written(stay, session.scratch_path(docs.sparkSession, "dedup-stay"))
    # The row is packed, so that none of its columns can clash with ours.
    own = docs.select(
        F.struct(*docs.columns).alias("row"),
        sha256(normalized(F.col("text"))).alias("text_sha256"),
    )
    found = own.join(
        stay,
        (own.text_sha256 == stay.text_sha256) & F.col("row.doc_id").eqNullSafe(F.col("stay_id")),
        "left_semi",
    )
    if not stay.where("repeats > 1").isEmpty():
        found = found.withColumn("id", F.col("row.doc_id")).dropDuplicates(["id", "text_sha256"])
    return found.select("row.*")
