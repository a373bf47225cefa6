"""Bounded samples of labelled documents, on which models are fitted."""

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from verbalance import session

FOLDS = 5
SEED = 2027


def held_out(doc_id):
    """Documents no label is learnt from: every fifth by the CRC-32 of the id's digits."""
    fold = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def with_fold(docs):
    """``doc_id, held_out, text``, whatever other columns there are."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "text")


def _first_ids(marked, per_class):
    """``doc_id, label, spot`` of the first ``per_class`` distinct ids of each label by a hash.

    Ranked in two steps: parts of a label first, by another hash, so that no task sorts a label.
    """
    spark = marked.sparkSession
    usable = marked.where("doc_id is not null and label is not null").where(
        ~held_out(F.col("doc_id"))
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = usable.select("doc_id", "label").distinct()
    placed = distinct.withColumn("spot", F.xxhash64(F.lit(SEED), "doc_id")).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(parts))
    )
    for group in (["label", "part"], ["label"]):
        first = Window.partitionBy(*group).orderBy("spot", "doc_id")
        placed = placed.withColumn("rank", F.row_number().over(first)).where(
            F.col("rank") <= per_class
        )
    return placed.select("doc_id", "label", "spot")


def sample_table(marked, docs, per_class, most_bytes):
    """A written table ``spot, label, text`` of at most ``per_class`` ids per label and ``most_bytes`` of text.

    ``marked`` has ``doc_id, label``. Outside the held-out fold the first distinct ids in order of a
    hash are taken, so every run takes the same, each with one text: the least that is not empty, if
    it has several. A text that does not fit is passed over; if none of a label fits, its shortest is
    taken. The driver sees ids and sizes of the sample, never its texts.
    """
    spark = docs.sparkSession
    # At most per_class rows for each label.
    chosen = session.written(_first_ids(marked, per_class), session.scratch_path(spark, "sample-ids"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.nullif("text", F.lit("")).alias("text"))
    ids = F.broadcast(chosen.select("doc_id").distinct())
    found = session.written(
        texts.join(ids, "doc_id")
        .groupBy("doc_id")
        .agg(F.coalesce(F.min("text"), F.lit("")).alias("text")),
        session.scratch_path(spark, "sample-texts"),
    )
    sized = found.select("doc_id", F.octet_length("text").alias("bytes"))
    by_label = {}
    for row in chosen.join(sized, "doc_id").collect():
        by_label.setdefault(row["label"], []).append((row["spot"], row["doc_id"], row["bytes"]))
    taken = []
    for label, own in by_label.items():
        total, before = 0, len(taken)
        for spot, doc_id, size in sorted(own):
            if total + size <= most_bytes:
                total += size
                taken.append((spot, doc_id, label))
        if len(taken) == before:
            spot, doc_id, _ = min(own, key=lambda r: (r[2], r[0], r[1]))
            taken.append((spot, doc_id, label))
    # Sent as Arrow: a list of rows would start Python workers of their own kind on every executor.
    columns = {name: [row[i] for row in taken] for i, name in enumerate(("spot", "doc_id", "label"))}
    picked = spark.createDataFrame(
        pa.table(columns, to_arrow_schema(chosen.select("spot", "doc_id", "label").schema))
    )
    return found.join(F.broadcast(picked), "doc_id").select("spot", "label", "text")


def take_sample(marked, docs, per_class, most_bytes):
    """``label, text`` of the rows of ``sample_table``, in a fixed order, on the driver."""
    rows = sample_table(marked, docs, per_class, most_bytes).collect()
    return [(r["label"], r["text"]) for r in sorted(rows, key=lambda r: (r["spot"], repr(r["label"])))]
