"""Joins that stay balanced when a few keys hold a large share of the rows.

A key is hot when one side has more rows or bytes of it than one task should handle, or
when both sides together give more joined rows or bytes. Hot keys are found on hashed keys only, so the pass moves a few numbers per distinct
key. They are kept as a written table, of any length, that Spark broadcasts or
shuffles by its size; nothing is collected.

Rows of a hot key are spread over several splits by a hash of their own columns
and of the number of the partition they are read in, which tells full copies apart.
Unlike a random number this gives the same split when a lost task is rerun.
"""

from pyspark.sql import functions as F

from verbalance import session

ROWS_PER_SPLIT = 200_000
PAIRS_PER_SPLIT = 1_000_000
BYTES_PER_SPLIT = 256 * 1024 * 1024


def rows_per_split(row_bytes):
    """How many rows of that size one task should take."""
    return max(1, min(ROWS_PER_SPLIT, int(BYTES_PER_SPLIT // max(row_bytes, 1))))


def _splits(rows, size, per_split):
    by_rows, by_size = F.ceil(rows / F.lit(per_split)), F.ceil(size / F.lit(BYTES_PER_SPLIT))
    return F.greatest(F.lit(1), by_rows, by_size).cast("int")


def _joined_splits(rows, sizes):
    """Splits of both sides taken together that bound the joined rows and bytes of each."""
    (left, right), (left_size, right_size) = rows, sizes
    pairs, size = left * right, left * right_size + right * left_size
    by_pairs = F.ceil(pairs / F.lit(PAIRS_PER_SPLIT))
    return F.greatest(F.lit(1), by_pairs, F.ceil(size / F.lit(BYTES_PER_SPLIT)))


def hot_from_counts(
    counts, key_hash, left_rows, right_rows, per_split=ROWS_PER_SPLIT, left_bytes=None, right_bytes=None
):
    """Hot keys from a table with one row per key and its rows and bytes on each side.

    Each split of one side meets each of the other, so sides are split further until their
    joined rows fit too, the larger side more so that fewer bytes are repeated.
    Returns a written table of hashed keys and splits, or None if no key is hot.
    """
    sizes = [F.lit(0) if size is None else size for size in (left_bytes, right_bytes)]
    values = zip(("_lrows", "_rrows", "_lbytes", "_rbytes"), (left_rows, right_rows, *sizes))
    measured = counts.select(
        key_hash.alias("_key_hash"), *[v.cast("double").alias(n) for n, v in values]
    )
    lrows, rrows, lbytes, rbytes = (F.col(n) for n in measured.columns[1:])
    ls, rs, wanted = F.col("_ls"), F.col("_rs"), F.col("_wanted")
    share = (lbytes + lrows) / F.greatest(rbytes + rrows, F.lit(1))

    def at_least(splits, needed, rows):
        more = F.greatest(splits, F.least(F.ceil(needed), wanted, rows)).cast("int")
        return F.when(wanted > ls * rs, more).otherwise(splits)

    hot = (
        measured.withColumn("_ls", _splits(lrows, lbytes, per_split))
        .withColumn("_rs", _splits(rrows, rbytes, per_split))
        .withColumn("_wanted", _joined_splits((lrows, rrows), (lbytes, rbytes)))
        .withColumn("_ls", at_least(ls, F.sqrt(wanted * share), lrows))
        .withColumn("_rs", at_least(rs, wanted / ls, rrows))
        .withColumn("_ls", at_least(ls, wanted / rs, lrows))
        .select("_key_hash", "_ls", "_rs")
        .where("_ls > 1 or _rs > 1")
    )
    hot = session.written(hot, session.scratch_path(counts.sparkSession, "hot-keys"))
    return None if hot.isEmpty() else hot


def find_hot(left, right, key, per_split=ROWS_PER_SPLIT, left_bytes=None, right_bytes=None):
    """Hot keys of a join; ``right=None`` says the right side has one row per key.

    ``left_bytes`` and ``right_bytes`` are columns that tell what a row takes, where
    rows are wide.
    """
    none = F.lit(0)
    sizes = [none if size is None else F.coalesce(size, none) for size in (left_bytes, right_bytes)]
    names = ("left_rows", "left_bytes", "right_rows", "right_bytes")

    def side(df, *values):
        values = [F.lit(0).cast("bigint") if v is None else v.cast("bigint") for v in values]
        return df.select(
            F.xxhash64(key).alias("key_hash"), *[v.alias(n) for v, n in zip(values, names)]
        )

    both = side(left, F.lit(1), sizes[0], None, None)
    if right is not None:
        # A NULL key joins nothing, however many rows have it.
        known = right.where(F.col(key).isNotNull())
        both = both.unionByName(side(known, None, None, F.lit(1), sizes[1]))
    counts = both.groupBy("key_hash").agg(*[F.sum(n).alias(n) for n in names])
    return hot_from_counts(
        counts,
        F.col("key_hash"),
        F.col("left_rows"),
        F.col("right_rows"),
        per_split,
        F.col("left_bytes"),
        F.col("right_bytes"),
    )


def _salted(df, key, hot, own, other, own_salt, other_salt, spread):
    """Put each row in one of its own splits and in every split of the other side."""
    looked_up = (
        df.withColumn("_key_hash", F.xxhash64(key))
        .join(hot, "_key_hash", "left")
        .drop("_key_hash")
    )
    splits = F.coalesce(F.col(own), F.lit(1))
    every = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
    place = F.xxhash64(*spread, F.spark_partition_id())
    return (
        looked_up.withColumn(own_salt, F.pmod(place, splits).cast("int"))
        .withColumn(other_salt, F.explode(every))
        .drop(own, other)
    )


def balanced_join(left, right, key, how="inner", hot=None, left_spread=(), right_spread=()):
    """``left.join(right, key, how)`` with the rows of hot keys spread out.

    The spread columns tell rows of one key apart. For any join but an inner one
    the right side must hold one row per key.
    """
    if hot is None:
        return left.join(right, key, how)
    if how != "inner":
        hot = hot.withColumn("_rs", F.lit(1))
    left = _salted(left, key, hot, "_ls", "_rs", "_lsalt", "_rsalt", left_spread or [key])
    right = _salted(right, key, hot, "_rs", "_ls", "_rsalt", "_lsalt", right_spread or [key])
    return left.join(right, [key, "_lsalt", "_rsalt"], how).drop("_lsalt", "_rsalt")
