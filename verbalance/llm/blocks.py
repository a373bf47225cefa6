"""Pairs within buckets, in blocks of bounded size."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

BLOCK = 256
PAIRS_AT_ONCE = 1_000_000


def block_rows(rows, size=BLOCK):
    """``bucket, low, high, part, id`` from ``bucket, id``; each pair of a bucket meets in one unit.

    A bucket of more than ``size`` members is dealt into parts by a hash of the id.
    A unit ``bucket, low, high`` holds one part (with itself) or two, and never
    grows with its bucket. In a unit of two parts only pairs across them count.
    Buckets of one member are left out.
    """
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(size)).cast("int").alias("parts")
    dealt = rows.join(counts.select("bucket", parts), "bucket").withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit(3)), F.col("parts")).cast("int")
    )
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return paired.select(
        "bucket",
        F.least("part", "other").alias("low"),
        F.greatest("part", "other").alias("high"),
        "part",
        "id",
    )


def run_starts(*columns):
    """Where runs of equal values start in sorted columns, and the length as last entry."""
    n = len(columns[0])
    change = np.zeros(n, dtype=bool)
    change[:1] = True
    for column in columns:
        change[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(change), n)


def pairs_in_runs(starts):
    """Index pairs i < j within each run, a bounded number at a time."""
    lengths = np.diff(starts)
    ends = np.repeat(starts[1:], lengths)
    rows = np.arange(starts[-1])
    partners = ends - rows - 1
    upto = np.concatenate(([0], np.cumsum(partners)))
    first = 0
    while first < len(rows):
        last = int(np.searchsorted(upto, upto[first] + PAIRS_AT_ONCE, side="right")) - 1
        last = max(last, first + 1)
        counts = partners[first:last]
        total = int(counts.sum())
        if total:
            i = np.repeat(rows[first:last], counts)
            j = i + 1 + np.arange(total) - np.repeat(upto[first:last] - upto[first], counts)
            yield i, j
        first = last


def whole_units(batches, rows=50_000):
    """Arrow batches of sorted units regrouped so that no unit is cut."""
    names = ("bucket", "low", "high")
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        last = tuple(table.column(n)[-1].as_py() for n in names)
        same = np.ones(table.num_rows, dtype=bool)
        for n, v in zip(names, last):
            same &= table.column(n).to_numpy() == v
        cut = int(np.argmax(same))
        held = table.slice(cut).combine_chunks().to_batches()
        if cut:
            yield table.slice(0, cut)
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)
