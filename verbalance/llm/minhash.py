"""Near-duplicate documents by many universal hash minima, banded, verified and joined up.

Documents of equal shingle sets form a class and go on as one. Bands of equal minima
propose pairs: first each member with the two ends of its bucket, then, where a
bucket still spans several components, the members across components, in blocks.
Signatures sort out pairs that cannot reach the threshold; full sets decide.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from verbalance import session
from verbalance.llm import blocks, graph, words

BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
PERCENT = 80
_MARKS = (
    "doc_id bigint, text_key bigint, n_shingles bigint, print1 bigint, print2 bigint, "
    "signature binary"
)
# A pair at the threshold shares 0.8 of its minima, give or take 0.035; this is 4.9 times that lower.
LEAST_SHARED = 0.63
CHARS_AT_ONCE = 1_000_000
SHINGLES_AT_ONCE = 50_000
MEMBERS_PER_TASK = 64
# A unit of an open bucket holds two parts of about so many members.
MEMBERS_PER_PART = 512
# Ids are 8 bytes; a broadcast of so many takes about 32 MB.

_rng = np.random.default_rng(811)
_FACTORS = _rng.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**64, MINIMA, dtype=np.uint64)
_PLACES = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts, size):
    """The sorted distinct shingles of each text, as 64-bit hashes.

    Fewer words than ``size`` are one shingle; no words give an empty set.
    """
    hashes, offsets = words.word_hashes(texts)
    every = np.zeros(max(len(hashes) - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        every += hashes[k : k + len(every)] * _PLACES[k]
    every = words.mix(every)
    sets = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        n = end - start
        if n >= size:
            sets.append(np.unique(every[start : end - size + 1]))
        elif n:
            few = (hashes[start:end] * _PLACES[:n]).sum(dtype=np.uint64) + np.uint64(n)
            sets.append(words.mix(np.array([few], dtype=np.uint64)))
        else:
            sets.append(hashes[:0])
    return sets


def signature(shingles):
    """The smallest value of each universal hash over a set that is not empty."""
    lowest = np.full(MINIMA, 2**32 - 1, dtype=np.uint64)
    for start in range(0, len(shingles), SHINGLES_AT_ONCE):
        part = shingles[start : start + SHINGLES_AT_ONCE]
        for i in range(0, MINIMA, 16):
            values = part * _FACTORS[i : i + 16, None] + _SHIFTS[i : i + 16, None]
            np.minimum(lowest[i : i + 16], (values >> np.uint64(32)).min(axis=1), out=lowest[i : i + 16])
    return lowest


def _mark(size):
    def run(batches):
        for whole in batches:
            for start, end in words.slabs(words.text_sizes(whole.column("text")), CHARS_AT_ONCE):
                part = whole.slice(start, end - start)
                sets = shingle_sets([t or "" for t in part.column("text").to_pylist()], size)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_print(s, 0x5851F42D4C957F2D) for s in sets], pa.int64()),
                        pa.array([_print(s, 0x14057B7EF767814F) for s in sets], pa.int64()),
                        pa.array(
                            [signature(s).astype("<u2").tobytes() if len(s) else None for s in sets],
                            pa.binary(),
                        ),
                    ],
                    names=[field.split()[0] for field in _MARKS.split(", ")],
                )

    return run


def _print(shingles, salt):
    """One half of a 128-bit hash of a set."""
    return int(words.mix(shingles ^ np.uint64(salt)).sum(dtype=np.uint64).view(np.int64))


def band_rows(heads):
    """``bucket, id`` for each band: equal minima of a band are one bucket, the band its low bits."""

    def bucket(band):
        minima = F.substring("signature", 2 * ROWS * band + 1, 2 * ROWS)
        return F.xxhash64(minima).bitwiseAND(F.lit(-BANDS)).bitwiseOR(F.lit(band))

    buckets = F.array(*[bucket(band) for band in range(BANDS)])
    return heads.select("id", F.explode(buckets).alias("bucket"))


def _confirm(size, percent):
    """Streams ``task, role, id, text``: the set of role 0 is held, the others are compared with it."""

    def run(batches):
        held, held_id = None, None
        for whole in batches:
            for start, end in words.slabs(words.text_sizes(whole.column("text")), CHARS_AT_ONCE):
                part = whole.slice(start, end - start).to_pydict()
                sets = shingle_sets([t or "" for t in part["text"]], size)
                left, right = [], []
                for role, node, own in zip(part["role"], part["id"], sets):
                    if role == 0:
                        held, held_id = own, node
                        continue
                    if _linked(held, own, percent):
                        left.append(held_id)
                        right.append(node)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
                )

    return run


def _texts_of(rows, heads, texts):
    """``rows`` with the text of their class: that of one row of its first document.

    Joined by document and hash of the text, both sides shuffled once whatever their size.
    """
    named = rows.join(heads.select("id", F.col("first").alias("doc_id"), "text_key"), "id")
    return named.join(texts, ["doc_id", "text_key"]).drop("doc_id", "text_key")


def _confirmed(pairs, texts, heads, size, percent):
    """The pairs ``a, b`` whose full sets reach the threshold.

    Members are brought to the set of ``a``; an ``a`` with many is dealt over
    several tasks, each of which holds one set at a time.
    """
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MEMBERS_PER_TASK)
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(MEMBERS_PER_TASK)), F.lit(1))
    dealt = pairs.join(many, "a", "left").withColumn(
        "task",
        F.struct("a", F.pmod(F.xxhash64("b", F.lit(9)), parts).cast("int").alias("part")),
    )
    needed = dealt.select("task", F.lit(1).alias("role"), F.col("b").alias("id")).unionByName(
        dealt.select("task", F.lit(0).alias("role"), F.col("a").alias("id")).distinct()
    )
    rows = _texts_of(needed, heads, texts).select("task", "role", "id", "text").repartition("task")
    return rows.sortWithinPartitions("task", "role").mapInArrow(
        words.giving_back(_confirm(size, percent)), "a bigint, b bigint"
    )


_UNIT = ["bucket", "low", "high"]
_FOUND = (
    "bucket bigint, low int, high int, part int, id bigint, component bigint, signature binary"
)
_FOUND_NAMES = [field.split()[0] for field in _FOUND.split(", ")]


def _candidates(table):
    """Index pairs of a table of whole units: across components, with enough equal minima.

    A pair counts in the first band it shares, so in one unit.
    """
    names = (*_UNIT, "part", "component")
    column = {n: table.column(n).to_numpy() for n in names}
    packed = b"".join(table.column("signature").to_pylist())
    minima = np.frombuffer(packed, dtype="<u2").reshape(-1, MINIMA)
    band = column["bucket"] & (BANDS - 1)
    for i, j in blocks.pairs_in_runs(blocks.run_starts(*[column[n] for n in _UNIT])):
        apart = (column["component"][i] != column["component"][j]) & (
            (column["low"][i] == column["high"][i]) | (column["part"][i] != column["part"][j])
        )
        i, j = i[apart], j[apart]
        for s in range(0, len(i), 100_000):
            x, y = i[s : s + 100_000], j[s : s + 100_000]
            equal = minima[x] == minima[y]
            near = equal.mean(axis=1) >= LEAST_SHARED
            x, y, equal = x[near], y[near], equal[near]
            first = equal.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
            here = first == band[x]
            yield x[here], y[here]


def _with_candidates(batches):
    """The rows of units that have a candidate there; the pairs themselves do not leave."""
    for table in blocks.whole_units(batches):
        chosen = np.zeros(table.num_rows, dtype=bool)
        for x, y in _candidates(table):
            chosen[x] = chosen[y] = True
        kept = table.filter(pa.array(chosen)).select(_FOUND_NAMES)
        yield from kept.combine_chunks().to_batches()


def _confirm_units(size, percent):
    """Compares the full sets of a unit's candidates, and tells the links that join it up.

    A pair that links of the unit already join needs no comparison.
    """

    def run(batches):
        for table in blocks.whole_units(batches, rows=2_000):
            texts = table.column("text").to_pylist()
            sets = []
            for start, end in words.slabs([len(t or "") for t in texts], CHARS_AT_ONCE):
                sets += shingle_sets([t or "" for t in texts[start:end]], size)
            ids = table.column("id").to_pylist()
            root = list(range(len(ids)))

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            left, right = [], []
            for i, j in _candidates(table):
                for x, y in zip(i.tolist(), j.tolist()):
                    if find(x) == find(y) or not _linked(sets[x], sets[y], percent):
                        continue
                    root[find(x)] = find(y)
                    left.append(min(ids[x], ids[y]))
                    right.append(max(ids[x], ids[y]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    return run


def _linked(one, other, percent):
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(other) - both)


def _by_unit(rows):
    return rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT)


def _open_units(open_rows, size=MEMBERS_PER_PART):
    """``bucket, low, high, part, id`` from ``bucket, id, component``, as of ``blocks.block_rows``.

    Members of a bucket's largest component need not meet each other. They have
    parts of their own, each of which meets the parts of the rest only, so they
    are laid out once per part of the rest and not once per part of the bucket.
    """
    own = open_rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = (
        own.groupBy("bucket")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("bulk"))
        .select(
            "bucket",
            F.col("bulk.component").alias("bulk"),
            F.ceil(F.col("bulk.n") / F.lit(size)).cast("int").alias("bulk_parts"),
            F.ceil((F.col("n") - F.col("bulk.n")) / F.lit(size)).cast("int").alias("rest_parts"),
        )
        .where("rest_parts > 0")
    )
    in_bulk = F.col("component") == F.col("bulk")
    place = F.xxhash64("id", F.lit(3))
    dealt = open_rows.join(buckets, "bucket").select(
        "bucket",
        "id",
        F.when(in_bulk, F.col("rest_parts") + F.pmod(place, "bulk_parts"))
        .otherwise(F.pmod(place, "rest_parts"))
        .cast("int")
        .alias("part"),
        F.when(in_bulk, F.col("rest_parts"))
        .otherwise(F.col("rest_parts") + F.col("bulk_parts"))
        .alias("partners"),
    )
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("partners") - 1)))
    return paired.select(
        "bucket",
        F.least("part", "other").alias("low"),
        F.greatest("part", "other").alias("high"),
        "part",
        "id",
    )


def _more_edges(open_rows, heads, reached, texts, size, percent):
    """Links across components within the buckets of ``open_rows``, found in blocks."""
    payload = _with_component(heads, reached).select("id", "signature", "component")
    units = _open_units(open_rows).join(payload, "id")
    rows = _by_unit(units).mapInArrow(words.giving_back(_with_candidates), _FOUND)
    rows = session.written(rows, session.scratch_path(open_rows.sparkSession, "near-units"))
    return _by_unit(_texts_of(rows, heads, texts)).mapInArrow(
        words.giving_back(_confirm_units(size, percent)), "a bigint, b bigint"
    )


def near_duplicates(docs, shingle_words=2, percent=PERCENT):
    """One row per document with the class of documents reachable by near-duplicate links.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. A
    document's set are its distinct shingles of ``shingle_words`` words
    ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; fewer words are one shingle. Documents
    are linked if their sets share ``percent`` of their union or more. A null id is
    linked with nothing (its ``component_id`` is null and it is kept), nor is a text
    without words. Rows that repeat an id are one document, each with a row; if their
    texts differ, the document is linked with whatever any of them is linked with.

    Returns ``doc_id, n_shingles, component_id, kept``; ``component_id`` is the smallest
    ``doc_id`` reachable, and ``kept`` says that it is this one.
    """
    spark = docs.sparkSession

    def written(df, label):
        return session.written(df, session.scratch_path(spark, f"near-{label}"))

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    marks = written(texts.mapInArrow(words.giving_back(_mark(shingle_words)), _MARKS), "marks")
    same = ["print1", "print2", "n_shingles"]
    linked = marks.where("doc_id is not null and n_shingles > 0")
    # A class is one row from here on; copies are combined before the shuffle.
    first = F.min(F.struct("doc_id", "text_key", "signature")).alias("least")
    classes = written(
        linked.groupBy(*same)
        .agg(first)
        .select(*same, F.col("least.doc_id").alias("first"), "least.text_key", "least.signature"),
        "classes",
    )
    members = linked.select(F.col("doc_id").alias("member"), *same)
    classes, identities = graph.class_nodes(classes, members, same, "near")
    heads = classes.select("id", "first", "text_key", "signature")
    # Rows given several times are one text.
    given = marks.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own_texts = texts if given.isEmpty() else texts.dropDuplicates(["doc_id", "text_key"])

    # Each member of a bucket with the two ends of it.
    rows = band_rows(heads)
    ends = rows.groupBy("bucket").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")
    )
    members = written(rows.join(ends.where("n > 1"), "bucket"), "members")
    stars = members.select(F.explode(F.array("first", "last")).alias("end"), "id")
    pairs = stars.where("end <> id").select(
        F.least("end", "id").alias("a"), F.greatest("end", "id").alias("b")
    )
    tested = written(_likely(pairs.distinct(), heads), "pairs")
    edges = written(_confirmed(tested, own_texts, heads, shingle_words, percent), "edges")
    if identities is not None:
        edges = edges.union(identities)
    reached = written(graph.components(edges, "near-components"), "reached")

    # Buckets of three and more that still span several components.
    wide = _with_component(members.where("n > 2"), reached)
    spanning = (
        wide.groupBy("bucket")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x < y")
    )
    open_rows = wide.join(spanning, "bucket", "left_semi").select("bucket", "id", "component")
    open_rows = written(open_rows, "open")
    if not open_rows.isEmpty():
        more = _more_edges(open_rows, heads, reached, own_texts, shingle_words, percent)
        edges = edges.union(written(more, "more"))
        reached = written(graph.components(edges, "near-components"), "all")

    named = _with_component(classes.select(*same, "id"), reached).drop("id")
    found = marks.join(named, same, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias(
            "component_id"
        ),
    )
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _with_component(df, reached):
    """``df`` with the component of ``id``, which is the id itself where nothing is linked."""
    by_id = reached.select(F.col("node").alias("id"), F.col("component").alias("found"))
    joined = df.join(by_id, "id", "left")
    return joined.withColumn("component", F.coalesce("found", "id")).drop("found")


def _likely(pairs, heads):
    """Pairs whose signatures share enough minima to reach the threshold."""
    left = heads.select(F.col("id").alias("a"), F.col("signature").alias("left"))
    right = heads.select(F.col("id").alias("b"), F.col("signature").alias("right"))

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(s), dtype="<u2").reshape(-1, MINIMA) for s in (x, y))
        return pd.Series((x == y).mean(axis=1) >= LEAST_SHARED)

    return pairs.join(left, "a").join(right, "b").where(near("left", "right")).select("a", "b")


def kept_documents(docs, shingle_words=5, percent=PERCENT):
    """The rows of ``docs`` that stay, whole: one document of each group, null ids untouched.

    Rows that repeat the id that stays all stay.
    """
    gone = near_duplicates(docs, shingle_words, percent).where("not kept")
    gone = gone.select(F.col("doc_id").alias("gone_id")).distinct()
    gone = session.written(gone, session.scratch_path(docs.sparkSession, "near-gone"))
    own = docs.select(F.struct(*docs.columns).alias("row"))
    found = own.join(gone, F.col("row.doc_id") == F.col("gone_id"), "left_anti")
    return found.select("row.*")
