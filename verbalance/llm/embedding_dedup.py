"""Near-duplicate vectors by cross-polytope hashing with several probes, verified exactly.

A hash is the largest coordinate, with its sign, after three fast Hadamard rotations.
A table joins a few hashes; every vector stands in the bucket of its best coordinates
and, per hash, in the one with its second best. Vectors of equal label that share a bucket are
candidates, and their cosine is computed in double precision.
"""

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from verbalance import session
from verbalance.llm import blocks, graph, words

COSINE = 0.98
MISSED = 1e-7
MOST_TABLES = 64
ROWS_AT_ONCE = 20_000


def rotated(vectors, seed):
    """Three rounds of random signs and a fast Hadamard transform; width is a power of two."""
    width = vectors.shape[1]
    signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (3, width))
    for k in range(3):
        vectors = vectors * signs[k]
        half = 1
        while half < width:
            pairs = vectors.reshape(len(vectors), -1, 2, half)
            low, high = pairs[:, :, 0], pairs[:, :, 1]
            vectors = np.stack((low + high, low - high), axis=2).reshape(len(vectors), -1)
            half *= 2
    return vectors


def _corners(vectors, seed):
    """The two largest coordinates as numbers 2 i + sign, largest first."""
    turned = rotated(vectors, seed)
    size = np.abs(turned)
    rows = np.arange(len(turned))
    best = size.argmax(axis=1)
    size[rows, best] = -1
    second = size.argmax(axis=1) if turned.shape[1] > 1 else best
    return [2 * c + (turned[rows, c] < 0) for c in (best, second)]


def padded(vectors):
    width = 1 << max(vectors.shape[1] - 1, 0).bit_length()
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))


def bucket_ids(vectors, hashes, tables, seed=23):
    """For each vector the 64-bit numbers of its ``tables * (1 + hashes)`` buckets."""
    vectors, out = padded(vectors), []
    for table in range(tables):
        corners = [_corners(vectors, (seed, table, h)) for h in range(hashes)]
        for probe in range(hashes + 1):
            key = np.full(len(vectors), table + 1, dtype=np.uint64)
            for h, (best, second) in enumerate(corners):
                chosen = second if probe == h + 1 else best
                key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + chosen.astype(np.uint64))
            out.append(key)
    return np.stack(out, axis=1)


@functools.lru_cache
def tables_needed(dimensions, hashes, cosine=COSINE, missed=MISSED, trials=4000):
    """Tables with which a pair at the threshold is missed with probability ``missed``.

    The chance to share a bucket of one table is measured on random pairs; it
    depends on nothing but dimensions, hashes and cosine.
    """
    rng = np.random.default_rng(5)
    left = rng.standard_normal((trials, dimensions))
    left /= np.linalg.norm(left, axis=1, keepdims=True)
    other = rng.standard_normal((trials, dimensions))
    other -= (other * left).sum(axis=1, keepdims=True) * left
    norm = np.linalg.norm(other, axis=1, keepdims=True)
    other /= np.where(norm > 0, norm, 1)
    right = cosine * left + math.sqrt(1 - cosine * cosine) * other
    x, y = bucket_ids(left, hashes, 1), bucket_ids(right, hashes, 1)
    shared = (x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).mean()
    shared = min(max(shared - 0.02, 0.01), 0.999)
    return min(MOST_TABLES, math.ceil(math.log(missed) / math.log(1 - shared)))


def _hash_vectors(hashes, tables, kind):
    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                part = whole.slice(start, ROWS_AT_ONCE)
                lists = part.column("embedding")
                lengths = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
                ends = np.cumsum(lengths)
                labels = part.column("label").cast(pa.int64()).to_numpy().astype(np.uint64)
                buckets = np.zeros((part.num_rows, tables * (hashes + 1)), dtype=np.uint64)
                packed = np.empty(part.num_rows, dtype=object)
                for width in np.unique(lengths):
                    rows = np.flatnonzero(lengths == width)
                    vectors = flat[(ends[rows] - width)[:, None] + np.arange(width)]
                    wide = vectors.astype(np.float64)
                    # Only the direction counts; very large or small numbers must not overflow.
                    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
                    own = words.mix(labels[rows] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(width))
                    buckets[rows] = bucket_ids(wide, hashes, tables) ^ own[:, None]
                    for row, vector in zip(rows.tolist(), vectors):
                        packed[row] = vector.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("copies"),
                        pa.array(packed, pa.binary()),
                        pa.array([np.unique(b).view(np.int64) for b in buckets], pa.list_(pa.int64())),
                    ],
                    names=["id", "copies", "vector", "buckets"],
                )

    return run


def _local_roots(n, i, j):
    """The smallest index reachable from each of n nodes by the pairs i, j."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        np.minimum.at(root, before[i], low)
        np.minimum.at(root, before[j], low)
        root = root[root]
        if (root == before).all():
            return root


def _verify(kind, cosine):
    """Streams whole units: counts each linked pair once and joins what is linked.

    A pair that shares several buckets counts in the one with the smallest number.
    What leaves is one row per vector of the unit with links, never the pairs.
    """

    def run(batches):
        for table in blocks.whole_units(batches):
            names = ("bucket", "low", "high", "part", "id", "copies")
            column = {n: table.column(n).to_numpy() for n in names}
            rows = table.num_rows
            packed = table.column("vector").to_pylist()
            sizes = np.array([len(p) for p in packed])
            starts = blocks.run_starts(column["bucket"], column["low"], column["high"])
            order = table.column("buckets").to_pylist()
            links, edges = np.zeros(rows, dtype=np.int64), []
            vectors = np.zeros((rows, int(sizes.max(initial=0)) // np.dtype(kind).itemsize))
            for row, data in enumerate(packed):
                own = np.frombuffer(data, dtype=kind)
                vectors[row, : len(own)] = own
            vectors /= np.abs(vectors).max(axis=1, keepdims=True, initial=1e-300)
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            shared = np.array(order) if len({len(b) for b in order}) == 1 else None
            for i, j in blocks.pairs_in_runs(starts):
                apart = (column["low"][i] == column["high"][i]) | (column["part"][i] != column["part"][j])
                apart &= sizes[i] == sizes[j]
                i, j = i[apart], j[apart]
                for s in range(0, len(i), 50_000):
                    x, y = i[s : s + 50_000], j[s : s + 50_000]
                    dots = np.einsum("ij,ij->i", vectors[x], vectors[y])
                    near = dots >= cosine * (norms[x] * norms[y])
                    x, y = x[near], y[near]
                    for t in range(0, len(x), 5_000):
                        u, v = x[t : t + 5_000], y[t : t + 5_000]
                        here = _first_shared(order, shared, u, v) == column["bucket"][u]
                        u, v = u[here], v[here]
                        np.add.at(links, u, column["copies"][v])
                        np.add.at(links, v, column["copies"][u])
                        edges.append((u, v))
            i = np.concatenate([e[0] for e in edges] or [np.zeros(0, np.int64)])
            j = np.concatenate([e[1] for e in edges] or [np.zeros(0, np.int64)])
            root = _local_roots(rows, i, j)
            told = links > 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column["id"][told]),
                    pa.array(links[told]),
                    pa.array(column["id"][root[told]]),
                ],
                names=["id", "links", "root"],
            )

    return run


def _first_shared(lists, table, i, j):
    """The smallest bucket number both have."""
    if table is None:
        return np.array([min(set(lists[a]) & set(lists[b])) for a, b in zip(i, j)], dtype=np.int64)
    left, right = table[i], table[j]
    common = (left[:, :, None] == right[:, None, :]).any(axis=2)
    return np.where(common, left, np.iinfo(np.int64).max).min(axis=1)


def near_vectors(embeddings, cosine=COSINE):
    """One row per vector with its links and the class it belongs to.

    ``embeddings`` needs ``vec_id`` (long), ``label`` (integer) and ``embedding``
    (array of float or double); other columns are ignored. Vectors of equal label
    and length are linked if their cosine is ``cosine`` or more. A null label or
    id, a vector that is null, empty or zero or holds a null or non-finite component link
    with nothing. Rows that repeat an id are one vector, each with a row. If an id comes with
    several vectors, a row has the links of its own vector, in which each of them counts, and
    their classes are one.

    Returns ``vec_id, n_links, component_id, kept``: how many other vectors are linked
    directly, the smallest ``vec_id`` reachable, and whether it is this one.
    """
    spark = embeddings.sparkSession

    def written(df, label):
        return session.written(df, session.scratch_path(spark, f"vectors-{label}"))

    kind = "float64" if "double" in dict(embeddings.dtypes)["embedding"] else "float32"
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    fit = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    )
    marks = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        "embedding",
        fit.alias("fit"),
        F.xxhash64("label", "embedding").alias("print1"),
        F.xxhash64(F.lit(31), "embedding", "label").alias("print2"),
    )
    same = ["print1", "print2"]
    # Equal vectors are one class from here on, combined before the shuffle.
    classes = written(
        marks.where("fit")
        .groupBy(*same)
        .agg(
            F.min("vec_id").alias("first"),
            F.count_distinct("vec_id").alias("copies"),
            F.min(F.struct("label", "embedding")).alias("row"),
        )
        .select(*same, "first", "copies", "row.label", "row.embedding"),
        "classes",
    )
    members = marks.where("fit").select(F.col("vec_id").alias("member"), *same)
    classes, identities = graph.class_nodes(classes, members, same, "vectors")
    heads = classes
    per_label = heads.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("d"))
    most, width = per_label.agg(F.max("n"), F.max("d")).first()
    # More hashes with more rows, so that a bucket holds few vectors by chance.
    corners = 2 << max((width or 1) - 1, 0).bit_length()
    hashes = max(2, math.ceil(math.log(max(most or 1, 1)) / math.log(max(corners, 2))))
    tables = tables_needed(width or 1, hashes, cosine)
    heads = written(
        heads.select("id", "copies", "label", "embedding").mapInArrow(
            _hash_vectors(hashes, tables, kind),
            "id bigint, copies bigint, vector binary, buckets array<bigint>",
        ),
        "hashed",
    )
    unit = ["bucket", "low", "high"]
    rows = heads.select("id", F.explode("buckets").alias("bucket"))
    found = (
        blocks.block_rows(rows)
        .join(heads, "id")
        .select(*unit, "part", "id", "copies", "vector", "buckets")
        .repartition(*unit)
        .sortWithinPartitions(*unit)
        .mapInArrow(_verify(kind, cosine), "id bigint, links bigint, root bigint")
    )
    found = written(found, "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("root").alias("a"), F.col("id").alias("b"))
    reached = graph.components(edges if identities is None else edges.union(identities))
    named = (
        classes.select(*same, "id", "copies")
        .join(links, "id", "left")
        .join(reached, F.col("id") == F.col("node"), "left")
        .select(
            *same,
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    joined = marks.select("vec_id", "fit", *same).join(named, same, "left")
    component = F.when(F.col("fit"), F.col("component")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("fit"), F.col("links")).otherwise(F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
