"""A Merkle manifest of a dataset, with a proof for every row by pointer jumping.

Rows are leaves of one tree per source; the roots of those trees are the leaves of a top
tree. A node knows the siblings on its way to some ancestor. A self-join hands it the way
that ancestor knows, so that the distance doubles until every node has reached the root.
Leaves are not jumped themselves: a run of up to sixteen leaves has one parent, and takes
the finished way from there.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from verbalance import session

FANOUT = 16
_SHIFT = 4
_TOP = -1
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# monotonically_increasing_id keeps the partition above this bit and the row below it.
_ROW_BITS = 33
RESULT = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def _framed(column):
    """``-`` for null, else the byte count, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")
    )


def leaf_digest(text):
    """The leaf of a row with that text, in lowercase hex."""
    columns = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*map(_framed, [*columns, text])), 256)


def default_tampering():
    """Where 5 divides the CRC-32 of the id's digits, and the text that stands there instead."""
    fold = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5
    return F.coalesce(fold == 0, F.lit(False)), F.translate("text", UPPER, UPPER.lower())


def numbered(rows, order, group, label):
    """Add ``place``, counted from 0 in each group, ``n``, its rows, and ``tree``, its number.

    ``order`` must start with ``group`` and tell rows apart. Rows are sorted over range
    partitions, so a group may span many of them. Groups are counted per partition first:
    what is ranked by a window are the pieces of a group, of which there are as many as
    partitions at most. ``tree`` ascends in the order of the groups.
    """
    spark = rows.sparkSession
    ordered = session.written(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("spot", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("spot", _ROW_BITS)),
        session.scratch_path(spark, f"{label}-ordered"),
    )
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        ordered.groupBy("part", group)
        .agg(F.min("spot").alias("first"), F.count(F.lit(1)).alias("rows"))
        .select(
            F.col("part").alias("of_part"),
            F.col(group).alias("of_group"),
            "first",
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
            F.sum("rows").over(whole).alias("n"),
            F.min("first").over(whole).alias("tree"),
        )
    )
    # A piece lies in one partition, so no key of this join has more rows than a partition.
    same = (F.col("part") == F.col("of_part")) & F.col(group).eqNullSafe(F.col("of_group"))
    placed = ordered.join(pieces, same).withColumn(
        "place", F.col("spot") - F.col("first") + F.col("before")
    )
    return placed.drop("spot", "part", "of_part", "of_group", "first", "before")


def _runs(nodes, *carried):
    """Nodes in runs of sixteen: ``tree, n, run, kids, digest``. The lone node of a tree is kept as it is."""
    kid = F.struct("place", "digest", *carried)
    kids = F.sort_array(F.collect_list(kid)).alias("kids")
    hashed = F.sha2(F.array_join("kids.digest", ""), 256)
    return (
        nodes.withColumn("run", F.shiftright("place", _SHIFT))
        .groupBy("tree", "n", "run")
        .agg(kids)
        .withColumn("digest", F.when(F.col("n") > 1, hashed).otherwise(F.col("kids")[0]["digest"]))
    )


def _parents(runs):
    return runs.select(
        "tree",
        F.shiftright(F.col("n") + (FANOUT - 1), _SHIFT).alias("n"),
        F.col("run").alias("place"),
        "digest",
    )


def _id(tree, level, place):
    return F.struct(
        tree.cast("bigint").alias("tree"),
        level.cast("int").alias("level"),
        place.cast("bigint").alias("place"),
    )


def _siblings(kids, index):
    """The digests of a run before and after one of its members."""
    return F.struct(
        F.array_join(F.slice(kids, F.lit(1), index), "").alias("left"),
        F.array_join(F.slice(kids, index + 2, F.lit(FANOUT)), "").alias("right"),
    )


def _exploded(runs, *kept):
    """One row per member of a run: ``kid`` and ``index`` besides ``kept`` and the digests of all."""
    return runs.select(
        "tree", "run", F.col("kids.digest").alias("all"), *kept, F.posexplode("kids")
    ).select(
        "tree", "run", "all", *kept, F.col("pos").alias("index"), F.col("col").alias("kid")
    )


def _links(runs, level):
    """Nodes of one level, each with the siblings on its way to its parent."""
    members = _exploded(runs)
    return members.select(
        _id(F.col("tree"), F.lit(level), F.col("kid.place")).alias("id"),
        _id(F.col("tree"), F.lit(level + 1), F.col("run")).alias("anc"),
        F.array(_siblings(F.col("all"), F.col("index"))).alias("way"),
        F.lit(None).cast("string").alias("subroot"),
    )


def _levels(spark, nodes, most, level, label):
    """Levels above ``nodes`` of which the largest tree has ``most``: links, and the nodes that stay alone."""
    links, alone = [], []
    while most > 1:
        alone.append((level, nodes.where("n = 1")))
        runs = session.written(
            _runs(nodes.where("n > 1")), session.scratch_path(spark, f"{label}-{level}")
        )
        links.append(_links(runs, level))
        nodes, level, most = _parents(runs), level + 1, -(-most // FANOUT)
    alone.append((level, nodes))
    return links, alone


def _union(frames):
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


def _jump(spark, nodes, root, height):
    """Double the distance that every node sees until the highest of them sees the root."""
    root_id = _id(*[F.lit(v) for v in root])
    reach = 1
    while reach < height:
        # Ancestors so far away are above that many levels, so that few nodes are left on this side.
        ahead = nodes.where((F.col("id.tree") == _TOP) | (F.col("id.level") > reach)).select(
            F.col("id").alias("anc"),
            F.col("anc").alias("next"),
            F.col("way").alias("rest"),
            F.col("subroot").alias("met"),
        )
        done = nodes.where(F.col("anc") == root_id)
        jumped = (
            nodes.where(F.col("anc") != root_id)
            .join(ahead, "anc")
            .select(
                "id",
                F.col("next").alias("anc"),
                F.concat("way", "rest").alias("way"),
                F.coalesce("subroot", "met").alias("subroot"),
            )
        )
        nodes = session.written(
            done.unionByName(jumped), session.scratch_path(spark, f"merkle-reach-{2 * reach}")
        )
        reach *= 2
    return nodes


def manifest(docs, tampering=default_tampering):
    """Leaf, subroot, root and proof of every row, and whether it still proves the root.

    ``docs`` needs ``doc_id, source, lang, n_chars, text``; other columns are ignored, and
    any of the five may be null. ``tampering()`` gives a condition and the text that a row
    has where it holds; the proof is folded from that row, all digests else come from the
    original. Leaves of a source ascend by id, null first, then by leaf: rows with one id and
    different contents have a fixed order, and equal rows have equal leaves, so that any order
    of them gives the same rows. Null is a source of its own, the first one. Sources and
    groups of any size are split over range partitions. An empty table gives no rows.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "n_chars", "text")
    changed, other = tampering()
    leaves = session.written(
        plain.select(
            "doc_id",
            "source",
            leaf_digest(F.col("text")).alias("digest"),
            F.when(changed, leaf_digest(other)).alias("tampered"),
            # Tells equal rows apart, so that a range may end between them.
            F.monotonically_increasing_id().alias("row"),
        ),
        session.scratch_path(spark, "merkle-leaves"),
    )
    placed = numbered(leaves, ("source", "doc_id", "digest", "row"), "source", "merkle-leaves")
    bottom = session.written(
        _runs(placed, "tampered", "doc_id"), session.scratch_path(spark, "merkle-runs")
    )
    largest = bottom.agg(F.max("n")).first()[0]
    if largest is None:
        return spark.createDataFrame([], RESULT)

    links, alone = _levels(spark, _parents(bottom), -(-largest // FANOUT), 1, "merkle-level")
    subroots = _union(
        frame.select("tree", F.lit(level).alias("level"), "digest") for level, frame in alone
    ).withColumnRenamed("tree", "source_tree")
    ranked = numbered(
        subroots.withColumn("all", F.lit(0)), ("all", "source_tree"), "all", "merkle-subroots"
    ).withColumn("tree", F.lit(_TOP).cast("bigint"))
    top = session.written(
        _runs(ranked, "source_tree", "level"), session.scratch_path(spark, "merkle-top")
    )
    sources = top.agg(F.max("n")).first()[0]
    source_id = _id(F.col("kid.source_tree"), F.col("kid.level"), F.lit(0))
    members = _exploded(top, "n")
    if sources == 1:
        only = members.select(source_id.alias("id")).first()["id"]
        root_id = (only["tree"], only["level"], only["place"])
        anc, way = source_id, F.array().cast("array<struct<left: string, right: string>>")
        root = members.select("kid.digest").first()[0]
        height = only["level"] - 1
    else:
        anc = _id(F.lit(_TOP), F.lit(1), F.col("run"))
        way = F.array(_siblings(F.col("all"), F.col("index")))
        upper, ends = _levels(spark, _parents(top), -(-sources // FANOUT), 1, "merkle-top")
        level, last = ends[-1]
        root = last.first()["digest"]
        root_id = (_TOP, level, 0)
        links += upper
        height = len(alone) - 1 + level
    links.append(
        members.select(
            source_id.alias("id"),
            anc.alias("anc"),
            way.alias("way"),
            F.col("kid.digest").alias("subroot"),
        )
    )
    nodes = session.written(_union(links), session.scratch_path(spark, "merkle-links"))
    nodes = _jump(spark, nodes, root_id, height)

    siblings = _siblings(F.col("all"), F.col("index"))
    joined = F.array_join(F.transform("way", lambda s: F.concat(s["left"], s["right"])), "")
    own = F.coalesce("kid.tampered", "kid.digest")
    runs = (
        bottom.withColumn("id", _id(F.col("tree"), F.lit(1), F.col("run")))
        .join(nodes.select("id", "way", "subroot", joined.alias("joined")), "id")
    )
    return (
        _exploded(runs, "way", "subroot", "joined")
        .withColumn("beside", siblings)
        .withColumn(
            "parent",
            F.when(
                F.size("all") + F.col("run") > 1,
                F.sha2(F.concat("beside.left", own, "beside.right"), 256),
            ).otherwise(own),
        )
        .select(
            F.col("kid.doc_id").alias("doc_id"),
            F.col("kid.digest").alias("leaf"),
            # With one source its subroot is the root, above which nothing is met.
            F.coalesce("subroot", F.lit(root)).alias("subroot"),
            F.lit(root).alias("root"),
            F.sha2(F.concat("beside.left", "beside.right", "joined"), 256).alias("proof_sha256"),
            F.aggregate(
                "way",
                F.col("parent"),
                lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256),
            ).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
