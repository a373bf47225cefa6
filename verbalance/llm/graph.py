"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import functions as F

from verbalance import session

MAX_ROUNDS = 60


def _large_star(edges):
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    return both.where("b > a").join(lowest, "a").select(F.col("low").alias("a"), "b")


def _small_star(edges):
    """Edges run from the smaller to the larger node; each node hangs on its smallest neighbour."""
    lowest = edges.groupBy("b").agg(F.min("a").alias("low"))
    joined = edges.join(lowest, "b")
    return joined.select(F.col("low").alias("a"), "b").union(
        joined.where("a <> low").select(F.col("low").alias("a"), F.col("a").alias("b"))
    )


def _state(edges):
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges, label="components"):
    """``node, component`` for every node of the undirected edges ``a, b`` (long).

    ``component`` is the smallest node reachable. Nodes without an edge to another
    node are not listed. Each round is a written table, so a lost executor costs
    one round; a node with very many edges is combined before it is shuffled.
    """
    spark = edges.sparkSession
    ordered = edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    current = session.written(ordered.distinct(), session.scratch_path(spark, label))
    before = _state(current)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        step = _small_star(_large_star(current).distinct()).distinct()
        current = session.written(step, session.scratch_path(spark, label))
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)


def class_nodes(classes, members, same, label):
    """A node ``id`` for each class of equal contents, and edges between classes that share a member.

    ``classes`` has one row per class: ``same``, the columns that tell classes apart, and ``first``,
    its smallest member; ``members`` has a row ``member, same`` per row of the table. A class is the
    node of its smallest member. Where a member comes with several contents, several classes have
    the same smallest member; one of them is its node, the others get numbers above all members, and
    edges join all classes of a member. So the smallest node of a component is always a member.
    """
    spark = classes.sparkSession
    repeated = members.groupBy("member").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = session.written(repeated.select("member"), session.scratch_path(spark, f"{label}-repeated"))
    contents = members.join(repeated, "member").select("member", *same).distinct()
    several = contents.groupBy("member").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty() or several.isEmpty():
        return classes.withColumn("id", F.col("first")), None
    least = classes.groupBy("first").agg(F.min(F.struct(*same)).alias("least"))
    above = classes.agg(F.max("first")).first()[0] + 1
    number = F.lit(above) + F.monotonically_increasing_id()
    numbered = session.written(
        classes.join(least, "first")
        .withColumn("id", F.when(F.struct(*same) == F.col("least"), F.col("first")).otherwise(number))
        .drop("least"),
        session.scratch_path(spark, f"{label}-nodes"),
    )
    nodes = (
        contents.join(several.select("member"), "member")
        .join(numbered.select(*same, "id"), same)
        .select("member", "id")
    )
    lowest = nodes.groupBy("member").agg(F.min("id").alias("a"))
    edges = nodes.join(lowest, "member").where("id > a").select("a", F.col("id").alias("b"))
    return numbered, session.written(edges, session.scratch_path(spark, f"{label}-same"))
