"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Only DataFrame operations are used, and no text is read after its words are counted.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from verbalance import session

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 16
MOST_PASSES = 3
WEIGHTS = (1, 2, 3)
ROWS_PER_SHARD = 2000
MOST_SHARDS = 10_000


def sainte_lague(items, group, order):
    """``items`` with ``quota``: ``seats`` of each group dealt by highest quotients.

    ``items`` has ``value`` (double), ``seats`` (the same in all of a group) and
    ``cap``. Seat k + 1 of an item has the quotient ``value / (2 k + 1)``; ties go
    by ``order``. With n items an item gets its share ``seats * value / sum`` up to
    ``n / 2 * value / sum + 1/2``, so only quotients that close to the share are
    laid out and ranked, a few per item; the lower ones are won in any case.
    """
    whole = Window.partitionBy(*group)
    total = F.sum("value").over(whole)
    share = F.when(total > 0, F.col("seats") * F.col("value") / total).otherwise(F.lit(0.0))
    reach = F.when(
        total > 0, F.ceil(F.col("value") / total * F.sum(F.lit(0.5)).over(whole)) + 1
    ).otherwise(F.lit(0))
    low = F.least(F.greatest(F.floor(share - reach), F.lit(0)), F.col("cap"))
    high = F.least(F.ceil(share + reach), F.col("cap"))
    framed = items.withColumn("_low", low.cast("long")).withColumn("_high", high.cast("long"))
    framed = framed.withColumn("_left", F.col("seats") - F.sum("_low").over(whole))
    seat = F.when(
        F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1)
    )
    quotients = framed.select(*group, *order, "_left", "value", F.explode(seat).alias("_seat"))
    best = Window.partitionBy(*group).orderBy(
        F.desc(F.col("value") / (2 * F.col("_seat") + 1)), *order, "_seat"
    )
    won = (
        quotients.withColumn("_rank", F.row_number().over(best))
        .where("_rank <= _left")
        .groupBy(*group, *order)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    return (
        framed.join(won, [*group, *order], "left")
        .withColumn("quota", F.col("_low") + F.coalesce(F.col("_won"), F.lit(0)))
        .drop("_low", "_high", "_left", "_won")
    )


def source_targets(sizes, weights=WEIGHTS, most_passes=MOST_PASSES):
    """One row per source: ``source, place, docs, source_size, target``.

    Sources in code point order, null last, take the weights in turn. Targets sum
    to the size of the input and stop at ``most_passes`` times their source.
    The windows run over one row per source.
    """
    sources = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumn("place", F.row_number().over(by_name))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.get(listed, F.pmod(F.col("place") - 1, F.lit(len(weights))))
    cap = F.lit(float(most_passes)) * F.col("source_size")
    sources = sources.withColumn("_w", weight).withColumn("_cap", cap)
    # A level per unit of weight: those whose own limit lies below it are full.
    ratio = F.col("_cap") / F.col("_w")
    before = Window.orderBy(ratio, "place").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weights_left = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    sources = sources.withColumn("_level", left / weights_left)
    reached = F.when(ratio >= F.col("_level"), F.col("_level"))
    level = F.coalesce(F.max(reached).over(every), F.lit(0.0))
    return sources.withColumn("target", F.least(F.col("_cap"), level * F.col("_w"))).drop(
        "_w", "_cap", "_level"
    )


def mix(docs, weights=WEIGHTS, block_words=BLOCK_WORDS, most_passes=MOST_PASSES, seed=17):
    """How many words of each document the mix takes, repeats counted.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are ignored.
    The documents of a source are dealt into shards, and put in seeded order within
    their shard. This order, read over and over, is cut into blocks of
    ``block_words`` words. Sources get blocks by highest quotients of their
    targets, shards get theirs by highest quotients of their sizes, and a shard
    gives its first blocks. No document is taken more than ``most_passes`` times.

    Returns ``doc_id, source, size, source_size, target, taken``, one row for each
    of the input; null text has no words, null is a source of its own. Repeated
    rows are dealt like any others. The same input gives the same rows again.
    """
    spark = docs.sparkSession
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = session.written(
        docs.select("doc_id", "source", words.alias("size")),
        session.scratch_path(spark, "mix-sizes"),
    )
    targets = source_targets(sizes, weights, most_passes)
    most = F.floor(F.lit(most_passes) * F.col("source_size") / F.lit(block_words))
    wanted = F.round(F.sum("source_size").over(Window.partitionBy()) / F.lit(block_words))
    items = targets.select(
        "*",
        F.lit(0).alias("all"),
        F.col("target").alias("value"),
        wanted.cast("long").alias("seats"),
        most.cast("long").alias("cap"),
    )
    rows = F.greatest(
        F.lit(float(ROWS_PER_SHARD)), F.sum("docs").over(Window.partitionBy()) / MOST_SHARDS
    )
    sources = sainte_lague(items, ["all"], ["place"]).select(
        F.col("source").alias("_source"),
        "place",
        "source_size",
        "target",
        "quota",
        "docs",
    )
    sources = session.written(
        sources.withColumn("shards", F.ceil(F.col("docs") / rows)).drop("docs"),
        session.scratch_path(spark, "mix-sources"),
    )

    dealt = sizes.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "place",
        "quota",
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("shards")).alias("shard"),
    )
    shards = dealt.groupBy("place", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("quota").alias("seats")
    )
    shards = shards.withColumn("value", F.col("shard_size").cast("double")).withColumn(
        "cap", F.floor(F.lit(most_passes) * F.col("shard_size") / F.lit(block_words))
    )
    given = sainte_lague(shards, ["place"], ["shard"]).select(
        F.col("place").alias("_place"),
        F.col("shard").alias("_shard"),
        "shard_size",
        (F.col("quota") * F.lit(block_words)).alias("given"),
    )
    order = Window.partitionBy("place", "shard").orderBy(
        F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "size"
    ).rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("_end", F.sum("size").over(order)).join(
        given, (F.col("place") == F.col("_place")) & (F.col("shard") == F.col("_shard"))
    )
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("given") / F.col("shard_size")))
    passes = F.coalesce(passes, F.lit(0))
    rest = F.col("given") - passes * F.col("shard_size")
    start = F.col("_end") - F.col("size")
    part = F.greatest(F.least(F.col("_end"), rest) - start, F.lit(0))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (passes * F.col("size") + part).cast("long").alias("taken"),
    )


def mixed_documents(docs, **options):
    """``docs`` as the mix takes them: a row once for each time its text is taken.

    Takes are whole but for one document of a shard, whose last part counts from
    half its words. A document that is not taken leaves.
    """
    plan = mix(docs, **options).where("taken > 0").select(
        F.col("doc_id").alias("_doc"),
        F.col("source").alias("_from"),
        F.col("size").alias("_size"),
        F.round(F.col("taken") / F.col("size")).cast("int").alias("_times"),
    )
    # Rows that share id, source and size are alike to the plan: their takes add up and are dealt again.
    summed = plan.groupBy("_doc", "_from", "_size").agg(F.sum("_times").alias("_times"))
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    own = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", "source", words.alias("size")
    )
    alike = Window.partitionBy("doc_id", "source", "size")
    joined = (
        own.withColumn("nth", F.row_number().over(alike.orderBy(F.xxhash64("row.text"))))
        .withColumn("rows", F.count(F.lit(1)).over(alike))
        .join(
            summed,
            F.col("doc_id").eqNullSafe(F.col("_doc"))
            & F.col("source").eqNullSafe(F.col("_from"))
            & (F.col("size") == F.col("_size")),
        )
    )
    base = F.floor(F.col("_times") / F.col("rows"))
    extra = (F.col("nth") <= F.col("_times") - base * F.col("rows")).cast("long")
    times = (base + extra).cast("int")
    copies = F.explode(F.when(times > 0, F.sequence(F.lit(1), times))).alias("copy")
    return joined.select("row", copies).select("row.*")
