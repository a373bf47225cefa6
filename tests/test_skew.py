import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from verbalance.operators import skew


@pytest.fixture(scope="module")
def sides(spark):
    """One key holds a third of the rows on both sides; there are NULL keys as well."""
    rng = random.Random(7)

    def keys(n):
        keys = [rng.choice(["hot"] * 10 + [f"k{i}" for i in range(18)] + [None] * 2) for _ in range(n)]
        return keys

    left = [(k, i) for i, k in enumerate(keys(300))]
    right = [(k, -i) for i, k in enumerate(keys(60))]
    return (
        spark.createDataFrame(left, "key string, l int"),
        spark.createDataFrame(right, "key string, r int"),
    )


def test_hot_keys_are_found_on_both_sides(spark, sides):
    left, right = sides
    hot = skew.find_hot(left, right, "key", per_split=15)
    names = spark.createDataFrame([("hot",)], "key string").select(F.xxhash64("key")).first()[0]
    by_key = {h["_key_hash"]: h for h in hot.collect()}
    assert by_key[names]["_ls"] == -(-left.where("key = 'hot'").count() // 15)
    assert by_key[names]["_rs"] == -(-right.where("key = 'hot'").count() // 15)
    assert skew.find_hot(left, right, "key") is None


def test_inner_join_is_unchanged(sides):
    left, right = sides
    hot = skew.find_hot(left, right, "key", per_split=15)
    got = skew.balanced_join(left, right, "key", "inner", hot, ["l"], ["r"])
    plain = left.join(right, "key")
    assert got.columns == plain.columns
    assert rows_of(got) == rows_of(plain)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_join_with_one_row_per_key_is_unchanged(sides, how):
    left, right = sides
    right = right.where("key <> 'k3'").groupBy("key").agg(F.max("r").alias("r"))
    hot = skew.find_hot(left, None, "key", per_split=15)
    got = skew.balanced_join(left, right, "key", how, hot, ["l"])
    assert hot is not None and rows_of(got) == rows_of(left.join(right, "key", how))


def test_rows_of_a_hot_key_are_joined_by_several_tasks(spark, sides):
    left, right = sides
    hot = skew.find_hot(left, right, "key", per_split=15)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)

        def tasks(frame):
            hot_rows = frame.where("key = 'hot'")
            return hot_rows.select(F.spark_partition_id().alias("p")).distinct().count()

        assert tasks(left.join(right, "key")) == 1
        assert tasks(skew.balanced_join(left, right, "key", "inner", hot, ["l"], ["r"])) > 4
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_full_copies_are_spread_as_well(spark):
    copies = spark.range(0, 400, 1, 8).selectExpr("'hot' as key", "1 as l")
    right = spark.createDataFrame([("hot", 2)], "key string, r int")
    hot = skew.find_hot(copies, right, "key", per_split=50)
    joined = skew.balanced_join(copies, right, "key", "inner", hot, ["l"], ["r"])
    assert rows_of(joined) == [("hot", 1, 2)] * 400
    salted = skew._salted(
        copies,
        "key",
        hot,
        "_ls", "_rs", "_lsalt", "_rsalt", ["l"],
    )
    assert salted.select("_lsalt").distinct().count() > 1


def test_few_wide_rows_are_split_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(skew, "BYTES_PER_SPLIT", 1000)
    left = spark.createDataFrame([("hot", "x" * 500)] * 9 + [("k", None)], "key string, l string")
    right = spark.createDataFrame([("hot", 1), ("k", 2)], "key string, r int")
    assert skew.find_hot(left, right, "key") is None
    hot = skew.find_hot(left, right, "key", left_bytes=F.octet_length("l"))
    assert [(h["_ls"], h["_rs"]) for h in hot.collect()] == [(5, 1)]
    got = skew.balanced_join(left, right, "key", "inner", hot, ["l"], ["r"])
    assert rows_of(got) == rows_of(left.join(right, "key"))


def test_wide_rows_give_smaller_splits():
    assert skew.rows_per_split(10) == skew.ROWS_PER_SPLIT
    assert skew.rows_per_split(1024 * 1024) == 256
    assert skew.rows_per_split(0) == skew.ROWS_PER_SPLIT
    assert skew.rows_per_split(10**12) == 1


def test_small_sides_with_many_joined_rows_are_split(spark, monkeypatch):
    monkeypatch.setattr(skew, "PAIRS_PER_SPLIT", 100)
    left = spark.range(80).selectExpr("if(id < 60, 'hot', null) as key", "id as l")
    right = spark.range(50).selectExpr("if(id < 40, 'hot', if(id < 41, 'k', null)) as key", "id as r")
    hot = skew.find_hot(left, right, "key")
    (found,) = hot.collect()
    assert found["_ls"] * found["_rs"] >= 60 * 40 / 100 and found["_ls"] <= 60 and found["_rs"] <= 40
    got = skew.balanced_join(left, right, "key", "inner", hot, ["l"], ["r"])
    assert rows_of(got) == rows_of(left.join(right, "key"))


def test_joined_rows_are_split_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(skew, "BYTES_PER_SPLIT", 10_000)
    left = spark.range(30).selectExpr("'hot' as key", "repeat('x', 100) as l")
    right = spark.range(20).selectExpr("'hot' as key", "repeat('y', 200) as r")
    sizes = {"left_bytes": F.octet_length("l"), "right_bytes": F.octet_length("r")}
    (found,) = skew.find_hot(left, right, "key", **sizes).collect()
    assert found["_ls"] * found["_rs"] >= 30 * 20 * 300 / 10_000
    # One row on a side cannot be split, so the other is.
    monkeypatch.setattr(skew, "BYTES_PER_SPLIT", 4_000)
    (found,) = skew.find_hot(left, right.limit(1), "key", **sizes).collect()
    assert (found["_ls"], found["_rs"]) == (3, 1)
