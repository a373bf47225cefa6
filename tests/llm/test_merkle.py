"""The manifest against one built level by level with plain lists."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tests.conftest import rows_of
from verbalance.llm import merkle

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8")).hexdigest()


def leaf(row):
    framed = ["-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}" for v in row]
    return H(*framed)


def climb(nodes):
    """Digest of the root, and for each node the pairs of texts left and right of it on its way."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for way, k in zip(ways, range(len(ways))):
            run, i = runs[at[k] // 16], at[k] % 16
            way.append(("".join(run[:i]), "".join(run[i + 1 :])))
        at = [i // 16 for i in at]
        nodes = [H(*run) for run in runs]
    return nodes[0], ways


def expected(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode("utf-8")))
    trees = {}
    for name in names:
        members = sorted(by_source[name], key=lambda m: m[:3])
        trees[name] = (members, *climb([m[2] for m in members]))
    root, tops = climb([trees[name][1] for name in names])
    out = []
    for name, above in zip(names, tops):
        members, subroot, ways = trees[name]
        for (_, _, own, row), way in zip(members, ways):
            path = way + above
            cur = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4]:
                changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                cur = leaf((*row[:4], changed))
            for left, right in path:
                cur = H(left, cur, right)
            proof = H(*[left + right for left, right in path])
            out.append((row[0], own, subroot, root, proof, cur, cur == root))
    return sorted(out, key=repr)


def made(count, seed=7):
    random.seed(seed)
    sources = [None, "", "a", "é", "z", "zz", "\U0001f600"] + [f"s{i}" for i in range(30)]
    rows = []
    for i in range(count):
        source = "a" if random.random() < 0.6 else random.choice(sources)
        text = random.choice([None, "", "Ab C", "plain", f"Text {i} é"])
        rows.append((i, source, random.choice([None, "en"]), random.choice([None, i]), text))
    rows += [(None, "a", None, None, None), (None, "a", "x", 1, "Q"), rows[3], rows[3], rows[4]]
    rows += [(5, "a", "en", 1, "Other"), (5, "a", "en", 1, "another")]
    return rows


@pytest.mark.parametrize("count", [5000, 40, 6])
def test_manifest(spark, count):
    rows = made(count)
    frame = spark.createDataFrame(rows, DOCS).repartition(7)
    assert rows_of(merkle.manifest(frame)) == expected(rows)


@pytest.mark.parametrize("rows", [1, 16, 17, 300])
def test_one_source(spark, rows):
    rows = [(i, None, "en", 1, "A") for i in range(rows)]
    assert rows_of(merkle.manifest(spark.createDataFrame(rows, DOCS))) == expected(rows)


def test_equal_rows_hold_a_third_and_many_sources(spark):
    rows = [(1, "a", "en", 1, "Same")] * 400 + [(i, f"s{i:04}", "en", 1, "x") for i in range(800)]
    frame = spark.createDataFrame(rows, DOCS).repartition(9)
    assert rows_of(merkle.manifest(frame)) == expected(rows)


def test_empty_long_and_clashing_names(spark):
    empty = merkle.manifest(spark.createDataFrame([], DOCS))
    assert empty.columns == [f.split()[0] for f in merkle.RESULT.split(", ")] and not empty.collect()
    names = "leaf root digest tree place n run kids way subroot anc id index spot part all rows".split()
    rows = [(1, "a", "en", 1, "L" * 3_000_000), (2, "b", "en", 1, "x")]
    wide = spark.createDataFrame([r + ("k",) * len(names) for r in rows], DOCS + "".join(f", {n} string" for n in names))
    assert rows_of(merkle.manifest(wide)) == expected(rows)


def test_only_changed_rows_fail(spark):
    rows = made(200)
    frame = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    kept = merkle.manifest(frame, lambda: (F.lit(False), F.col("text")))
    assert all(r["verified"] for r in kept.collect())
    changed = merkle.manifest(frame, lambda: (F.col("doc_id") == 7, F.lit("other")))
    assert [r["doc_id"] for r in changed.where("not verified").collect()] == [7]
