"""Fingerprints against a plain version, window by window and bit by bit."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.conftest import rows_of
from verbalance.llm import fingerprint as fp

DOCS = "doc_id bigint, text string"


def padded(text):
    data = text.encode("utf-8")
    return data.ljust(64, b"\0") if data else b""


def steps(data):
    """The entropy of each window in thousandths of six bits, from the counts of its bytes."""
    out = []
    for i in range(len(data) - 63):
        terms = sum(round(c * math.log2(c) * 2**20) for c in Counter(data[i : i + 64]).values())
        full = 64 * 6 * 2**20
        out.append((full - terms) * 1000 // full)
    return out


def ranking(texts):
    counts = Counter(s for t in texts for s in steps(padded(t)))
    return {s: i for i, s in enumerate(sorted(range(1001), key=lambda s: (counts[s], s)))}


def features(text, rank):
    """Windows that are the leftmost rarest of at least 16 of the spans that hold them."""
    data = padded(text)
    ranks = [rank[s] for s in steps(data)]
    won = Counter()
    for start in range(-63, len(ranks)):
        span = range(max(start, 0), min(start + 64, len(ranks)))
        if span:
            won[min(span, key=lambda i: (ranks[i], i))] += 1
    windows = [data[i : i + 64] for i in sorted(won) if won[i] >= 16]
    return list(dict.fromkeys(windows))


def digest(text, rank):
    found = features(text, rank)
    if not found:
        return b""
    out = len(found).to_bytes(4, "little")
    for start in range(0, len(found), 160):
        bits = [0] * 2048
        for window in found[start : start + 160]:
            h = int(fp._hashed(np.frombuffer(window, np.uint8), np.array([0]))[0])
            for i in range(5):
                bits[h >> (11 * i) & 2047] = 1
        out += bytes(int("".join(map(str, bits[k : k + 8])), 2) for k in range(0, 2048, 8))
    return out


def likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0

    def filters(d):
        packed = [int.from_bytes(d[i : i + 256]) for i in range(4, len(d), 256)]
        n = int.from_bytes(d[:4], "little")
        return [(f, min(160, n - 160 * i)) for i, f in enumerate(packed)]

    def score(x, y):
        p, q, both = x.bit_count(), y.bit_count(), (x & y).bit_count()
        chance = p * q / 2048
        if both <= chance + 3 * math.sqrt(chance * (1 - p / 2048) * (1 - q / 2048)):
            return 0.0
        return min(1.0, (both - chance) / (min(p, q) - chance))

    def mean(xs, ys):
        return sum(n * max(score(x, y) for y, _ in ys) for x, n in xs) / sum(n for _, n in xs)

    x, y = filters(a), filters(b)
    if len(x) != len(y):
        return mean(*sorted((x, y), key=len))
    return (mean(x, y) + mean(y, x)) / 2


def expected(rows):
    """Rows with distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    rank = ranking([t for _, t in rows])
    own = [digest(t, rank) for _, t in rows]
    out = []
    for k, (i, text) in enumerate(rows):
        n = (k + 1) % len(rows)
        half = len(text) // 2
        other = text[: len(text) - half] + rows[n][1][:half]
        changed = digest(other, rank)
        sha = hashlib.sha256(other.encode()).hexdigest()
        near = likeness(own[k], changed), likeness(own[k], own[n])
        texts = [base64.b64encode(d).decode() for d in (own[k], changed)]
        out.append((i, len(text), sha, *texts, *(round(v, 6) for v in near)))
    return sorted(out, key=repr)


def result(frame):
    return sorted(
        ((*r[:5], round(r[5], 6), round(r[6], 6)) for r in rows_of(fp.fingerprints(frame))), key=repr
    )


def words(n, seed):
    random.seed(seed)
    return " ".join("".join(random.choices("etaoinshrdlu é", k=random.randint(1, 9))) for _ in range(n))


ROWS = [
    (None, "no id " * 30),
    (1, None),
    (2, ""),
    (3, "x"),
    (4, "y" * 63),
    (5, "z" * 64),
    (6, "a" * 500),
    (9, words(60, 1)),
    (12, words(2000, 2)),
    (13, words(2000, 2)),
    (14, words(2000, 2)[:9000] + words(300, 3)),
    (20, (words(40, 4) + "\n") * 30),
    (21, "中文 " * 50),
    (40, words(3, 9)),
]


def test_fingerprints(spark):
    frame = spark.createDataFrame(ROWS, DOCS).repartition(5)
    assert result(frame) == expected(ROWS)


def test_fingerprints_over_blocks_and_partitions(spark, monkeypatch):
    """Groups, blocks of places and blocks of bytes that end within texts."""
    rows = [(i * 3, words(random.Random(i).randint(0, 80), i)) for i in range(60)]
    plain = expected(rows)
    assert result(spark.createDataFrame(rows, DOCS).repartition(6)) == plain
    texts = [t for _, t in rows]
    rank = ranking(texts)
    table = np.array([rank[s] for s in range(1001)])
    monkeypatch.setattr(fp, "_BLOCK", 37)
    monkeypatch.setattr(fp, "BYTES_AT_ONCE", 101)
    monkeypatch.setattr(fp, "FILTERS_AT_ONCE", 2)
    assert fp.digests(texts, table) == [digest(t, rank) for t in texts]
    a, b = fp.digests([words(3000, 5), words(3000, 5)[5000:]], table)
    assert abs(fp.likeness(a, b) - likeness(a, b)) < 1e-6 and fp.likeness(a, b) > 0.5


def test_likeness_tells_edits_from_other_texts(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = fp.fingerprints(frame).where("n_chars > 1000").collect()
    assert sum(r["near_edited"] > 0.25 for r in rows) > 0.9 * len(rows)
    assert sum(r["near_next"] < 0.15 for r in rows) > 0.9 * len(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)


@pytest.mark.parametrize("rows", [[(7, "only one")], [(7, "same"), (7, "same"), (7, "same")]])
def test_one_row_and_repeated_rows(spark, rows):
    found = fp.fingerprints(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows) and {r["near_next"] for r in found} == {1.0}


def test_ties_are_ordered_by_content(spark):
    rows = [(1, words(30, i)) for i in range(12)]
    one = rows_of(fp.fingerprints(spark.createDataFrame(rows, DOCS)))
    other = rows_of(fp.fingerprints(spark.createDataFrame(rows[::-1], DOCS).repartition(5)))
    assert one == other


def test_empty_long_and_clashing_names(spark):
    assert fp.fingerprints(spark.createDataFrame([], DOCS)).collect() == []
    names = "row part kind step windows fingerprint near_next n_chars next_text next_part".split()
    wide = DOCS + "".join(f", {n} string" for n in names)
    rows = [(1, words(200_000, 6)), (2, "short"), (3, "b" * 3_000_000)]
    frame = spark.createDataFrame([r + ("k",) * len(names) for r in rows], wide)
    found = {r["doc_id"]: r for r in fp.fingerprints(frame).collect()}
    assert sorted(found) == [1, 2, 3] and found[1]["near_edited"] > 0.3
    long = rows[0][1]
    changed = long[: len(long) - len(long) // 2] + "short"
    assert found[1]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()


def test_counts_of_another_corpus(spark):
    frame = spark.createDataFrame(ROWS, DOCS)
    other = spark.createDataFrame([(1, words(500, 8))], DOCS)
    counts = fp.entropy_counts(other).where("step is not null").collect()
    rank = ranking([words(500, 8)])
    found = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(frame, counts).collect()}
    assert found[9] == base64.b64encode(digest(words(60, 1), rank)).decode()
