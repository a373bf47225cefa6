"""Document fingerprints: digests of a text's least probable byte windows.

Every window of 64 bytes has an entropy. How many windows of the whole corpus share it
says how probable it is. A window is a feature if it is the rarest, and of equals the
leftmost, of many spans of 64 neighbouring windows. Features go into Bloom filters of
fixed size, and each time one is full a further one is chained to it. Two fingerprints
are as alike as the bits their filters share beyond what chance would let them share.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from verbalance import session
from verbalance.llm.words import mix

WINDOW = 64
# Spans of 64 windows of which a feature has to be the rarest.
SPAN = 64
POPULAR = 16
ENTROPY_STEPS = 1000
FILTER_BITS = 2048
FILTER_BYTES = FILTER_BITS // 8
FILTER_FEATURES = 160
HASHES = 5
HASH_BITS = 11
# Shared bits count beyond so many standard deviations of chance.
DEVIATIONS = 3.0
BYTES_AT_ONCE = 1_000_000
FILTERS_AT_ONCE = 128
BYTES_PER_PARTITION = 128 * 1024 * 1024
_BLOCK = 1 << 16
_PLACE_BITS = 40
_NONE = np.int64(1) << 62
# c * log2(c) as integers, so that a window's sum is the same on whatever way it is reached.
_SCALE = 1 << 20
_TERMS = np.array([round(c * math.log2(c) * _SCALE) if c else 0 for c in range(WINDOW + 1)])
_STEPS = np.diff(_TERMS)
_FULL = int(_TERMS[WINDOW])

FOUND = (
    "part int, kind string, doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double, text string"
)


def entropy_steps(data):
    """The entropy of each window of 64 bytes, in steps of a thousandth of its maximum.

    A window's sum follows from the one before by the counts of the byte that leaves and of
    the byte that enters; these are counted by comparing the bytes with themselves, shifted.
    """
    windows = len(data) - WINDOW + 1
    out = np.empty(max(windows, 0), dtype=np.int16)
    for start in range(0, windows, _BLOCK):
        end = min(start + _BLOCK, windows)
        part = data[start : end + WINDOW - 1]
        before, after = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        for k in range(1, WINDOW):
            same = (part[k:] == part[:-k]).view(np.uint8)
            before[k:] += same
            after[:-k] += same
        sums = np.empty(end - start, dtype=np.int64)
        sums[0] = _TERMS[np.bincount(part[:WINDOW], minlength=256)].sum()
        sums[1:] = _STEPS[before[WINDOW:]] - _STEPS[after[: end - start - 1]]
        out[start:end] = (_FULL - np.cumsum(sums)) * ENTROPY_STEPS // _FULL
    return out


def laid_out(texts):
    """The bytes of all texts, each filled up to one window, with their starts and ends."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    encoded = [e.ljust(WINDOW, b"\0") if e else e for e in encoded]
    ends = np.cumsum([len(e) for e in encoded], dtype=np.int64)
    return np.frombuffer(b"".join(encoded), dtype=np.uint8), np.concatenate(([0], ends))


def _inside(bounds, windows):
    """Which windows lie within one text."""
    inside = np.zeros(windows + 1, dtype=np.int32)
    starts, ends = bounds[:-1], bounds[1:]
    filled = ends > starts
    np.add.at(inside, starts[filled], 1)
    np.add.at(inside, ends[filled] - WINDOW + 1, -1)
    return np.cumsum(inside[:-1]) > 0


def _popular(ranks):
    """Places that are the least, and of equals the first, of at least ``POPULAR`` spans.

    ``ranks`` is negative where no window of a single text starts.
    """
    places, counts = [], []
    for start in range(1 - SPAN, len(ranks), BYTES_AT_ONCE):
        # Spans that start before the first window or end after the last hold fewer of them.
        low, high = max(start, 0), min(start + BYTES_AT_ONCE + SPAN - 1, len(ranks))
        least = np.full(BYTES_AT_ONCE + SPAN - 1 if high < len(ranks) else high - start + SPAN - 1, _NONE)
        own = ranks[low:high].astype(np.int64)
        keys = (own << _PLACE_BITS) | np.arange(low, high)
        least[low - start : high - start] = np.where(own < 0, _NONE, keys)
        width = 1
        while width < SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = least[:BYTES_AT_ONCE]
        won = least[least < _NONE] & ((np.int64(1) << _PLACE_BITS) - 1)
        if len(won):
            first = np.flatnonzero(np.concatenate(([True], won[1:] != won[:-1])))
            places.append(won[first])
            counts.append(np.diff(np.append(first, len(won))))
    if not places:
        return np.zeros(0, dtype=np.int64)
    places, counts = np.concatenate(places), np.concatenate(counts)
    # A place at the end of one block may go on in the next.
    first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
    return places[first][np.add.reduceat(counts, first) >= POPULAR]


def _hashed(data, places):
    """A 64-bit hash of each window."""
    out = np.empty(len(places), dtype=np.uint64)
    for start in range(0, len(places), _BLOCK):
        some = places[start : start + _BLOCK]
        words = data[some[:, None] + np.arange(WINDOW)].view("<u8")
        h = np.full(len(some), 0x9E3779B97F4A7C15, dtype=np.uint64)
        for column in range(words.shape[1]):
            h = mix(h ^ words[:, column])
        out[start : start + _BLOCK] = h
    return out


def digests(texts, ranks):
    """The fingerprint of each text: its number of features, four bytes, and its filters."""
    data, bounds = laid_out(texts)
    if not len(data):
        return [b""] * len(texts)
    steps = entropy_steps(data)
    own = ranks.astype(np.int16)[steps]
    own[~_inside(bounds, len(steps))] = -1
    places = _popular(own)
    hashes = _hashed(data, places)
    owner = np.searchsorted(bounds, places, side="right") - 1
    # A passage that repeats within a text counts once, where it stands first.
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    chosen = np.sort(order[fresh])
    hashes, owner = hashes[chosen], owner[chosen]
    features = np.bincount(owner, minlength=len(texts))
    first_feature = np.concatenate(([0], np.cumsum(features)))
    chain = -(-features // FILTER_FEATURES)
    first_filter = np.concatenate(([0], np.cumsum(chain)))
    filters = first_filter[owner] + (np.arange(len(owner)) - first_feature[owner]) // FILTER_FEATURES
    packed = []
    for start in range(0, first_filter[-1], FILTERS_AT_ONCE):
        low, high = np.searchsorted(filters, (start, start + FILTERS_AT_ONCE))
        bits = np.zeros((FILTERS_AT_ONCE, FILTER_BITS), dtype=bool)
        for i in range(HASHES):
            bit = (hashes[low:high] >> np.uint64(i * HASH_BITS)) & np.uint64(FILTER_BITS - 1)
            bits[filters[low:high] - start, bit.astype(np.int64)] = True
        packed.append(np.packbits(bits, axis=1).tobytes())
    packed = b"".join(packed)
    return [
        int(n).to_bytes(4, "little") + packed[a * FILTER_BYTES : b * FILTER_BYTES] if n else b""
        for n, a, b in zip(features, first_filter[:-1], first_filter[1:])
    ]


def _filters(digest):
    """Bits of each filter, and how many features it holds."""
    packed = np.frombuffer(digest[4:], dtype=np.uint8).reshape(-1, FILTER_BYTES)
    held = np.full(len(packed), FILTER_FEATURES)
    held[-1] = int.from_bytes(digest[:4], "little") - FILTER_FEATURES * (len(packed) - 1)
    return packed, held


def _scores(shared, set_a, set_b):
    """Shared bits between what chance gives (0) and all bits of the emptier filter (1)."""
    chance = set_a * set_b / FILTER_BITS
    spread = np.sqrt(chance * (1 - set_a / FILTER_BITS) * (1 - set_b / FILTER_BITS))
    score = (shared - chance) / (np.minimum(set_a, set_b) - chance)
    return np.where(shared > chance + DEVIATIONS * spread, np.clip(score, 0.0, 1.0), 0.0)


def _overlaps(left, right):
    """For each filter of either side the best normalised overlap with one of the other side."""
    best_left, best_right = np.zeros(len(left)), np.zeros(len(right))
    left, right = left.view(np.uint64), right.view(np.uint64)
    set_left = np.bitwise_count(left).sum(axis=1, dtype=np.int64)
    set_right = np.bitwise_count(right).sum(axis=1, dtype=np.int64)
    for i in range(0, len(left), FILTERS_AT_ONCE):
        some, set_a = left[i : i + FILTERS_AT_ONCE], set_left[i : i + FILTERS_AT_ONCE, None]
        for j in range(0, len(right), FILTERS_AT_ONCE):
            others, set_b = right[j : j + FILTERS_AT_ONCE], set_right[None, j : j + FILTERS_AT_ONCE]
            common = np.bitwise_count(some[:, None, :] & others[None, :, :])
            shared = common.sum(axis=2, dtype=np.int64)
            score = _scores(shared, set_a, set_b)
            best_left[i : i + len(some)] = np.maximum(
                best_left[i : i + len(some)], score.max(axis=1)
            )
            best_right[j : j + len(others)] = np.maximum(
                best_right[j : j + len(others)], score.max(axis=0)
            )
    return best_left, best_right


def likeness(one, other):
    """How alike two fingerprints are, 0 to 1; 1 for equal ones, 0 if only one has features.

    The mean over the filters of the shorter chain, by their features, or of both chains
    if they are of equal length. All pairs of filters are compared: a filter stands for some
    6 KB, so a text of 100 MB has about 16,000 of them and takes about half a minute.
    """
    return likenesses([one], [other])[0]


def likenesses(ones, others):
    """``likeness`` of many pairs; chains of a single filter, the most usual, are compared together."""
    out = [1.0 if one == other else 0.0 for one, other in zip(ones, others)]
    open_pairs = [
        i for i, (one, other) in enumerate(zip(ones, others)) if one and other and one != other
    ]
    single = [i for i in open_pairs if len(ones[i]) == len(others[i]) == 4 + FILTER_BYTES]
    if single:
        left, right = (
            np.frombuffer(b"".join(side[i][4:] for i in single), dtype=np.uint64).reshape(
                -1, FILTER_BYTES // 8
            )
            for side in (ones, others)
        )
        bits = [np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (left & right, left, right)]
        for i, score in zip(single, _scores(*bits).tolist()):
            out[i] = score
    for i in set(open_pairs).difference(single):
        (left, held_left), (right, held_right) = _filters(ones[i]), _filters(others[i])
        best_left, best_right = _overlaps(left, right)
        scores = []
        if len(left) <= len(right):
            scores.append(float(np.average(best_left, weights=held_left)))
        if len(right) <= len(left):
            scores.append(float(np.average(best_right, weights=held_right)))
        out[i] = sum(scores) / len(scores)
    return out


def edited(text, following):
    """``text`` with its last half replaced by the start of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _groups(batches):
    """Rows ``(doc_id, text)`` in order, some megabyte at a time."""
    rows, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            rows.append((doc_id.as_py(), text.as_py() or ""))
            size += len(rows[-1][1])
            if size >= BYTES_AT_ONCE:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def entropy_counts(docs):
    """How many windows of all texts have each entropy: ``step, windows``, 1001 rows at most.

    Besides, in a row without ``step``, the bytes of all texts.
    """

    def run(batches):
        counts, total = np.zeros(ENTROPY_STEPS + 1, dtype=np.int64), 0
        for rows in _groups(batches):
            data, bounds = laid_out([text for _, text in rows])
            total += len(data)
            if len(data):
                steps = entropy_steps(data)
                counts += np.bincount(
                    steps[_inside(bounds, len(steps))], minlength=ENTROPY_STEPS + 1
                )
        used = np.flatnonzero(counts).tolist()
        yield pa.RecordBatch.from_pydict(
            {
                "step": pa.array([*used, None], pa.int32()),
                "windows": pa.array([*counts[used].tolist(), total], pa.int64()),
            }
        )

    texts = docs.select(F.lit(0).cast("bigint").alias("doc_id"), "text")
    return (
        texts.mapInArrow(run, "step int, windows bigint")
        .groupBy("step")
        .agg(F.sum("windows").alias("windows"))
    )


def ranks_of(counts):
    """The place of each entropy by how many windows have it, the rarest first."""
    windows = np.zeros(ENTROPY_STEPS + 1, dtype=np.int64)
    for step, number in counts:
        windows[step] = number
    ranks = np.empty(ENTROPY_STEPS + 1, dtype=np.int64)
    ranks[np.lexsort((np.arange(ENTROPY_STEPS + 1), windows))] = np.arange(ENTROPY_STEPS + 1)
    return ranks


def _finished(part, rows, ranks):
    """Result rows for ``(doc_id, text, own, next_text, next_own)``."""
    others = [edited(text, following) for _, text, _, following, _ in rows]
    prints = digests(others, ranks)
    near_edited = likenesses([r[2] for r in rows], prints)
    near_next = likenesses([r[2] for r in rows], [r[4] for r in rows])
    return [
        (part, "done", doc_id, len(text), _sha(other), own, changed, *near, None)
        for (doc_id, text, own, _, _), other, changed, *near in zip(
            rows, others, prints, near_edited, near_next
        )
    ]


def _sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _batch(rows):
    names = [field.split()[0] for field in FOUND.split(", ")]
    types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
    types += [pa.float64(), pa.float64(), pa.string()]
    arrays = [pa.array(values, t) for values, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _in_order(ranks):
    """Fingerprints the rows of a sorted partition; its first and last text go on to the next pass."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last = None
        for rows in _groups(batches):
            owns = digests([text for _, text in rows], ranks)
            known = [(doc_id, text, own) for (doc_id, text), own in zip(rows, owns)]
            found = []
            if last is None:
                doc_id, text, own = known[0]
                found.append((part, "head", doc_id, None, None, own, None, None, None, text))
            else:
                known.insert(0, last)
            pairs = [(*row, *following[1:]) for row, following in zip(known, known[1:])]
            found += _finished(part, pairs, ranks)
            last = known[-1]
            if found:
                yield _batch(found)
        if last is not None:
            doc_id, text, own = last
            yield _batch([(part, "tail", doc_id, None, None, own, None, None, None, text)])

    return run


def _across(ranks):
    """Fingerprints the last rows of partitions, each given with the first row of the next one."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                names = ("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
                yield _batch(_finished(row["part"], [tuple(row[n] for n in names)], ranks))

    return run


def _base64(name):
    """Base64 without the line ends that Spark puts after 76 characters."""
    return F.translate(F.base64(name), "\r\n", "").alias(name)


def fingerprints(docs, counts=None):
    """The fingerprint of each text and of its edited text, and what they are alike to.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. The edited text
    has the first half of the text, then as much of the next document's start as the second
    half was long. Documents follow each other by id, null first; rows of one id by a hash of
    their text, and equal rows in any order, which gives the same rows. After the last comes
    the first, so a lone row follows itself.

    Null text counts as empty. An empty text has no features and an empty fingerprint, which
    is alike 1 to another empty one and 0 to any other. A text of less than 64 bytes is filled
    up with zero bytes to one window. Of equal windows of a text the first counts. Texts are
    never cut; equal texts have equal fingerprints. An empty table gives no rows.

    ``counts`` are rows ``step, windows`` of another corpus (``entropy_counts``), whose
    fingerprints are to be compared with these; by default those of ``docs`` are used.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``; a fingerprint is its number of features (four bytes, little-endian) and its
    filters of 256 bytes, in base64.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    # 1002 rows at most.
    own_counts = [tuple(row) for row in entropy_counts(plain).collect()]
    size = sum(n for step, n in own_counts if step is None)
    ranks = ranks_of([tuple(r) for r in counts] if counts else [c for c in own_counts if c[0] is not None])

    order = ["doc_id", F.xxhash64("text"), "row"]
    needed = math.ceil(size / BYTES_PER_PARTITION)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        order.insert(0, needed)
    ordered = (
        plain.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "row")
        .select("doc_id", "text")
    )
    path = session.scratch_path(spark, "fingerprints")
    ordered.mapInArrow(_in_order(ranks), FOUND).write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(FOUND).parquet(path)

    # As many heads and tails as partitions with rows, at most.
    heads = found.where("kind = 'head'")
    by_part = Window.orderBy("part")
    followers = heads.select("part").select(
        "part",
        F.coalesce(F.lead("part").over(by_part), F.first("part").over(by_part)).alias("next_part"),
    )
    following = heads.select(
        F.col("part").alias("next_part"),
        F.col("text").alias("next_text"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    ends = (
        found.where("kind = 'tail'")
        .select("part", "doc_id", "text", "fingerprint")
        .join(followers, "part")
        .join(following, "next_part")
    )
    return (
        found.where("kind = 'done'")
        .unionByName(ends.mapInArrow(_across(ranks), FOUND))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            _base64("fingerprint"),
            _base64("edited_fingerprint"),
            "near_edited",
            "near_next",
        )
    )
