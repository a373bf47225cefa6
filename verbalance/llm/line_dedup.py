"""Line dedup: hashed lines in range partitions, sorted by document and position, streamed once.

Lines travel as two 64-bit hashes with their place; texts stay where they are. What
comes back for a document is a compressed bitmap of the lines that stay.
"""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from verbalance import session
from verbalance.llm.blocks import run_starts
from verbalance.llm.words import slabs, text_sizes

BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_LENGTH = 40
LEAST_DOCUMENTS = 5
# Stands for a null document id, which is one document and the smallest.
NO_ID = -(2**63)
CHARS_AT_ONCE = 4_000_000

DROP, OPEN, KNOWN = 0, 1, 2
_PLACES = "h1 bigint, h2 bigint, doc bigint, text_key bigint, line int, state int"
_NAMES = ["h1", "h2", "doc", "text_key", "line"]


def line_key(line):
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def _text(text):
    return F.coalesce(text, F.lit(""))


def _ids(docs):
    text = _text(F.col("text"))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
    )


def hashed_lines(docs, least_length=LEAST_LENGTH):
    """``h1, h2, doc, text_key, line`` for each line whose key is long enough."""
    lines = _ids(docs).select(
        "doc", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("line", "words")
    )
    key = line_key(F.col("words")).alias("key")
    return (
        lines.select("doc", "text_key", "line", key)
        .where(F.char_length("key") >= least_length)
        .select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(71), "key").alias("h2"),
            "doc",
            "text_key",
            "line",
        )
    )


def _first_occurrences(least_documents):
    """Streams a sorted partition; a run of one key starts with its largest document.

    Runs that lie inside the partition are settled here: the first document stays
    and, if enough documents follow, all later lines are dropped. The first and the last
    run may go on in a neighbouring partition, so their lines are passed on as open.
    """

    def emit(columns, state):
        arrays = [pa.array(c) for c in columns] + [pa.array(state.astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=[*_NAMES, "state"])

    def run(batches):
        held = None  # lines of the last run, as long as it has too few documents
        first_run = None  # key of the partition's first run
        settled = None  # key and first document of a last run with enough documents
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(batch.schema.get_field_index(n)).to_numpy() for n in _NAMES]
            if first_run is None:
                first_run = (now[0][0], now[1][0])
            columns = now if held is None else [np.concatenate(p) for p in zip(held, now)]
            held = None
            h1, h2, doc = columns[:3]
            starts = run_starts(h1, h2)
            lengths = np.diff(starts)
            run_of = np.repeat(np.arange(len(lengths)), lengths)
            new_doc = np.append(True, (doc[1:] != doc[:-1]) | (run_of[1:] != run_of[:-1]))
            documents = np.add.reduceat(new_doc, starts[:-1])
            largest = doc[starts[:-1]].copy()
            enough = documents >= least_documents
            at_first = (h1[starts[:-1]] == first_run[0]) & (h2[starts[:-1]] == first_run[1])
            if settled is not None and (h1[0], h2[0]) == settled[0]:
                largest[0], enough[0] = settled[1], True
            later = doc != largest[run_of]
            state = np.full(len(doc), -1)
            state[enough[run_of] & later] = DROP
            last = len(lengths) - 1
            tail = run_of == last
            if at_first[last]:
                settled = None
            elif enough[last]:
                # The lines that stay so far are passed on, for a run that goes on elsewhere.
                state[tail & ~later] = KNOWN
                settled = ((h1[-1], h2[-1]), largest[last])
            else:
                settled = None
                held = [c[tail] for c in columns]
                state[tail] = -1
            state[at_first[run_of]] = OPEN
            told = state >= 0
            if told.any():
                yield emit([c[told] for c in columns], state[told])
        if held is not None:
            yield emit(held, np.full(len(held[0]), OPEN))

    return run


def dropped_lines(docs, least_length=LEAST_LENGTH, least_documents=LEAST_DOCUMENTS):
    """``doc, text_key, line`` of the lines that go."""
    spark = docs.sparkSession
    order = ["h1", "h2", F.desc("doc"), "text_key", "line"]
    # The document is part of the range, so one common line fills many partitions.
    ranged = hashed_lines(docs, least_length).repartitionByRange(*order)
    streamed = ranged.sortWithinPartitions(*order).mapInArrow(
        _first_occurrences(least_documents), _PLACES
    )
    streamed = session.written(streamed, session.scratch_path(spark, "lines"))
    open_lines = streamed.where(F.col("state") != DROP)
    # At most two keys per partition are open, so this table has at most that many rows.
    totals = open_lines.groupBy("h1", "h2").agg(
        F.count_distinct("doc").alias("documents"),
        F.max("doc").alias("largest"),
        F.max("state").alias("known"),
    )
    frequent = totals.where((F.col("documents") >= least_documents) | (F.col("known") == KNOWN))
    gone = open_lines.join(F.broadcast(frequent), ["h1", "h2"]).where("doc <> largest")
    place = ["doc", "text_key", "line"]
    return streamed.where(F.col("state") == DROP).select(*place).union(gone.select(*place))


def _bitmap(lines: pd.Series) -> pd.Series:
    """Bit i is set if line i stays; lines beyond the end stay too."""

    def packed(places):
        bits = np.ones(8 * (int(max(places)) // 8 + 1), dtype=np.uint8)
        bits[np.asarray(places)] = 0
        return zlib.compress(np.packbits(bits).tobytes())

    return lines.map(packed)


def keep_bitmaps(docs, **limits):
    """``doc, text_key, keep``: a compressed bitmap for each document that loses lines.

    ``doc`` is the document's id (``NO_ID`` for null) and ``text_key`` a hash of its
    text, for ids that occur with several texts.
    """
    gone = dropped_lines(docs, **limits).groupBy("doc", "text_key")
    bitmap = F.pandas_udf(_bitmap, "binary")
    return gone.agg(F.collect_set("line").alias("lines")).select(
        "doc", "text_key", bitmap("lines").alias("keep")
    )


def _kept(text, keep):
    lines = text.split("\n")
    if keep is None:
        return lines, 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8))
    gone = set(np.flatnonzero(bits[: len(lines)] == 0).tolist())
    return [line for i, line in enumerate(lines) if i not in gone], len(gone)


def _applied(with_text):
    def run(batches):
        names = ["doc_id", "n_lines", "n_dropped", "kept_sha256", "keep", *["text"] * with_text]
        for whole in batches:
            for start, end in slabs(text_sizes(whole.column("text")), CHARS_AT_ONCE):
                batch = whole.slice(start, end - start).to_pydict()
                kept = [_kept(t, k) for t, k in zip(batch["text"], batch["keep"])]
                texts = ["\n".join(lines) for lines, _ in kept]
                digests = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts]
                arrays = [
                    pa.array(batch["doc_id"], pa.int64()),
                    pa.array([len(lines) + gone for lines, gone in kept], pa.int64()),
                    pa.array([gone for _, gone in kept], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(batch["keep"], pa.binary()),
                    *([pa.array(texts, pa.string())] if with_text else []),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def dedup_lines(docs, with_text=False, **limits):
    """Documents without the lines that many documents share.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. Keys
    are lines stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. A key
    of at least ``least_length`` code points in at least ``least_documents``
    documents stays only in the largest ``doc_id`` that holds it, there with all its
    lines. Null or empty text is one empty line. Null ids are one document, the
    smallest; rows that repeat an id are one document and each gets a row.

    Returns ``doc_id, n_lines, n_dropped, kept_sha256, keep`` (null if all stay) and,
    ``with_text``, the text that is left.
    """
    bitmaps = keep_bitmaps(docs, **limits)
    joined = _ids(docs).join(bitmaps, ["doc", "text_key"], "left")
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
    schema = "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string, keep binary"
    schema += ", text string" if with_text else ""
    return joined.select(doc_id, "text", "keep").mapInArrow(_applied(with_text), schema)
