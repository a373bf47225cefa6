"""How the tokens of two tokenizers lie over each other, by sparse incidence matrices.

A tokenizer's tokens and the bytes of the text they cover make an incidence matrix, kept in
compressed rows. The product of one by the transpose of the other has an entry for each pair
of tokens that share bytes; the product of the incidences of tokens and groups has one for
each pair in the same group. Both are computed row by row as Gustavson does it.

A text is the sequence of its segments, which end before a lone blank: no token of either
side goes over such an end, so both matrices of a text have a block on their diagonal for each
segment. A block of documents multiplies the matrices of its distinct segments once.

Pairs are counted corpus-wide by blocks of documents: a block sends each of its distinct
pairs once, and gets each back once with its count.
"""

import hashlib
import itertools
import json
import re
import zlib
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from verbalance import session
from verbalance.llm.bpe import PATTERN, byte_letters
from verbalance.llm.words import slabs, text_sizes

# Text tokenized at once, text of one block of documents, and entries of one product.
SLAB_BYTES = 500_000
BLOCK_CHARS = 3_000_000
ENTRIES_AT_ONCE = 1_000_000
# Segments of so many characters are merged by the faster library.
SHORT = 1_000
# Texts are cut into segments some characters at a time.
PIECE_CHARS = 200_000
# A lone blank between characters that are neither white space nor its mark ends a segment.
_BETWEEN = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
_BLANK_MARK = "▁"
_B_BITS = 32

BLOCK = (
    "block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, "
    "n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, "
    "pair array<bigint>, total array<bigint>, pairs_of_segment binary, which binary, "
    "times binary, segments_of_doc array<bigint>, segment binary, occurrences binary"
)
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)
LINK = (
    "doc_id bigint, a_place bigint, b_place bigint, a_id bigint, b_id bigint, weight bigint"
)


class Rows(NamedTuple):
    """A sparse matrix in compressed rows: row i has ``columns[starts[i]:starts[i + 1]]``, ascending."""

    starts: np.ndarray
    columns: np.ndarray
    width: int


def incidence(lengths, width):
    """Rows that cover ``lengths`` consecutive columns each, one after the other."""
    starts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    return Rows(starts, np.arange(starts[-1]), width)


def membership(columns, width):
    """Rows with one column each."""
    return Rows(np.arange(len(columns) + 1), columns, width)


def transposed(matrix):
    order = np.argsort(matrix.columns, kind="stable")
    rows = np.repeat(np.arange(len(matrix.starts) - 1), np.diff(matrix.starts))
    filled = np.bincount(matrix.columns, minlength=matrix.width)
    starts = np.concatenate(([0], np.cumsum(filled, dtype=np.int64)))
    return Rows(starts, rows[order], len(matrix.starts) - 1)


def _row_slabs(left, right):
    """Runs of rows of ``left`` whose product takes about ``ENTRIES_AT_ONCE`` entries to sum."""
    sizes = np.diff(right.starts)[left.columns]
    upto = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))[left.starts]
    first, last = 0, len(left.starts) - 1
    while first < last:
        end = int(np.searchsorted(upto, upto[first] + ENTRIES_AT_ONCE, side="right")) - 1
        end = min(max(end, first + 1), last)
        yield first, end
        first = end


def product(left, right):
    """Entries ``row, column, value`` of ``left @ right``, some rows at a time.

    Row i is the sum of those rows of ``right`` that are columns of row i of ``left``. The
    rows are laid out one after the other, and equal columns of a row are added up.
    """
    for first, end in _row_slabs(left, right):
        used = left.columns[left.starts[first] : left.starts[end]]
        row = np.repeat(np.arange(first, end), np.diff(left.starts[first : end + 1]))
        lengths = right.starts[used + 1] - right.starts[used]
        skipped = right.starts[used] - (np.cumsum(lengths) - lengths)
        entries = np.repeat(skipped, lengths) + np.arange(lengths.sum())
        keys = np.repeat(row, lengths) * right.width + right.columns[entries]
        if len(keys) == 0:
            continue
        if np.any(keys[1:] < keys[:-1]):
            keys.sort()
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        yield keys[new] // right.width, keys[new] % right.width, np.diff(np.append(new, len(keys)))


class Tokenizers:
    """Both tokenizers and what their tokens stand for; lives in a task."""

    def __init__(self, a_json, b_model, by_ids=False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = (
                bytes(byte_of[c] for c in token) if set(token) <= byte_of.keys() else token.encode()
            )
        added = {t["content"] for t in json.loads(a_json).get("added_tokens", [])}
        self.by_ids = None
        if by_ids:
            import tiktoken

            ids = {self.a_bytes[i]: i for t, i in self.a.get_vocab().items() if t not in added}
            self.by_ids = tiktoken.Encoding(
                "own", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={}
            )
        self.b = b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(_BLANK_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # A text may be cut before a blank if no piece goes on with one.
        self.can_cut = not any(_BLANK_MARK in p.lstrip(_BLANK_MARK) for p in pieces)
        self.a_lengths = np.array([len(t) for t in self.a_bytes])
        self.b_lengths = np.array([len(t) for t in self.b_bytes])
        # How ids are written: within and at the end of a group's side.
        self.written = [f"{i}{end}".encode() for i in range(len(self.a_bytes)) for end in ",|"]
        self.b_written = len(self.written)
        self.written += [f"{i}{end}".encode() for i in range(len(pieces)) for end in ",;"]

    def pieces(self, text):
        """The text in pieces that end where a segment does; without the blanks between."""
        if len(text) <= PIECE_CHARS or not self.can_cut:
            return [text]
        pieces, start = [], 0
        while len(text) - start > PIECE_CHARS:
            cut = _BETWEEN.search(text, start + PIECE_CHARS)
            if cut is None:
                break
            pieces.append(text[start : cut.start()])
            start = cut.end()
        return [*pieces, text[start:]]

    def segments(self, text):
        """The segments of a piece, without the blanks between them."""
        return _BETWEEN.split(text) if self.can_cut else [text]

    def encode(self, texts):
        """The ids of each text by either tokenizer; none where they do not spell the text."""
        spaced = [" " + t for t in texts]
        if self.by_ids is None:
            a = [e.ids for e in self.a.encode_batch(spaced, add_special_tokens=False)]
        else:
            encode = self.by_ids.encode_ordinary
            a = [encode(t) if len(t) <= SHORT else self._long(t) for t in spaced]
        b = self.b.encode(texts, num_threads=1) if texts else []
        a_ends, a_spelled = _spelled(self.a_bytes, a)
        b_ends, b_spelled = _spelled(self.b_bytes, b)
        encoded = [t.encode("utf-8", "surrogatepass") for t in spaced]
        ends, whole = np.cumsum([len(e) for e in encoded]), b"".join(encoded)
        if (
            all(texts)
            and whole == a_spelled == b_spelled
            and np.array_equal(ends, a_ends)
            and np.array_equal(ends, b_ends)
        ):
            return a, b
        for i, text in enumerate(encoded):
            sides = b"".join([self.a_bytes[t] for t in a[i]]), b"".join([self.b_bytes[t] for t in b[i]])
            if not texts[i] or sides != (text, text):
                a[i], b[i] = [], []
        return a, b

    def _long(self, text):
        return self.a.encode(text, add_special_tokens=False).ids


def merges_by_id(a_json):
    """Whether merging the pair whose token has the lowest id gives the tokens of the ranked merges.

    It does if merges make ascending ids and every token is what its own bytes are merged to: as long as no
    merge goes over the ends of a token's bytes, what happens between them is what happens to the
    token alone, and its last step is the ranked pair. Only then is the faster library used.
    """
    from tokenizers import Tokenizer

    spec = json.loads(a_json)
    ids, before = spec["model"]["vocab"], spec.get("pre_tokenizer") or {}
    added = {t["content"] for t in spec.get("added_tokens", [])}
    if spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        return False
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [ids[left + right] for left, right in pairs]
    single = [i for t, i in ids.items() if len(t) == 1]
    if any(x >= y for x, y in zip(made, made[1:])) or (made and max(single) > made[0]):
        return False
    merge = Tokenizer.from_str(a_json).model.tokenize
    return all(len(merge(t)) == 1 for t in ids if t not in added)


def _spelled(spelling, ids):
    """Where each text ends in the bytes of all tokens, and these bytes."""
    flat = list(itertools.chain.from_iterable(ids))
    parts = list(map(spelling.__getitem__, flat))
    upto = np.concatenate(([0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))))
    return upto[np.cumsum([len(own) for own in ids], dtype=np.int64)], b"".join(parts)


class Aligned:
    """The tokens of some texts, one text after the other, and the groups they are cut into."""

    def __init__(self, tokenizers, texts):
        a, b = tokenizers.encode(texts)
        self.tokenizers = tokenizers
        self.n_a = np.array([len(own) for own in a], dtype=np.int64)
        self.n_b = np.array([len(own) for own in b], dtype=np.int64)
        self.a_ids = np.array(list(itertools.chain.from_iterable(a)), dtype=np.int64)
        self.b_ids = np.array(list(itertools.chain.from_iterable(b)), dtype=np.int64)
        a_lengths = tokenizers.a_lengths[self.a_ids]
        b_lengths = tokenizers.b_lengths[self.b_ids]
        size = int(a_lengths.sum())
        self.a_rows, self.b_rows = incidence(a_lengths, size), incidence(b_lengths, size)
        a_ends, b_ends = self.a_rows.starts[1:], self.b_rows.starts[1:]
        # Both ascend, and both end with the last byte.
        cuts = a_ends[b_ends[np.searchsorted(b_ends, a_ends)] == a_ends]
        self.a_group = np.searchsorted(cuts, a_ends)
        self.b_group = np.searchsorted(cuts, b_ends)
        self.groups = len(cuts)
        self.a_first = np.concatenate(([0], np.cumsum(self.n_a)))
        self.b_first = np.concatenate(([0], np.cumsum(self.n_b)))

    def overlaps(self):
        """Pairs of tokens that share bytes, with how many they share."""
        return product(self.a_rows, transposed(self.b_rows))

    def shared_groups(self):
        """Pairs of tokens of one group."""
        a = membership(self.a_group, self.groups)
        return product(a, transposed(membership(self.b_group, self.groups)))

    def n_groups(self):
        upto = np.concatenate((self.a_group, [self.groups]))[self.a_first]
        return np.diff(upto)

    def written(self):
        """Each text's groups, written out."""
        a_of = transposed(membership(self.a_group, self.groups)).starts
        b_of = transposed(membership(self.b_group, self.groups)).starts
        codes = np.empty(len(self.a_ids) + len(self.b_ids), dtype=np.int64)
        a, b = np.arange(len(self.a_ids)), np.arange(len(self.b_ids))
        codes[a + b_of[self.a_group]] = 2 * self.a_ids + (a + 1 == a_of[self.a_group + 1])
        codes[b + a_of[self.b_group + 1]] = (
            self.tokenizers.b_written + 2 * self.b_ids + (b + 1 == b_of[self.b_group + 1])
        )
        parts = [self.tokenizers.written[code] for code in codes.tolist()]
        bounds = (self.a_first + self.b_first).tolist()
        # Nothing follows the last group.
        return [b"".join(parts[first:end])[:-1] for first, end in zip(bounds, bounds[1:])]

    def pairs(self):
        """For each text and id pair in order: text, pair, and how many links of the text hold it."""
        texts, keys, times = [], [], []
        for a, b, _ in self.overlaps():
            owner = np.searchsorted(self.a_first, a, side="right") - 1
            key = (self.a_ids[a] << _B_BITS) | self.b_ids[b]
            owner, key, number = _counted(owner, key, np.ones(len(key), dtype=np.int64))
            texts.append(owner)
            keys.append(key)
            times.append(number)
        if not texts:
            return (np.zeros(0, dtype=np.int64),) * 3
        return _counted(*map(np.concatenate, (texts, keys, times)))


def _counted(texts, keys, times):
    """Equal ``(text, key)`` added up, in order."""
    order = np.lexsort((keys, texts))
    texts, keys, times = texts[order], keys[order], times[order]
    new = np.flatnonzero(
        np.concatenate(([True], (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])))
    )
    return texts[new], keys[new], np.add.reduceat(times, new)


def _vocabularies(docs, a_path, b_path):
    """Both files, sent to the tasks: their size is fixed, about 2 MB."""
    with open(a_path, encoding="utf-8") as file:
        a_json = file.read()
    with open(b_path, "rb") as file:
        b_model = file.read()
    return docs.sparkSession.sparkContext.broadcast((a_json, b_model, merges_by_id(a_json)))


def _plain(docs):
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _slabs(batches, tokenizers):
    """``doc_ids, Aligned`` of consecutive rows, by the size of their texts."""
    for whole in batches:
        for start, end in slabs(text_sizes(whole.column("text")), SLAB_BYTES):
            rows = whole.slice(start, end - start).to_pydict()
            yield rows["doc_id"], Aligned(tokenizers, [t or "" for t in rows["text"]])


def link_rows(docs, a_path, b_path, kind="overlap"):
    """One row per link: places and ids of both tokens, and its weight.

    ``kind`` is ``overlap``, with the bytes that both tokens cover, or ``group``, with 1 for
    each pair of tokens in one group.
    """
    sent = _vocabularies(docs, a_path, b_path)
    names = [field.split()[0] for field in LINK.split(", ")]

    def run(batches):
        tokenizers = Tokenizers(*sent.value)
        for doc_ids, aligned in _slabs(batches, tokenizers):
            links = aligned.overlaps() if kind == "overlap" else aligned.shared_groups()
            ids = pa.array(doc_ids, pa.int64())
            for a, b, weight in links:
                owner = np.searchsorted(aligned.a_first, a, side="right") - 1
                columns = (
                    a - aligned.a_first[owner],
                    b - aligned.b_first[owner],
                    aligned.a_ids[a],
                    aligned.b_ids[b],
                    weight,
                )
                arrays = [ids.take(pa.array(owner)), *[pa.array(c, pa.int64()) for c in columns]]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return _plain(docs).mapInArrow(run, LINK)


class Described:
    """Distinct segments and what the products of their matrices give for each of them."""

    def __init__(self, tokenizers, segments):
        parts = []
        sizes = [len(s) for s in segments]
        for start, end in slabs(sizes, SLAB_BYTES):
            aligned = Aligned(tokenizers, segments[start:end])
            owner, keys, times = aligned.pairs()
            parts.append(
                (
                    aligned.n_a,
                    aligned.n_b,
                    aligned.n_groups(),
                    np.bincount(owner, times, end - start).astype(np.int64),
                    np.bincount(owner, minlength=end - start),
                    keys,
                    times,
                    np.array(aligned.written(), dtype=object),
                )
            )
        none = np.zeros(0, dtype=np.int64)
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [none] * 8
        self.n_a, self.n_b, self.n_groups, self.n_links = columns[:4]
        self.n_pairs, self.keys, self.times, self.written = columns[4:]
        self.spelled = self.n_a > 0


def _sums(values, bounds):
    return np.diff(np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[bounds])


def _packed(numbers):
    """Numbers of 32 bits, compressed; many of a block's are small."""
    return zlib.compress(numbers.astype("<i4").tobytes(), 1)


def _unpacked(packed):
    return np.frombuffer(zlib.decompress(packed), dtype="<i4")


def _block(number, rows, tokenizers):
    """One row for ``(doc_id, text)`` rows: their own figures, their segments, and their pairs."""
    numbers, own = defaultdict(itertools.count().__next__), []
    for _, text in rows:
        ids = [
            np.fromiter(map(numbers.__getitem__, tokenizers.segments(piece)), dtype=np.int32)
            for piece in (tokenizers.pieces(text) if text else ())
        ]
        own.append(np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32))
    segments = list(numbers)
    described = Described(tokenizers, segments)
    bad = [i for i, ids in enumerate(own) if not described.spelled[ids].all()]
    if bad:
        # A text with a segment that is not spelled is taken whole, and so is not spelled either
        # unless its tokens spell it across segments.
        for i in bad:
            own[i] = np.array([len(segments)], dtype=np.int32)
            segments.append(rows[i][1])
        described = Described(tokenizers, segments)
        for i in bad:
            if not described.spelled[own[i][0]]:
                own[i] = own[i][:0]
    lengths = np.array([len(ids) for ids in own], dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    flat = np.concatenate(own) if own else np.zeros(0, dtype=np.int32)
    keyed = np.repeat(np.arange(len(own)), lengths) * max(len(segments), 1) + flat
    distinct, occurrences = np.unique(keyed, return_counts=True)
    segment, doc = distinct % max(len(segments), 1), distinct // max(len(segments), 1)
    used = np.bincount(segment, occurrences, len(segments)).astype(np.int64)
    pairs, which = np.unique(described.keys, return_inverse=True)
    totals = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(totals, which, described.times * np.repeat(used, described.n_pairs))
    held = totals > 0
    row = {
        "block": number,
        "doc_id": [doc_id for doc_id, _ in rows],
        **{
            name: _sums(getattr(described, name)[flat], bounds).tolist()
            for name in ("n_a", "n_b", "n_groups", "n_links")
        },
        "groups_sha256": [_digest(described.written, ids) for ids in own],
        "pair": pairs[held].tolist(),
        "total": totals[held].tolist(),
        "pairs_of_segment": _packed(described.n_pairs),
        # Pairs of segments that no text has after all get no answer.
        "which": _packed(np.where(held[which], np.cumsum(held)[which] - 1, -1)),
        "times": _packed(described.times),
        "segments_of_doc": np.bincount(doc, minlength=len(own)).tolist(),
        "segment": _packed(segment),
        "occurrences": _packed(occurrences),
    }
    fields = []
    for field in BLOCK.split(", "):
        name, kind = field.split()
        plain = pa.string() if "string" in kind else pa.int64()
        kind = pa.binary() if kind == "binary" else pa.list_(plain) if "array" in kind else plain
        fields.append(pa.field(name, kind))
    return pa.RecordBatch.from_pylist([row], schema=pa.schema(fields))


def _digest(written, ids):
    """SHA-256 of a text's groups, those of its segments one after the other; empty without tokens."""
    if not len(ids):
        return ""
    digest = hashlib.sha256()
    for start in range(0, len(ids), ENTRIES_AT_ONCE):
        digest.update(b";" if start else b"")
        digest.update(b";".join(written[ids[start : start + ENTRIES_AT_ONCE]].tolist()))
    return digest.hexdigest()


def _block_rows(sent):
    def run(batches):
        from pyspark import TaskContext

        tokenizers = Tokenizers(*sent.value)
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                held.append((doc_id.as_py(), text.as_py() or ""))
                size += len(held[-1][1])
                if size >= BLOCK_CHARS:
                    yield _block(number, held, tokenizers)
                    number, held, size = number + 1, [], 0
        if held:
            yield _block(number, held, tokenizers)

    return run


def _per_document(block, answers):
    """The rows of one block's documents from the corpus-wide counts of its pairs."""
    row = block.to_pylist()[0]
    answers = answers.sort_by("pair")
    count = answers.column("count").to_numpy()
    best = answers.column("best").to_numpy()
    which, segment = _unpacked(row["which"]), _unpacked(row["segment"])
    times = _unpacked(row["times"]).astype(np.int64)
    occurrences = _unpacked(row["occurrences"]).astype(np.int64)
    of_segment = np.concatenate(([0], np.cumsum(_unpacked(row["pairs_of_segment"]), dtype=np.int64)))
    of_doc = np.concatenate(([0], np.cumsum(row["segments_of_doc"], dtype=np.int64)))
    # The last value is that of a pair without an answer.
    count, best = np.append(count, 0), np.append(best, 0)

    def per_text(values):
        of_segments = _sums(times * values[which], of_segment)
        return _sums(occurrences * of_segments[segment], of_doc)

    columns = {name: row[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    columns["n_best"] = per_text(best)
    columns["count_sum"] = per_text(count)
    names = [field.split()[0] for field in RESULT.split(", ")]
    kinds = [pa.string() if name == "groups_sha256" else pa.int64() for name in names]
    return pa.table([pa.array(columns[n], k) for n, k in zip(names, kinds)], names=names)


def align(docs, a_path, b_path):
    """How the tokens of a byte-level and a sentence-piece tokenizer lie over each other.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. A space stands
    before each text. A text that is null or empty, or that the tokens of either side do not
    spell byte by byte, has no tokens: all its numbers are 0 and its digest is empty. Each row
    counts by itself: repeated rows give repeated results and count as often as they come.
    Of several highest counts of an id each is the best. Texts of any length are taken whole.
    An empty table gives no rows.

    Returns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.
    """
    spark = docs.sparkSession
    sent = _vocabularies(docs, a_path, b_path)
    # Tokenized once: what follows reads the written blocks, of 3 million characters or one text each.
    blocks = session.written(
        _plain(docs).mapInArrow(_block_rows(sent), BLOCK),
        session.scratch_path(spark, "alignment-blocks"),
    )
    asked = blocks.select("block", F.explode(F.arrays_zip("pair", "total")).alias("p")).select(
        "block", F.col("p.pair").alias("pair"), F.col("p.total").alias("total")
    )
    # An id meets at most the whole other vocabulary.
    same_b = Window.partitionBy("b_id")
    counts = (
        asked.groupBy("pair")
        .agg(F.sum("total").alias("count"))
        .withColumn("b_id", F.col("pair").bitwiseAND((1 << _B_BITS) - 1))
        .withColumn("best", (F.col("count") == F.max("count").over(same_b)).cast("bigint"))
        .drop("b_id")
    )
    answers = asked.drop("total").join(counts, "pair")
    own = blocks.drop("pair", "total").withColumnRenamed("block", "own_block")
    return (
        own.groupBy("own_block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_per_document, RESULT)
    )
