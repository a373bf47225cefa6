"""Byte-level BPE by a segment tree over the ranks of adjacent pairs.

The vocabulary of a public tokenizer is read once, sent to the tasks (its size is
that of the file, about 1.5 MB) and never trained.
"""

import hashlib
import json

import numpy as np
import pyarrow as pa

from verbalance.llm.words import giving_back, slabs, text_sizes

# The split pattern of the vocabulary's own format.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
NO_PAIR = 1 << 60
# Words remembered by a task, and longest word in bytes whose tree is one row of a table.
REMEMBERED = 250_000
TOGETHER = 64
CHARS_AT_ONCE = 500_000


def byte_letters():
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    spare = (b for b in range(256) if b not in letters)
    letters.update({b: chr(256 + i) for i, b in enumerate(spare)})
    return letters


def read_vocabulary(path):
    """What encoding needs of a tokenizer file: byte ids, ranked pairs, bytes by id, whole tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    ids, letters = spec["model"]["vocab"], byte_letters()
    bytes_of = {letter: byte for byte, letter in letters.items()}
    ranks = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        ranks[ids[left], ids[right]] = (rank, ids[left + right])
    spelled = {i: bytes(bytes_of[c] for c in token) for token, i in ids.items()}
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    spelled.update({i: content.encode("utf-8") for content, i in added.items()})
    return {
        "byte_ids": [ids[letters[b]] for b in range(256)],
        "ranks": ranks,
        "spelled": spelled,
        "added": added,
    }


class Codec:
    """Encodes and decodes with one vocabulary; lives in a task."""

    def __init__(self, vocabulary):
        import regex

        self.byte_ids = vocabulary["byte_ids"]
        self.ranks = vocabulary["ranks"]
        self.added = vocabulary["added"]
        self.split = regex.compile(PATTERN).findall
        longest_first = sorted(self.added, key=len, reverse=True)
        self.find_added = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
            if self.added
            else lambda text: [text]
        )
        size = max(vocabulary["spelled"]) + 1
        self.spelled = [vocabulary["spelled"].get(i, b"") for i in range(size)]
        self.remembered = {}
        self.ids_of_bytes = np.array(self.byte_ids, dtype=np.int64)
        merges = sorted(((a << 32) | b, rank, new) for (a, b), (rank, new) in self.ranks.items())
        self.pairs, self.pair_ranks, self.pair_merged = np.array(merges, dtype=np.int64).T.copy()

    def merge(self, symbols):
        """Merge the leftmost pair of lowest rank until no pair is left.

        Leaf i of the tree holds ``rank * width + i`` for the pair that starts at
        symbol i; an inner node holds the smaller of its children, so the root names the next merge. A
        merge changes three leaves and the nodes above them.
        """
        n = len(symbols)
        if n < 2:
            return symbols
        ranks = self.ranks
        width = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [NO_PAIR] * (2 * width)
        for i in range(n - 1):
            found = ranks.get((symbols[i], symbols[i + 1]))
            if found is not None:
                tree[width + i] = found[0] * width + i
        for node in range(width - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while tree[1] < NO_PAIR:
            i = tree[1] % width
            j = after[i]
            symbols[i] = ranks[symbols[i], symbols[j]][1]
            k = after[i] = after[j]
            symbols[j] = -1
            changed = [(i, NO_PAIR), (j, NO_PAIR)] if j < n - 1 else [(i, NO_PAIR)]
            if k < n:
                before[k] = i
                found = ranks.get((symbols[i], symbols[k]))
                if found is not None:
                    changed[0] = (i, found[0] * width + i)
            h = before[i]
            if h >= 0:
                found = ranks.get((symbols[h], symbols[i]))
                changed.append((h, NO_PAIR if found is None else found[0] * width + h))
            for place, value in changed:
                node = width + place
                tree[node] = value
                node >>= 1
                while node:
                    left, right = tree[2 * node], tree[2 * node + 1]
                    low = left if left < right else right
                    if tree[node] == low:
                        break
                    tree[node] = low
                    node >>= 1
        return [s for s in symbols if s >= 0]

    def learn(self, words):
        """Encode words not met before and remember them, those of similar length together."""
        spelled = [w.encode("utf-8", "surrogatepass") for w in words]
        by_width = {}
        for word, data in zip(words, spelled):
            by_width.setdefault(max(2, 1 << (len(data) - 1).bit_length()), []).append((word, data))
        for width, members in by_width.items():
            if width > TOGETHER:
                for word, data in members:
                    ids = self.merge([self.byte_ids[b] for b in data])
                    self.remembered[word] = np.array(ids, dtype="<u4").tobytes()
                continue
            table = np.frombuffer(
                b"".join(data.ljust(width, b"\0") for _, data in members), dtype=np.uint8
            ).reshape(-1, width)
            lengths = np.array([len(data) for _, data in members])
            symbols = np.where(
                np.arange(width) < lengths[:, None], self.ids_of_bytes[table], np.int64(-1)
            )
            symbols = self.merge_together(symbols, lengths)
            left = symbols >= 0
            flat = symbols[left].astype("<u4").tobytes()
            ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
            start = 0
            for (word, _), end in zip(members, ends):
                self.remembered[word] = flat[start:end]
                start = end

    def _leaves(self, left, right, place, width):
        """Leaf values of pairs; a missing symbol is -1."""
        pairs = (left << 32) | right
        found = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        known = (self.pairs[found] == pairs) & (left >= 0) & (right >= 0)
        return np.where(known, self.pair_ranks[found] * width + place, NO_PAIR), found

    def merge_together(self, symbols, lengths):
        """``merge`` for a table of words: one segment tree per row, one merge of each at a time."""
        rows, width = symbols.shape
        places = np.broadcast_to(np.arange(width - 1), (rows, width - 1))
        tree = np.full((rows, 2 * width), NO_PAIR, dtype=np.int64)
        tree[:, width : 2 * width - 1] = self._leaves(
            symbols[:, :-1], symbols[:, 1:], places, width
        )[0]
        level = width
        while level > 1:
            pairs = tree[:, level : 2 * level].reshape(rows, -1, 2)
            tree[:, level // 2 : level] = pairs.min(axis=2)
            level //= 2
        after = np.tile(np.arange(1, width + 1), (rows, 1))
        before = np.tile(np.arange(-1, width - 1), (rows, 1))
        active = np.flatnonzero(tree[:, 1] < NO_PAIR)
        while len(active):
            r = active
            i = tree[r, 1] % width
            j = after[r, i]
            _, found = self._leaves(symbols[r, i], symbols[r, j], i, width)
            symbols[r, i] = self.pair_merged[found]
            symbols[r, j] = -1
            k = after[r, j]
            after[r, i] = k
            inside = k < lengths[r]
            before[r[inside], k[inside]] = i[inside]
            follower = np.where(inside, symbols[r, np.minimum(k, width - 1)], -1)
            h = before[r, i]
            leader = np.where(h >= 0, symbols[r, np.maximum(h, 0)], -1)
            own = symbols[r, i]
            changes = (
                (i, self._leaves(own, follower, i, width)[0]),
                (j, np.full(len(r), NO_PAIR)),
                (np.where(h >= 0, h, j), self._leaves(leader, own, h, width)[0]),
            )
            for place, value in changes:
                node = width + place
                tree[r, node] = value
                node = node >> 1
                while node[0]:
                    tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
                    node = node >> 1
            active = r[tree[r, 1] < NO_PAIR]
        return symbols

    def encode_all(self, texts):
        """The ids of each text as little-endian unsigned 32-bit integers."""
        known = self.remembered
        if len(known) > REMEMBERED:
            known.clear()
        pieces, words = [], set()
        for text in texts:
            parts = []
            for piece in self.find_added(text):
                if piece in self.added:
                    parts.append(piece)
                elif piece:
                    parts.append(found := self.split(piece))
                    words.update(found)
            pieces.append(parts)
        self.learn([w for w in words if w not in known])
        whole = {content: i.to_bytes(4, "little") for content, i in self.added.items()}
        return [
            b"".join(
                [
                    whole[part] if isinstance(part, str) else b"".join([known[w] for w in part])
                    for part in parts
                ]
            )
            for parts in pieces
        ]

    def decode(self, ids):
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        spelled = self.spelled
        return b"".join([spelled[i] for i in numbers]).decode("utf-8", "replace")


def encode_decode(docs, vocabulary_path, with_ids=False):
    """Token ids of every text, and the text they decode to, as counts and digests.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. Null
    text counts as empty and has no ids. Each row is coded by itself, so repeated
    rows give repeated results and an empty table none.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, ``with_ids``,
    ``ids`` (binary) and ``decoded``.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded string" if with_ids else ""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches):
        codec = Codec(sent.value)
        for whole in batches:
            for start, end in slabs(text_sizes(whole.column("text")), CHARS_AT_ONCE):
                batch = whole.slice(start, end - start).to_pydict()
                ids = codec.encode_all([t or "" for t in batch["text"]])
                texts = [codec.decode(i) for i in ids]
                arrays = [
                    pa.array(batch["doc_id"], pa.int64()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array(
                        [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts],
                        pa.string(),
                    ),
                ]
                if with_ids:
                    arrays += [pa.array(ids, pa.binary()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    from pyspark.sql import functions as F

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        giving_back(run), schema
    )
