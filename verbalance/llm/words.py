"""Words of many texts at once, as 64-bit hashes, with numpy inside a task."""

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240229)
_BYTE_VALUE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# ASCII letters and digits, and every byte of a longer UTF-8 sequence.
_ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LETTERS = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def remembered(function, most=20_000):
    """``function`` with its last results kept; unlike the library's cache it is shipped by value."""
    known = {}

    def call(*values):
        if values not in known:
            if len(known) >= most:
                known.clear()
            known[values] = function(*values)
        return known[values]

    return call


def give_back():
    """Hand memory that is free again back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run):
    """``run``, a generator over batches, without what its task freed staying with the worker.

    A worker waits for tasks of later steps; the memory it does not give back is missing there.
    """

    def call(batches):
        yield from run(batches)
        give_back()

    return call


def text_sizes(column):
    """Bytes of each text of an Arrow column; null counts 0."""
    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def slabs(sizes, limit):
    """Cut positions 0..n into runs whose sizes sum to about ``limit``; a larger one stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def mix(x):
    """Bits of a 64-bit hash spread over all positions."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def joined_bytes(texts):
    """All texts, A-Z lower-cased, in one byte array with a line feed after each; and their starts."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(encoded) + b"\n", dtype=np.uint8)]
    lengths = np.fromiter((len(e) + 1 for e in encoded), dtype=np.int64, count=len(encoded))
    return data, np.concatenate(([0], np.cumsum(lengths)))


def find_words(data, letters_only=False):
    """Starts and ends of words: runs without white space, or runs of letters and digits."""
    inside = _ALNUM[data] if letters_only else ~_BLANK[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edges[0::2], edges[1::2]


def hash_words(data, starts, ends):
    """A 64-bit hash of each word."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(total) - np.repeat(first, lengths)
    powers = np.ones(int(lengths.max()), dtype=np.uint64)
    if len(powers) > 1:
        powers[1:] = _BASE
        powers = np.multiply.accumulate(powers)
    values = _BYTE_VALUE[data[np.repeat(starts, lengths) + place]] * powers[place]
    return mix(np.add.reduceat(values, first))


def word_hashes(texts, letters_only=False):
    """Hashes of all words, and where each text's words start among them."""
    data, offsets = joined_bytes(texts)
    starts, ends = find_words(data, letters_only)
    return hash_words(data, starts, ends), np.searchsorted(starts, offsets)
