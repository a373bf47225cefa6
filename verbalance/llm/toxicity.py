"""Toxic spans by a linear-chain conditional random field, and the score of their document.

A bounded sample of labelled documents is turned into labelled tokens: in a toxic
document those whose words set toxic documents apart, almost as much as its most telling
word does. The field has two states, clean and toxic; its features are the word and its
neighbours. Marginals by forward and backward passes give spans and, by the highest
of them and their sum, a document score that is calibrated on the sample's labels.
"""

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from verbalance.llm import samples, words

SAMPLE_DOCUMENTS = 1500
SAMPLE_BYTES = 4_000_000
# Bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
LEAST_DOCUMENTS = 3
LEAST_SCORE = 2.0
NEAR_THE_BEST = 0.75
STEPS, RATE, RIDGE = 80, 0.3, 0.05
# The field is fitted on chains of so many tokens of the sample, at most so many with and without
# toxic ones, evenly spread over it.
CHAIN, MOST_CHAINS = 32, 6000
WORDS_AT_ONCE = 50_000
CHUNK = 32
BYTES_AT_ONCE = 500_000
# Parts that the sample's units are counted in, one at a time.
PARTS = 8
SPAN_AT = 0.5


def _hashed(data, starts, ends):
    """Hashes of words, some at a time: hashing lays out a number for each byte."""
    parts = [
        words.hash_words(data, starts[i : i + WORDS_AT_ONCE], ends[i : i + WORDS_AT_ONCE])
        for i in range(0, len(starts), WORDS_AT_ONCE)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


class Tokens:
    """Words of many texts: hashes, places in the bytes, and the range of each text."""

    def __init__(self, texts):
        self.data, self.offsets = words.joined_bytes(texts)
        self.starts, self.ends = words.find_words(self.data, letters_only=True)
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.text_of = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.bounds))

    def units(self):
        """Units of a token, one kind after the other: its word, and its beginnings that are shorter (else 0)."""
        yield _hashed(self.data, self.starts, self.ends)
        for size in BEGINNINGS:
            cut = np.minimum(self.ends, self.starts + size)
            unit = words.mix(_hashed(self.data, self.starts, cut) + np.uint64(size))
            unit[cut >= self.ends] = 0
            yield unit


def _lookup(vocabulary, hashes):
    """Place of each hash in the sorted vocabulary, counted from 1; 0 if it is not there."""
    if not len(vocabulary):
        return np.zeros(len(hashes), dtype=np.int32)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at + 1, 0).astype(np.int32)


def _features(tokens, vocabulary, picked=slice(None)):
    """For each picked token the numbers of its units and of the words around it; the edge of a text is 0."""
    own, around = [], []
    for unit in tokens.units():
        numbers = _lookup(vocabulary, unit)
        if not own:
            before, after = np.zeros_like(numbers), np.zeros_like(numbers)
            before[1:], after[:-1] = numbers[:-1], numbers[1:]
            full = np.diff(tokens.bounds) > 0
            before[tokens.bounds[:-1][full]] = 0
            after[tokens.bounds[1:][full] - 1] = 0
            around = [before[picked], after[picked]]
        own.append(numbers[picked])
    return [*own, *around]


def _unary(bias, weights, features):
    """Score of the toxic state; the first row of weights is shared by all units of a token."""
    own = sum(weights[0][f] for f in features[:-2])
    return bias + own + weights[1][features[-2]] + weights[2][features[-1]]


def _slopes(excess, features, size):
    own = sum(np.bincount(f, excess, size) for f in features[:-2])
    own[0] = 0
    return np.stack((own, *[np.bincount(f, excess, size) for f in features[-2:]]))


def marginals(unary, bounds, transitions):
    """Probability of the toxic state for each token, and expected steps from state to state.

    ``unary`` is the score of the toxic state over the clean one. Each text is a chain
    of its own, of any length. Messages are ratios toxic / clean: the steps of
    a chunk of every text are first joined into one map, maps are followed from chunk to
    chunk, and then all chunks are worked through at once.
    """
    lengths = np.diff(bounds)
    if not len(unary):
        return unary, np.zeros((2, 2))
    (t00, t01), (t10, t11) = np.exp(transitions)
    count = -(-lengths // CHUNK)
    first_row = np.concatenate(([0], np.cumsum(count)))
    within = np.arange(bounds[-1]) - np.repeat(bounds[:-1], lengths)
    place = np.repeat(first_row[:-1] * CHUNK, lengths) + within
    rows = int(first_row[-1])
    factor, real = np.ones(rows * CHUNK), np.zeros(rows * CHUNK, dtype=bool)
    factor[place], real[place] = np.exp(np.clip(unary, -50, 50)), True
    # A column holds one step of every chunk; padding stands at the end of a text.
    factor, real = factor.reshape(rows, CHUNK).T.copy(), real.reshape(rows, CHUNK).T.copy()
    full = real.all(axis=1)

    def chunk_maps(columns, update):
        a, b, c, d = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
        for column in columns:
            new = update(a, b, c, d, factor[column])
            total = new[0] + new[1] + new[2] + new[3]
            new = [x / total for x in new]
            if not full[column]:
                new = [np.where(real[column], x, y) for x, y in zip(new, (a, b, c, d))]
            a, b, c, d = new
        return a, b, c, d

    def entering(maps, here_of, shift):
        """The ratio that enters each chunk, all texts a chunk at a time."""
        entry = np.ones(rows)
        a, b, c, d = maps
        for k in range(1, int(count.max())):
            here = here_of(np.flatnonzero(count > k), k)
            last = here + shift
            entry[here] = (c[last] + d[last] * entry[last]) / (a[last] + b[last] * entry[last])
        return entry

    ratio = behind = np.ones(rows)
    if count.max() > 1:
        ratio = entering(
            chunk_maps(
                range(CHUNK),
                lambda a, b, c, d, w: (
                    t00 * a + t10 * c,
                    t00 * b + t10 * d,
                    w * (t01 * a + t11 * c),
                    w * (t01 * b + t11 * d),
                ),
            ),
            lambda texts, k: first_row[texts] + k,
            -1,
        )
        behind = entering(
            chunk_maps(
                reversed(range(CHUNK)),
                lambda a, b, c, d, w: (
                    t00 * a + t01 * w * c,
                    t00 * b + t01 * w * d,
                    t10 * a + t11 * w * c,
                    t10 * b + t11 * w * d,
                ),
            ),
            lambda texts, k: first_row[texts + 1] - 1 - k,
            1,
        )
    ahead, after = np.empty((CHUNK, rows)), np.empty((CHUNK, rows))
    for column in range(CHUNK):
        ratio = factor[column] * (t01 + t11 * ratio) / (t00 + t10 * ratio)
        ahead[column] = ratio
    for column in reversed(range(CHUNK)):
        after[column] = behind
        coming = factor[column] * behind
        new = (t10 + t11 * coming) / (t00 + t01 * coming)
        behind = new if full[column] else np.where(real[column], new, behind)
    ahead, after = ahead.T.ravel()[place], after.T.ravel()[place]
    odds = ahead * after
    inner = np.ones(len(place) - 1, dtype=bool)
    inner[np.unique(bounds[(bounds > 0) & (bounds < len(place))]) - 1] = False
    left = ahead[:-1][inner]
    right = (np.exp(np.clip(unary, -50, 50)) * after)[1:][inner]
    pairs = np.stack((np.full(len(left), t00), t01 * right, t10 * left, t11 * left * right))
    steps = (pairs / pairs.sum(axis=0)).sum(axis=1).reshape(2, 2)
    return odds / (1 + odds), steps


def _highest(values, bounds):
    """The largest value of each text, 0 for one without tokens."""
    out = np.zeros(len(bounds) - 1)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        out[full] = np.maximum.reduceat(values, bounds[:-1][full])
    return out


def _logit(p):
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def _documents(unit, part, text_of, toxic):
    """Units of one part of all hashes: each with its documents and its toxic documents."""
    rows = np.flatnonzero((unit != 0) & (unit % np.uint64(PARTS) == np.uint64(part)))
    if not len(rows):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
    unit, text = unit[rows], text_of[rows]
    order = np.lexsort((text, unit))
    unit, text = unit[order], text[order]
    fresh = np.append(True, (unit[1:] != unit[:-1]) | (text[1:] != text[:-1]))
    unit, text = unit[fresh], text[fresh]
    found, first = np.unique(unit, return_index=True)
    bad = np.add.reduceat(toxic[text].astype(float), first)
    return found, np.diff(np.append(first, len(unit))), bad


def label_tokens(tokens, toxic):
    """Which tokens of the sample count as toxic, and the words worth a feature."""
    n_bad, n_good = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    best, kept = np.zeros(len(tokens.text_of)), []
    for unit in tokens.units():
        parts = [_documents(unit, part, tokens.text_of, toxic) for part in range(PARTS)]
        found, both, bad = (np.concatenate(column) for column in zip(*parts))
        if not len(found):
            continue
        order = np.argsort(found)
        found, both, bad = found[order], both[order], bad[order]
        score = np.log((bad + 0.5) / (n_bad + 1)) - np.log((both - bad + 0.5) / (n_good + 1))
        score[(score < LEAST_SCORE) | (bad < LEAST_DOCUMENTS)] = 0
        own = np.where(unit != 0, score[np.minimum(np.searchsorted(found, unit), len(found) - 1)], 0)
        best = np.maximum(best, own)
        kept.append(found[both >= LEAST_DOCUMENTS])
    highest = _highest(best, tokens.bounds)[tokens.text_of]
    labels = toxic[tokens.text_of] & (best > 0) & (best >= NEAR_THE_BEST * highest)
    return labels, np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)


def _chains(tokens, labels):
    """Tokens of the chains to fit on, and the bounds of these chains."""
    within = np.arange(len(labels)) - np.repeat(tokens.bounds[:-1], np.diff(tokens.bounds))
    chain = np.cumsum(within % CHAIN == 0) - 1
    marked = np.bincount(chain, labels) > 0
    picked = np.zeros(len(marked), dtype=bool)
    for kind in (np.flatnonzero(marked), np.flatnonzero(~marked)):
        picked[kind[:: max(1, -(-len(kind) // MOST_CHAINS))]] = True
    lengths = np.bincount(chain)[picked]
    return np.flatnonzero(picked[chain]), np.concatenate(([0], np.cumsum(lengths)))


def fit(texts, toxic):
    """A model of sample texts and their labels."""
    toxic = np.asarray(toxic, dtype=bool)
    base = float(toxic.mean()) if len(toxic) else 0.0
    if not toxic.any() or toxic.all():
        return {"base": base}
    tokens = Tokens(texts)
    labels, vocabulary = label_tokens(tokens, toxic)
    size = len(vocabulary) + 1
    weights = np.zeros((3, size))
    bias, transitions = np.array([-4.0]), np.zeros((2, 2))
    picked, bounds = _chains(tokens, labels)
    features, labels = _features(tokens, vocabulary, picked), labels[picked]
    del tokens
    inner = np.ones(max(len(labels) - 1, 0), dtype=bool)
    inner[bounds[1:-1] - 1] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:-1][inner].astype(int), labels[1:][inner].astype(int)), 1)
    n = max(len(labels), 1)
    parameters = [weights, bias, transitions]
    means = [np.zeros_like(p) for p in parameters]
    squares = [np.zeros_like(p) for p in parameters]
    for step in range(1, STEPS + 1):
        unary = _unary(bias[0], weights, features)
        chance, pairs = marginals(unary, bounds, transitions)
        excess = labels - chance
        slopes = [
            _slopes(excess, features, size) - RIDGE * weights,
            np.array([excess.sum()]),
            seen - pairs,
        ]
        for p, mean, square, slope in zip(parameters, means, squares, slopes):
            mean += 0.1 * (slope / n - mean)
            square += 0.01 * ((slope / n) ** 2 - square)
            p += (
                RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-10)
            )
    model = {"bias": float(bias[0]), "weights": weights, "transitions": transitions}
    model["vocabulary"] = vocabulary
    evidence = []
    for first, last in words.slabs([len(t) for t in texts], BYTES_AT_ONCE):
        own = Tokens(texts[first:last])
        evidence.append(_evidence(_chances(model, own), own.bounds))
    return {**model, "base": base, "curve": _calibrate(np.concatenate(evidence), toxic)}


def _chances(model, tokens):
    """The marginal of the toxic state for each token."""
    unary = _unary(model["bias"], model["weights"], _features(tokens, model["vocabulary"]))
    return marginals(unary, tokens.bounds, model["transitions"])[0]


def _evidence(chance, bounds):
    """Per text: its highest marginal, how much there is in all, and its length."""
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    amount = np.bincount(texts, np.where(chance >= SPAN_AT, chance, 0), len(bounds) - 1)
    columns = (_logit(_highest(chance, bounds)), np.log1p(amount), np.log1p(np.diff(bounds)))
    return np.stack(columns, axis=1)


# More toxic tokens never speak against toxicity, and more tokens in all never for it.
_SIGNS = np.array([1, 1, -1])


def _calibrate(evidence, toxic):
    """Weights of a logistic curve from evidence to label; the last is its level."""
    center, spread = evidence.mean(axis=0), evidence.std(axis=0) + 1e-6
    x = (evidence - center) / spread
    used = list(range(x.shape[1]))
    while True:
        weights = _logistic(np.column_stack((x[:, used], np.ones(len(x)))), toxic)
        fitting = [k for k, w in zip(used, weights) if w * _SIGNS[k] > 0]
        if fitting == used:
            break
        used = fitting
    curve = np.zeros(x.shape[1] + 1)
    curve[used], curve[-1] = weights[:-1] / spread[used], weights[-1]
    curve[-1] -= curve[:-1] @ center
    return curve


def _logistic(x, toxic, steps=25):
    """Logistic regression with a unit ridge, by Newton steps."""
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - p) - weights
        weights += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(weights)), slope)
    return weights


def _doc_scores(weights, evidence):
    return 1 / (1 + np.exp(-np.clip(evidence @ weights[:-1] + weights[-1], -30, 30)))


def score_texts(model, texts):
    """Score of each text and its spans as ``(start, end)`` in code points."""
    none = [[] for _ in texts]
    if "weights" not in model:
        return np.full(len(texts), model["base"]), none
    tokens = Tokens(texts)
    chance = _chances(model, tokens)
    scores = _doc_scores(model["curve"], _evidence(chance, tokens.bounds))
    hits = np.flatnonzero(chance >= SPAN_AT)
    found, first = np.unique(tokens.text_of[hits], return_index=True)
    for text, own in zip(found.tolist(), np.split(hits, first[1:])):
        begin = tokens.offsets[text]
        points = np.cumsum((tokens.data[begin : tokens.offsets[text + 1]] & 0xC0) != 0x80)
        starts = points[tokens.starts[own] - begin] - 1
        ends = points[tokens.ends[own] - begin - 1]
        # Words with one character between them are one span.
        new = np.append(True, starts[1:] > ends[:-1] + 1)
        last = np.append(np.flatnonzero(new)[1:] - 1, len(own) - 1)
        none[text] = list(zip(starts[new].tolist(), ends[last].tolist()))
    return scores, none


def learn(docs, labels):
    """A model of a bounded sample of documents labelled 0 or 1, none of the held-out fold.

    An id with several labels counts as toxic if one of them says so. One task fits the field, on
    the ``SAMPLE_BYTES`` of either label at most; the driver sees the finished model only, whose
    size is bounded by the words of the sample.
    """
    marked = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")
    )
    marked = marked.where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = samples.sample_table(marked, docs, SAMPLE_DOCUMENTS, SAMPLE_BYTES)

    def run(batches):
        rows = sorted(
            (row["spot"], row["label"], row["text"])
            for batch in batches
            for row in batch.to_pylist()
        )
        model = fit([text for _, _, text in rows], [label == 1 for _, label, _ in rows])
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    found = sample.coalesce(1).mapInArrow(words.giving_back(run), "model binary").first()
    return pickle.loads(found["model"]) if found else fit([], [])


def score(docs, labels):
    """Score, decision and toxic spans of every document.

    ``docs`` needs ``doc_id`` (long) and ``text``, ``labels`` ``doc_id`` and ``toxic``;
    other columns are ignored. The model is fitted on at most ``SAMPLE_DOCUMENTS`` labelled
    documents of either label (and ``SAMPLE_BYTES`` of text, ``MOST_CHAINS`` chains of ``CHAIN`` tokens
    with and as many without toxic ones), none of the held-out fold. Without labels
    of both kinds every score is the share of toxic ones (0 if there are none).
    Null and empty texts have no tokens and get the lowest score. Each row is scored by its text
    alone, so repeated rows get equal scores; a null id is never held out.

    Returns ``doc_id, held_out, score, predicted`` and ``spans``, the offending
    ranges in code points.
    """
    model = learn(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = (
        "doc_id bigint, held_out boolean, score double, spans array<struct<start:int,end:int>>"
    )
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for whole in batches:
            for start, end in words.slabs(words.text_sizes(whole.column("text")), BYTES_AT_ONCE):
                part = whole.slice(start, end - start)
                scores, spans = score_texts(sent.value, [t or "" for t in part.column("text").to_pylist()])
                listed = [[{"start": a, "end": b} for a, b in own] for own in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(scores, pa.float64()),
                        pa.array(listed, kind),
                    ],
                    names=["doc_id", "held_out", "score", "spans"],
                )

    scored = samples.with_fold(docs).mapInArrow(words.giving_back(run), schema)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted, "spans")


def _toxic(model, column):
    """Which texts of an Arrow column are predicted toxic; only some of them are laid out at a time."""
    scores = np.zeros(len(column))
    for start, end in words.slabs(words.text_sizes(column), BYTES_AT_ONCE):
        texts = [t or "" for t in column.slice(start, end - start).to_pylist()]
        scores[start:end] = score_texts(model, texts)[0]
    return pa.array(scores >= 0.5)


def clean_documents(docs, labels):
    """The rows of ``docs`` that are not predicted toxic, whole."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def toxic(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from words.giving_back(lambda parts: (_toxic(sent.value, part) for part in parts))(columns)

    return docs.where(~F.arrow_udf(toxic, "boolean")("text"))
