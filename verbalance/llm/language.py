"""Language identification in two steps: the family, then the language within it.

Both steps are one-versus-one linear support vector machines over hashed runs of two and three
bytes of words. They are fitted on a bounded sample of labelled documents.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from verbalance.llm import samples, words

SAMPLE_DOCUMENTS = 700
SAMPLE_BYTES = 3_000_000
FEATURES = 8192
STEPS, RATE, RIDGE = 80, 0.05, 1e-3
BYTES_AT_ONCE = 2_000_000
UNKNOWN = "und"

# Language codes by family. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "ky", "uz", "tk", "tt"),
    "indic": ("hi", "ur", "bn", "pa", "gu", "mr", "ne", "si", "or", "as"),
    "iranian": ("fa", "ps", "ku", "tg"),
    "semitic": ("ar", "he", "am", "mt"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "sinitic": ("zh", "yue", "wuu"),
    "austronesian": ("id", "ms", "tl", "jv", "mg"),
    "baltic": ("lt", "lv"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTER = re.compile(r"[^\W\d_]")
_A, _B, _C = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


def family(code):
    return FAMILY_OF.get(code.lower().replace("_", "-").split("-")[0], code)


def grams(texts):
    """Feature numbers of all texts in a row, and where each text's begin.

    Bytes that are neither letters nor part of a longer sequence stand as one separator.
    """
    data, offsets = words.joined_bytes(texts)
    inside = words.LETTERS[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    keep[:-1] |= inside[1:]
    symbol = np.where(inside, data, 32).astype(np.uint32)[keep]
    bounds = np.concatenate(([0], np.cumsum(keep)))[offsets]
    pairs = symbol[:-1] * _A + symbol[1:] * _B
    triples = pairs[:-1] + symbol[2:] * _C
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    two = (pairs ^ (pairs >> np.uint32(15))) * _B >> shift
    three = (triples ^ (triples >> np.uint32(15))) * _A >> shift
    n = len(symbol)
    numbers = np.zeros((max(n, 1), 2), dtype=np.int64)
    numbers[: len(two), 0], numbers[: len(three), 1] = two, three
    return numbers, bounds


def frequencies(texts):
    """Share of each feature in each text; a dense table for the sample."""
    numbers, bounds = grams(texts)
    table = np.zeros((len(texts), FEATURES), dtype=np.float32)
    for row, (start, end) in enumerate(zip(bounds[:-1], bounds[1:])):
        if end > start:
            table[row] = np.bincount(numbers[start:end].ravel(), minlength=FEATURES) / (
                2 * (end - start)
            )
    return table


def _machine(table, sign):
    """A linear support vector machine with squared hinge loss; classes weigh the same."""
    weight = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1))
    weight = weight.astype(np.float32)
    w, level = np.zeros(table.shape[1], dtype=np.float32), 0.0
    mean, square, level_mean, level_square = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        gap = np.maximum(1 - sign * (table @ w + level), 0) * sign * weight
        slope, level_slope = gap @ table - RIDGE * w, float(gap.sum())
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope * slope - square)
        level_mean += 0.1 * (level_slope - level_mean)
        level_square += 0.01 * (level_slope**2 - level_square)
        down, down2 = 1 - 0.9**step, 1 - 0.99**step
        w += RATE * (mean / down) / (np.sqrt(square / down2) + 1e-8)
        level += RATE * (level_mean / down) / (np.sqrt(level_square / down2) + 1e-8)
    return w, level


def _one_versus_one(table, labels, classes):
    """A machine per pair of classes, from the rows of these two."""
    machines = []
    for i in range(len(classes)):
        for j in range(i + 1, len(classes)):
            rows = np.flatnonzero((labels == classes[i]) | (labels == classes[j]))
            sign = np.where(labels[rows] == classes[i], 1, -1).astype(np.float32)
            machines.append((i, j, *_machine(table[rows], sign)))
    return machines


def fit(texts, labels):
    """A model of sample texts and their languages."""
    rows = [r for r, t in enumerate(texts) if _LETTER.search(t)]
    labels = np.array([labels[r] for r in rows], dtype=object)
    languages = sorted(set(labels))
    if not languages:
        return {"families": []}
    table = frequencies([texts[r] for r in rows])
    scale = table.std(axis=0) + 1e-6
    table /= scale * np.float32(np.sqrt(FEATURES))
    by_family = {}
    for code in languages:
        by_family.setdefault(family(code), []).append(code)
    names = sorted(by_family)
    of = np.array([family(code) for code in labels], dtype=object)
    groups = [(names, _one_versus_one(table, of, names))]
    for name in names:
        own = np.flatnonzero(of == name)
        groups.append((by_family[name], _one_versus_one(table[own], labels[own], by_family[name])))
    machines = [m for _, pairs in groups for m in pairs]
    weights = np.zeros((FEATURES, len(machines)), dtype=np.float32)
    for k, (_, _, w, _) in enumerate(machines):
        weights[:, k] = w / (scale * np.float32(np.sqrt(FEATURES)))
    levels = np.array([level for _, _, _, level in machines])
    pairs = [[(i, j) for i, j, _, _ in own] for _, own in groups]
    return {
        "families": [classes for classes, _ in groups[1:]],
        "pairs": pairs,
        "weights": weights,
        "levels": levels,
    }


def _votes(margins, pairs, n):
    """The class most machines vote for, margins settling ties, and how sure the vote is."""
    rows = len(margins)
    won, strength = np.zeros((rows, n)), np.zeros((rows, n))
    for k, (i, j) in enumerate(pairs):
        won[:, i] += margins[:, k] > 0
        won[:, j] += margins[:, k] <= 0
        strength[:, i] += margins[:, k]
        strength[:, j] -= margins[:, k]
    best = (won + 0.5 * np.tanh(strength / max(n, 1))).argmax(axis=1)
    least = np.full(rows, np.inf)
    for k, (i, j) in enumerate(pairs):
        toward = np.where(best == i, margins[:, k], np.where(best == j, -margins[:, k], np.inf))
        least = np.minimum(least, toward)
    return best, 1 / (1 + np.exp(-2 * np.clip(least, -15, 15)))


def predict(model, texts):
    """Language and score of each text."""
    found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model["families"]:
        return found, scores
    known = [r for r, t in enumerate(texts) if t is not None and _LETTER.search(t)]
    if not known:
        return found, scores
    numbers, bounds = grams([texts[r] for r in known])
    counts = np.maximum(np.diff(bounds), 1)
    margins = np.zeros((len(known), len(model["levels"])))
    for k in range(margins.shape[1]):
        own = model["weights"][:, k][numbers].sum(axis=1, dtype=np.float64)
        total = np.concatenate(([0.0], np.cumsum(own)))
        margins[:, k] = (total[bounds[1:]] - total[bounds[:-1]]) / (2 * counts) + model["levels"][k]
    pairs, families = model["pairs"], model["families"]
    start = len(pairs[0])
    best, sure = _votes(margins[:, :start], pairs[0], len(families))
    for f, (classes, own) in enumerate(zip(families, pairs[1:])):
        rows = np.flatnonzero(best == f)
        choice, within = _votes(margins[rows, start : start + len(own)], own, len(classes))
        start += len(own)
        for row, c, chance in zip(rows, choice, within):
            found[known[row]] = classes[c]
            scores[known[row]] = sure[row] * chance
    return found, scores


def identify(docs):
    """The language of every document.

    ``docs`` needs ``doc_id`` (long), ``text`` and ``lang``, which is learnt from where it is not
    null and the document is not held out; other columns are ignored. The machines are
    fitted on at most ``SAMPLE_DOCUMENTS`` documents per language (and ``SAMPLE_BYTES`` of text).
    Null text and text without a letter are ``und`` with score 0, as is everything if
    nothing could be learnt. Rows are judged by their text alone, so repeated rows
    agree; a null id is never held out and nothing is learnt from it.

    Returns ``doc_id, held_out, lang_pred, score``.
    """
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("label"))
    rows = samples.take_sample(marked, docs, SAMPLE_DOCUMENTS, SAMPLE_BYTES)
    model = fit([text for _, text in rows], [label for label, _ in rows])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for whole in batches:
            for start, end in words.slabs(words.text_sizes(whole.column("text")), BYTES_AT_ONCE):
                part = whole.slice(start, end - start)
                found, scores = predict(sent.value, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(found, pa.string()),
                        pa.array(scores, pa.float64()),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    schema = "doc_id bigint, held_out boolean, lang_pred string, score double"
    return samples.with_fold(docs).mapInArrow(run, schema)
