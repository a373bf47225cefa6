"""Token alignment against the tokenizers' own output, byte by byte."""

import bisect
import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.conftest import rows_of
from verbalance.llm import alignment
from verbalance.llm.queries import PIECES, VOCABULARY

DOCS = "doc_id bigint, text string"
TEXTS = [
    (1, None),
    (2, ""),
    (3, "x"),
    (4, "Hello world, it's <|endoftext|> and <s> unhappily."),
    (5, " two  blanks\n\n\tand tabs "),
    (6, "中文 \U0001f600 é ▁ mark"),
    (7, "naïve café über straße 1234567 " * 40),
    (8, "hyphen-ation's supercalifragilistic " * 300),
    (9, "\x00nul \x1c"),
    (10, "same"),
    (11, "same"),
]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return a, b


def spelled(both, text):
    """Ids and byte strings of both sides, or None."""
    a, b = both
    letters = {v: k for k, v in alignment.byte_letters().items()}
    of_a = a.encode(" " + text, add_special_tokens=False).ids
    of_b = b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in of_a]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in of_b
    ]
    whole = (" " + text).encode()
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    return of_a, bytes_a, of_b, bytes_b


def ends(parts):
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def expected(both, rows):
    links, facts = [], []
    for _, text in rows:
        found = spelled(both, text or "")
        if found is None:
            facts.append((0, 0, 0, ""))
            links.append([])
            continue
        of_a, bytes_a, of_b, bytes_b = found
        at_a = [i for i, t in enumerate(bytes_a) for _ in t]
        at_b = [i for i, t in enumerate(bytes_b) for _ in t]
        links.append([(of_a[i], of_b[j]) for i, j in sorted(set(zip(at_a, at_b)))])
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        cuts = sorted(set(ends_a) & set(ends_b))
        members = {cut: ([], []) for cut in cuts}
        for side, (ids, own_ends) in enumerate(((of_a, ends_a), (of_b, ends_b))):
            for i, end in zip(ids, own_ends):
                members[cuts[bisect.bisect_left(cuts, end)]][side].append(str(i))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in members.values()]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        facts.append((len(of_a), len(of_b), len(groups), sha))
    count = Counter(pair for own in links for pair in own)
    highest = defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    return sorted(
        (
            (i, n_a, n_b, n_groups, len(own), sum(count[p] == highest[p[1]] for p in own), sum(count[p] for p in own), sha)
            for (i, _), (n_a, n_b, n_groups, sha), own in zip(rows, facts, links)
        ),
        key=repr,
    )


def align(frame):
    return alignment.align(frame, VOCABULARY, PIECES)


def test_align(spark, both, monkeypatch):
    frame = spark.createDataFrame(TEXTS, DOCS).repartition(3)
    assert rows_of(align(frame)) == expected(both, TEXTS)


def test_align_the_table(spark, both):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    assert rows_of(align(frame)) == expected(both, rows)


def test_repeated_null_and_clashing_rows(spark, both):
    names = "block pair total which times count best n_pairs p b_id a_place".split()
    wide = DOCS + "".join(f", {n} string" for n in names)
    rows = [(None, "no id"), (None, None), (5, "again and again"), (5, "again and again"), (5, "other")]
    frame = spark.createDataFrame([r + ("k",) * len(names) for r in rows], wide)
    assert rows_of(align(frame)) == expected(both, rows)
    empty = align(spark.createDataFrame([], DOCS))
    assert empty.collect() == [] and empty.columns == [f.split()[0] for f in alignment.RESULT.split(", ")]


def test_small_blocks_slabs_and_pieces(both, monkeypatch):
    """What ends a slab of rows, a piece of a text or a stretch of a digest changes nothing."""
    import verbalance.llm.alignment as module

    with open(VOCABULARY) as file, open(PIECES, "rb") as model:
        tokenizers = alignment.Tokenizers(file.read(), model.read())
    assert tokenizers.can_cut
    random.seed(3)
    words = "the quick brown fox über 12 it's, jumped  over \n中文 <s> lazy".split(" ")
    text = " ".join(random.choices(words, k=4000))
    texts = [text, "", "a b", text[::-1]]
    rows = list(enumerate(texts))
    whole = module._block(0, rows, tokenizers).to_pylist()[0]
    monkeypatch.setattr(module, "PIECE_CHARS", 50)
    monkeypatch.setattr(module, "ENTRIES_AT_ONCE", 7)
    monkeypatch.setattr(module, "SLAB_BYTES", 60)
    assert module._block(0, rows, tokenizers).to_pylist()[0] == whole
    facts = sorted(expected(both, rows))
    assert [r[7] for r in facts] == whole["groups_sha256"]
    assert [r[4] for r in facts] == whole["n_links"] and [r[1] for r in facts] == whole["n_a"]


def test_merging_by_ids_gives_the_tokens_of_the_ranked_merges(both):
    with open(VOCABULARY) as file, open(PIECES, "rb") as model:
        a_json, b_model = file.read(), model.read()
    assert alignment.merges_by_id(a_json)
    fast, plain = (alignment.Tokenizers(a_json, b_model, by_ids) for by_ids in (True, False))
    random.seed(11)
    letters = "abcdefghij nrst'é中\n 0123" + "".join(map(chr, range(0x20, 0x180)))
    texts = ["".join(random.choices(letters, k=random.randint(1, 400))) for _ in range(1500)]
    texts += ["a" * n for n in range(1, 400)] + [" " * n + "x" for n in range(1, 60)] + ["<|endoftext|>", "ab" * 300]
    assert fast.encode(texts) == plain.encode(texts)
    # A vocabulary whose ids do not follow its merges is left to the ranked merges.
    spec = json.loads(a_json)
    spec["model"]["merges"][0], spec["model"]["merges"][9] = spec["model"]["merges"][9], spec["model"]["merges"][0]
    assert not alignment.merges_by_id(json.dumps(spec))


@pytest.mark.parametrize("seed", range(6))
def test_segments_change_no_token(both, seed):
    """The tokens of a text are those of its segments, whatever stands around the blanks."""
    with open(VOCABULARY) as file, open(PIECES, "rb") as model:
        tokenizers = alignment.Tokenizers(file.read(), model.read())
    random.seed(seed)
    parts = ["word", "Über", "12", "'s", "\n", "\t", "\r\n", "\xa0", "\x1c", "\u2003", "中文", "▁", "--", "<s>", "e\u0301", "\U0001f600", "."]
    for _ in range(300):
        text = "".join(random.choice(parts) + " " * random.choice([0, 1, 1, 1, 2, 3]) for _ in range(12))
        text = " " * random.choice([0, 0, 1, 2]) + text
        a, b = both
        segments = [s for piece in tokenizers.pieces(text) for s in tokenizers.segments(piece)]
        of_a = [i for s in segments for i in a.encode(" " + s, add_special_tokens=False).ids]
        of_b = [i for s in segments for i in b.encode(s)]
        assert of_a == a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert of_b == b.encode(text), repr(text)


def test_product_against_dense_matrices():
    rng = np.random.default_rng(5)
    left, right = rng.integers(0, 2, (30, 20)), rng.integers(0, 2, (20, 25))

    def rows(dense):
        starts = np.concatenate(([0], np.cumsum(dense.sum(axis=1))))
        return alignment.Rows(starts, np.nonzero(dense)[1], dense.shape[1])

    found = np.zeros((30, 25), dtype=int)
    for r, c, v in alignment.product(rows(left), rows(right)):
        found[r, c] += v
    assert (found == left @ right).all()
    t = alignment.transposed(rows(right))
    assert (t.starts == rows(right.T).starts).all() and (t.columns == rows(right.T).columns).all()


def test_links_of_both_kinds(spark, both):
    # The plain version is quadratic.
    rows = [(i, t[:200] if t else t) for i, t in TEXTS]
    frame = spark.createDataFrame(rows, DOCS)
    overlaps = rows_of(alignment.link_rows(frame, VOCABULARY, PIECES))
    groups = rows_of(alignment.link_rows(frame, VOCABULARY, PIECES, "group"))
    want_overlaps, want_groups = [], []
    for i, text in rows:
        found = spelled(both, text or "")
        if found is None:
            continue
        of_a, bytes_a, of_b, bytes_b = found
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        cuts = sorted(set(ends_a) & set(ends_b))
        group = lambda e: next(c for c in cuts if c >= e)
        for x, (end_x, tx) in enumerate(zip(ends_a, bytes_a)):
            for y, (end_y, ty) in enumerate(zip(ends_b, bytes_b)):
                shared = min(end_x, end_y) - max(end_x - len(tx), end_y - len(ty))
                if shared > 0:
                    want_overlaps.append((i, x, y, of_a[x], of_b[y], shared))
                if group(end_x) == group(end_y):
                    want_groups.append((i, x, y, of_a[x], of_b[y], 1))
    assert overlaps == sorted(want_overlaps, key=repr) and groups == sorted(want_groups, key=repr)


def test_a_very_long_text(spark, both):
    text = "Some words, and numbers 123 of a very long text; " * 40_000
    rows = [(1, text), (2, "short")]
    found = {r["doc_id"]: r for r in align(spark.createDataFrame(rows, DOCS)).collect()}
    a, b = both
    assert found[1]["n_a"] == len(a.encode(" " + text, add_special_tokens=False).ids)
    assert found[1]["n_b"] == len(b.encode(text)) and found[1]["n_links"] >= found[1]["n_a"]
