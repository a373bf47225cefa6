"""Each operator against its plain version, and on awkward rows."""

import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.llm import brute
from verbalance.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    graph,
    html_text,
    language,
    line_dedup,
    minhash,
    mixing,
    samples,
    toxicity,
    url_filter,
    words,
)
from verbalance.llm.queries import VOCABULARY

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, keep string, digest string, id int"
LONG = "  A line that forty code points and more make long enough  "
TEXTS = [
    (1, None),
    (2, ""),
    (3, "one two  three\n\n"),
    (4, "one two three "),
    (5, f"{LONG}\nfive"),
    (6, f"{LONG.upper()}\n{LONG}\nsix"),
    (7, LONG),
    (8, LONG.strip() + "\r"),
    (9, f"x\n{LONG}"),
    (10, " \t\n"),
    (11, "<|endoftext|> é 中文 \x1c 'll  " + "a" * 30_000),
    (12, "w " * 40_000),
    (13, "one two three"),
]


def frame(spark, texts):
    rows = [(i, t, "en" if i and i % 2 else "de", f"s{(i or 0) % 3}", 0, "k", "d", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def real(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def pairs_of(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


def picked(frame, *names):
    return rows_of(frame.select(*names))


def same(left, right):
    return sorted(left, key=repr) == sorted(right, key=repr)


@pytest.mark.parametrize("real_rows", [False, True])
def test_line_dedup(spark, real_rows):
    docs = real(spark) if real_rows else frame(spark, [*TEXTS, (None, LONG)])
    names = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert same(picked(line_dedup.dedup_lines(docs), *names), brute.line_dedup(pairs_of(docs)))


def test_line_dedup_over_partition_bounds(spark):
    """A common line fills many partitions, and other lines start and end in them."""
    docs = frame(spark, [(i, f"{LONG}\n{LONG}{i % 40}\nown {i}") for i in range(600)])
    docs = docs.repartition(6)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = picked(line_dedup.dedup_lines(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert same(rows, brute.line_dedup(pairs_of(docs)))


def test_line_dedup_tells_texts_of_one_id_apart(spark):
    docs = frame(spark, [*[(i, LONG) for i in range(6)], (2, f"a\n{LONG}"), (2, LONG)])
    found = line_dedup.dedup_lines(docs, with_text=True)
    assert same(
        [(i, t) for i, t in picked(found, "doc_id", "text") if i in (2, 5)],
        [(2, ""), (2, ""), (2, "a"), (5, LONG)],
    )


@pytest.mark.parametrize("real_rows", [False, True])
def test_exact_dedup(spark, real_rows):
    docs = real(spark) if real_rows else frame(spark, TEXTS)
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    expected = brute.exact_dedup(pairs_of(docs))
    found = exact_dedup.exact_dedup(docs.repartition(5), files_per_batch=2)
    assert same(picked(found, *names), expected)


def test_exact_dedup_compares_bytes_when_digests_collide(spark):
    docs = real(spark)
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    weak = exact_dedup.exact_dedup(docs, digest=lambda text: F.left(text, F.lit(1)))
    assert same(picked(weak, *names), brute.exact_dedup(pairs_of(docs)))


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    docs = frame(spark, [(1, "a"), (1, "a"), (None, "a"), (None, None), (2, "b")])
    found = exact_dedup.exact_dedup(docs)
    assert same(
        picked(found, "doc_id", "keep_id", "group_size", "kept"),
        [(1, 1, 3, True), (1, 1, 3, False), (None, 1, 3, False), (None, None, 1, True), (2, 2, 1, True)],
    )
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert same(picked(kept, "doc_id", "text"), [(1, "a"), (None, None), (2, "b")])


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    docs = real(spark)
    found = minhash.near_duplicates(docs, size)
    names = ("doc_id", "n_shingles", "component_id", "kept")
    assert same(picked(found, *names), brute.near_duplicates(pairs_of(docs), size))


def test_near_duplicates_in_large_families(spark):
    """Families whose members differ from each other by more than from their origin."""
    rng = np.random.default_rng(3)
    texts, number = [(1000, None), (1001, ""), (1002, "word"), (1003, "Word ")], 0
    for family in range(6):
        base = [f"f{family}w{k}" for k in range(60)]
        for _ in range(70):
            words = list(base)
            for place in rng.choice(60, 3 + family % 3, replace=False):
                words[place] = f"n{rng.integers(10**9)}"
            texts.append((number, " ".join(words)))
            number += 1
    docs = frame(spark, texts)
    found = minhash.near_duplicates(docs)
    names = ("doc_id", "n_shingles", "component_id", "kept")
    assert same(picked(found, *names), brute.near_duplicates(texts))


def test_units_of_an_open_bucket_hold_each_pair_across_components_once(spark):
    members = [(1, i, 0 if i < 40 else i) for i in range(52)] + [(2, i, i % 2) for i in range(6)]
    component = {(bucket, i): c for bucket, i, c in members}
    rows = spark.createDataFrame(members, "bucket bigint, id bigint, component bigint")
    laid, units = minhash._open_units(rows, 5).collect(), {}
    for row in laid:
        units.setdefault((row.bucket, row.low, row.high), []).append((row.part, row.id))
    met = [
        (bucket, min(x, y), max(x, y))
        for (bucket, low, high), own in units.items()
        for k, (p, x) in enumerate(own)
        for q, y in own[:k]
        if (low == high or p != q) and component[bucket, x] != component[bucket, y]
    ]
    wanted = {
        (b, min(x, y), max(x, y))
        for b, x, c in members
        for other, y, d in members
        if b == other and c != d
    }
    assert len(met) == len(set(met)) and set(met) == wanted
    # The 40 of the large component lie there once per part of the other 12.
    assert sum(r.bucket == 1 and r.id < 40 for r in laid) == 40 * 3


def test_near_duplicates_of_awkward_rows(spark):
    docs = frame(spark, [(None, "a b"), (3, "a b"), (1, "A\tb"), (1, "A\tb"), (2, None)])
    found = minhash.near_duplicates(docs)
    assert same(
        picked(found, "doc_id", "component_id", "kept"),
        [(None, None, True), (3, 1, False), (1, 1, True), (1, 1, True), (2, 2, True)],
    )
    kept = minhash.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 4


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(links, "a bigint, b bigint"))
    nodes = {n for a, b in links for n in (a, b)}
    assert same(rows_of(found), list(brute.components(nodes, links).items()))


def test_bpe_is_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    docs = frame(spark, TEXTS).unionByName(real(spark), allowMissingColumns=True)
    found = bpe.encode_decode(docs, VOCABULARY, with_ids=True)
    expected = []
    for doc_id, text in pairs_of(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed = np.array(ids, dtype="<u4").tobytes()
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append(
            (doc_id, len(ids), hashlib.sha256(packed).hexdigest(), brute.sha(decoded), decoded)
        )
        assert decoded == (text or "")
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded")
    assert same(picked(found, *names), expected)


def test_bpe_trees_agree():
    codec = bpe.Codec(bpe.read_vocabulary(VOCABULARY))
    words = ["", "a", "hello", "x" * 63, "zzzzqqqq", " internationalization", "中文字"]
    codec.learn(words[1:])
    for word in words[1:]:
        alone = codec.merge([codec.byte_ids[b] for b in word.encode()])
        assert codec.remembered[word] == np.array(alone, dtype="<u4").tobytes()


VECTORS = "vec_id bigint, label int, embedding array<float>, bucket string, id int"


def test_near_vectors(spark):
    rng = np.random.default_rng(11)
    rows, number = [], 0
    for label in (1, 2):
        for _ in range(8):
            base = rng.standard_normal(16)
            for _ in range(40):
                rows.append((number, label, (base + rng.standard_normal(16) * 0.12).tolist()))
                number += 1
    rows += [(number + k, 1, rows[0][2]) for k in range(5)]
    rows += [(9000, None, rows[0][2]), (9001, 1, None), (9002, 1, []), (9003, 1, [0.0] * 16)]
    rows += [(9004, 1, [float("nan")] * 16), (9005, 1, [None] * 16), (9006, 1, [1.0])]
    rows += [(9007, 2, (1e20 * np.array(rows[-8 - 330][2])).tolist())]
    frame = spark.createDataFrame([(*r, "b", 1) for r in rows], VECTORS)
    linked = [r for r in rows if r[0] < 9000 or r[0] == 9007]
    table = np.array([np.float32(r[2]) for r in linked], dtype=np.float64)
    norms = np.linalg.norm(table, axis=1)
    near = table @ table.T >= 0.98 * norms[:, None] * norms
    labels = np.array([r[1] for r in linked])
    near &= labels[:, None] == labels
    np.fill_diagonal(near, False)
    links = [(linked[a][0], linked[b][0]) for a, b in zip(*np.nonzero(near))]
    of = brute.components([r[0] for r in rows], links)
    degree = dict(zip((r[0] for r in linked), near.sum(axis=1).tolist()))
    expected = [(r[0], degree.get(r[0], 0), of[r[0]], of[r[0]] == r[0]) for r in rows]
    assert same(rows_of(embedding_dedup.near_vectors(frame)), expected)


def test_mixing(spark):
    docs = real(spark).unionByName(
        spark.createDataFrame([(None, "a b c", None), (1, "a b", None), (1, "a b", None), (2, None, "")],
                              "doc_id bigint, text string, source string"),
        allowMissingColumns=True,
    )
    rows = [r.asDict() for r in mixing.mix(docs).collect()]
    assert len(rows) == docs.count()
    sizes, taken, target = {}, {}, {}
    for row in rows:
        assert 0 <= row["taken"] <= 3 * row["size"]
        name = row["source"]
        sizes[name] = sizes.get(name, 0) + row["size"]
        taken[name] = taken.get(name, 0) + row["taken"]
        target[name] = row["target"]
    expected = brute.targets(sizes)
    for name in sizes:
        assert target[name] == pytest.approx(expected[name])
        assert abs(taken[name] - target[name]) <= 2 * mixing.BLOCK_WORDS
    again = [r.asDict() for r in mixing.mix(docs.repartition(3)).collect()]
    assert same(rows, again)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in mixed.collect())
    assert words == pytest.approx(sum(taken.values()), rel=0.15)


def test_seats_are_the_highest_quotients(spark):
    rng = np.random.default_rng(4)
    rows, expected = [], {}
    for group in range(4):
        values = (rng.random(7) ** 3 * 100).round(3).tolist()
        rows += [(group, k, v, 50, 10**6) for k, v in enumerate(values)]
        quotients = sorted((-v / (2 * s + 1), k) for k, v in enumerate(values) for s in range(60))
        for _, k in quotients[:50]:
            expected[group, k] = expected.get((group, k), 0) + 1
    items = spark.createDataFrame(rows, "g int, k int, value double, seats bigint, cap bigint")
    found = mixing.sainte_lague(items, ["g"], ["k"]).collect()
    assert {(r["g"], r["k"]): r["quota"] for r in found if r["quota"]} == expected


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = frame(spark, [(-1, None), (-2, "12 !?"), (-3, "")]).select(*docs.columns)
    rows = language.identify(docs.unionByName(odd)).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] < 0} == {"und"}
    held = [r for r in rows if r["held_out"] and r["doc_id"] >= 0]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_samples_are_bounded_where_ids_repeat(spark):
    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 5]
    hot, long = ids[0], ids[1]
    rows = [(k, f"text {k}") for k in ids[2:30]] + [(hot, f"hot {k:03}") for k in range(300)]
    rows += [(long, "long " * 100), (ids[2], None), (ids[3], "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = docs.select("doc_id", F.lit("x").alias("label"))
    # All ids fit, the hot one with one text; the long text is passed over.
    expected = [("x", "hot 000"), *(("x", f"text {k}") for k in ids[2:30])]
    assert same(samples.take_sample(marked, docs, 40, 400), expected)
    # The places are those of distinct ids.
    ten = samples.take_sample(marked, docs, 10, 4000)
    assert len(ten) == len(set(ten)) == 10
    assert samples.take_sample(marked, docs.where(f"doc_id = {long}"), 40, 400) == [("x", "long " * 100)]


def test_samples_start_no_python_rows_on_executors(spark, capsys):
    docs = spark.createDataFrame(real(spark).limit(50).toArrow())
    marked = docs.select("doc_id", F.lit("x").alias("label"))
    found = samples.sample_table(marked, docs, 40, 4000)
    assert 0 < found.count() <= 40
    capsys.readouterr()
    found.explain()
    assert "ExistingRDD" not in capsys.readouterr().out


def most_mib(work):
    """What ``work`` lays out at most, in MiB, and its result."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_large_batches_are_worked_through_in_parts():
    texts = [" ".join(f"w{k * j % 9973}" for j in range(400)) for k in range(5_000)]
    column = pa.array([*texts, None, ""])
    assert column.nbytes > 8_000_000
    model = toxicity.fit([*["vile thing"] * 9, *["fine thing"] * 9], [True] * 9 + [False] * 9)
    hits, most = most_mib(lambda: toxicity._toxic(model, column))
    assert hits.to_pylist() == (toxicity.score_texts(model, [t or "" for t in column.to_pylist()])[0] >= 0.5).tolist()
    assert most < 40
    ids = pa.array(range(len(column)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, column, pa.array([""] * len(column))], ["doc_id", "text", "text_key"])
    marks, most = most_mib(lambda: sum(b.num_rows for b in minhash._mark(5)([batch])))
    assert marks == len(column)
    assert most < 80


def test_memory_goes_back_when_a_task_ends(monkeypatch):
    calls = []
    monkeypatch.setattr(words, "give_back", lambda: calls.append(1))
    run = words.giving_back(lambda batches: (b + 1 for b in batches))
    assert list(run([1, 2])) == [2, 3] and calls == [1]
    monkeypatch.undo()
    words.give_back()


def test_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = toxicity.score(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id")
    held = found.where("held_out and toxic is not null").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.97
    hits = [r for r in held if r["toxic"] == 1]
    assert np.mean([r["predicted"] for r in hits]) > 0.85
    assert sum(bool(r["spans"]) for r in hits) > 0.8 * len(hits)


def test_toxicity_marginals_are_those_of_each_chain():
    rng = np.random.default_rng(0)
    lengths = [3, 0, 70, 200, 32, 33, 1]
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    unary, moves = rng.normal(0, 3, bounds[-1]), rng.normal(0, 1, (2, 2))
    chance, _ = toxicity.marginals(unary, bounds, moves)
    step = np.exp(moves)
    for start, end in zip(bounds[:-1], bounds[1:]):
        weight = np.stack((np.ones(end - start), np.exp(unary[start:end])), axis=1)
        ahead, state = [], np.array([0.5, 0.5])
        for w in weight:
            state = (state @ step) * w
            state /= state.sum()
            ahead.append(state)
        behind = np.ones(2)
        for t in reversed(range(end - start)):
            both = ahead[t] * behind
            assert chance[start + t] == pytest.approx(both[1] / both.sum())
            behind = step @ (weight[t] * behind)
            behind /= behind.sum()


def test_toxicity_spans_are_code_points(spark):
    bad = [f"ünd ça vile{k % 7} ok ok ok" for k in range(30)]
    model = toxicity.fit([*bad, *[f"ünd ça fine{k % 5} ok ok" for k in range(60)]], [True] * 30 + [False] * 60)
    scores, spans = toxicity.score_texts(model, ["é vile3!", "ok ok", ""])
    assert spans[0] == [(2, 7)] and spans[1] == [] and scores[0] >= 0.5 > scores[1]
    assert toxicity.score_texts(toxicity.fit([], []), ["a"])[0].tolist() == [0.0]


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}</body></html>"


def test_html_text(spark):
    menu = "<div class=x><a href=/>Home</a></div>"
    rows = [
        (1, "http://a.b/1", page(f"{menu}<article><h1>T&amp;1</h1><p>one\n two<p>b<br>c</article><footer>f</footer>")),
        (2, "http://a.b/2", page(f"{menu}<article><p>three<aside>no</aside><div class='comments'><p>hm</div></article>")),
        (3, "http://c.d/1", page(f"{menu}<div id=content><p>first text of some length</p></div>")),
        (4, "http://c.d/2", page(f"{menu}<div id=content><p>second text of some length</p></div>")),
        (5, "http://c.d/3", page(f"{menu}<div id=content><p>third text of some length</p><form><p>no</form></div>")),
        (6, None, None),
        (7, "nohost", ""),
        (8, "http://e.f/", "<article><p>cut off <b>here<script>var a = '<p>'"),
        (9, "http://e.g/", "a < b &lt;c <!-- no --> d <x"),
    ]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.main_text(pages).collect()}
    assert {k: v[0] for k, v in found.items()} == {
        1: "T&1\n\none two\n\nb c",
        2: "three",
        3: "first text of some length",
        4: "second text of some length",
        5: "third text of some length",
        6: "",
        7: "",
        8: "cut off here",
        9: "a < b <c d <x",
    }
    assert all(n == len(t) for t, n in found.values())


def html_rows(spark, bodies, host="a.b"):
    rows = [(k, f"http://{host}/{k}", page(body)) for k, body in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}


def test_html_text_compares_texts_within_articles(spark):
    stories = [f"story {k} " + f"{k} words of it " * 20 for k in range(6)]
    note = "<div class=x><p>We value you</p></div>"
    found = html_rows(spark, [f"<article>{note}<p>{s}</p><p>The end</p></article>" for s in stories])
    assert found == {k: s.strip() for k, s in enumerate(stories)}


def test_html_text_takes_the_slot_from_the_classes(spark):
    menu = "<div class=a>" + "".join(f"<p>Category number {k}</p>" for k in range(8)) + "</div>"
    stories = [f"story {k} " + f"{k} words of it " * 20 for k in range(5)]
    # Shared by most pages, without an element that comes and goes with it.
    passage = "<p>a passage that most pages quote</p>"
    bodies = [f"{menu}<div class=b><p>{s}</p>{passage if k else ''}</div>" for k, s in enumerate(stories)]
    found = html_rows(spark, bodies)
    assert found[0] == stories[0].strip()
    assert all(found[k] == f"{stories[k].strip()}\n\na passage that most pages quote" for k in range(1, 5))


def test_html_text_keeps_copies(spark):
    body, story = "<div id=content><p>the same story in full</p></div>", "the same story in full"
    assert html_rows(spark, [body, body]) == {0: story, 1: story}
    # A row given twice, beside others.
    rows = [(1, "http://a.b/1", page(body))] * 2 + [(2, "http://a.b/2", page("<div id=content><p>other</p></div>"))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert same(picked(html_text.main_text(pages), "page_id", "text"), [(1, story), (1, story), (2, "other")])


@pytest.mark.parametrize("others", [0, 4])
def test_html_text_keeps_near_copies(spark, others):
    shared = [f"paragraph {k} of a story that many pages hold" for k in range(6)]
    whole = "".join(f"<p>{t}</p>" for t in shared)
    bodies = [f"<div class=b><section>{whole}</section><p>edit {k}</p></div><div class=s>new {k}</div>" for k in range(4)]
    bodies += [f"<div class=b><p>{f'another {k} ' * 30}</p></div><div class=s>new {k}</div>" for k in range(4, 4 + others)]
    found = html_rows(spark, bodies)
    assert all("\n\n".join([*shared, f"edit {k}"]) in found[k] for k in range(4))
    assert all(f"another {k} " in found[k] for k in range(4, 4 + others))


def test_html_furniture_is_not_what_holds_the_article():
    def text(body, attributes=""):
        return html_text.extract(page(body).replace("<body>", f"<body{attributes}>"), None)

    story = "<article><p>the whole story of the page</p></article>"
    told = "the whole story of the page"
    assert text(story, " class=has-sidebar") == text(story, " class='home sidebar'") == told
    assert text(f"<div id=page class='with-banner banner'>{story}<div class=related>more</div></div>") == told
    assert text(story.replace("<article>", "<article class='post no-comments related'>")) == told
    assert text(f"<form action=/>{story}<fieldset>ask</fieldset></form>") == told
    assert text("<form><section class=skip-link><p>the whole story of the page</p></section></form>") == told
    assert told in text(f"<div class=widget>{story}</div><div class=related>{story}</div><p>home</p>")
    # Furniture stays furniture beside an article, and in part of a page's text.
    comments = f"<div class=comments><article>{'long comment ' * 9}</article></div>"
    assert text(f"{story}{comments}<form>ask for a letter</form>") == told
    assert text(f"<div class=b><p>{told}</p></div><div class=related>more</div>") == told


def test_html_skips_only_the_tag_of_what_has_no_end():
    def text(body):
        return html_text.extract(page(f"<article><p>one {body}<p>two</article>"), None)

    for tag in ("<svg class=i />", "<svg/>", "<iframe src='x'/>", "<select>", "<noscript>", "<select><select>"):
        assert text(tag) == "one\n\ntwo"
    assert text("<svg/> and <svg><text>no</text></svg>") == "one and\n\ntwo"
    assert text("<iframe src=http://x.y/>no</iframe>") == text("<SELECT><option>no</SELECT>") == "one\n\ntwo"
    assert text("<script>no") == text("<style/>no") == "one"


def test_html_template_leaves_out_what_changes_places():
    def member(token, vector, least=0, most=0, mass=0, varying=0):
        return dict(token=token, vector=vector, least=least, most=most, mass=mass, varying=varying)

    fixed = [member("", 1), member("/div", 1, 1, 1, 90, 50), member("/p.x", 2, 0, 0, 500, 400)]
    moved = [member("/div/ul", 1, 2, 3, 60, 50), member("/div\nt", 1, 4, 4), member("/div\nu", 3)]
    assert html_text.deduce(fixed + moved) == ("/div", {"/div\nt"})


def test_html_text_of_the_table(spark):
    import html

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    expected = []
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.S).group(1)
        blocks = [re.sub(r"<[^>]*>", " " if "<br>" in b else "", b) for b in re.split(r"</?(?:p|h1)>", article)]
        blocks = [re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(b)).strip(" ") for b in blocks]
        expected.append((row["page_id"], "\n\n".join(b for b in blocks if b)))
    assert same(picked(html_text.main_text(pages), "page_id", "text"), expected)


def test_url_filter(spark):
    rows = [
        (1, "https://A.example.NET/en/x?q#f"),
        (2, "http://example.net/de/"),
        (3, "http://net"),
        (4, "http://x.example.com/de/1"),
        (5, "http://example.com/d"),
        (6, "http://some.org/fr/a"),
        (7, None),
        (8, "no scheme"),
        (9, "http://bad.test/a"),
        (10, "http://u@x.co.uk:80/p"),
    ]
    rows += [(100 + k, f"http://bad.test/{k}") for k in range(40)]
    rows += [(200 + k, f"http://good{k % 9}.example/{k}") for k in range(60)]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id bigint, url string, rate string")
    marks = [(100 + k, 0) for k in range(40)] + [(200 + k, 1) for k in range(60)] + [(None, 0), (1, None)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    found = {r["page_id"]: r for r in url_filter.judge(pages, labels).collect()}
    told = {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in found.items() if k < 100}
    assert told[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert told[2] == ("example.net", "/de/", "net/", "block")
    assert told[3][:3] == ("net", "", None)
    assert told[4] == ("x.example.com", "/de/1", "example.com/de/", "block")
    assert told[5][2] is None
    assert told[6] == ("some.org", "/fr/a", "org/fr/", "allow")
    assert told[7][:3] == told[8][:3] == ("", "", None)
    assert told[9][3] == "block"
    assert {found[k]["verdict"] for k in found if k >= 200} == {"allow"}
    assert found[10]["host"] == "u@x.co.uk:80" and len(found) == len(rows)


@pytest.mark.parametrize(
    "operator",
    [
        line_dedup.dedup_lines,
        exact_dedup.exact_dedup,
        exact_dedup.kept_documents,
        minhash.near_duplicates,
        minhash.kept_documents,
        mixing.mix,
        mixing.mixed_documents,
        language.identify,
        lambda docs: bpe.encode_decode(docs, VOCABULARY),
        lambda docs: toxicity.score(docs, docs.selectExpr("doc_id", "1 as toxic")),
        lambda docs: toxicity.clean_documents(docs, docs.selectExpr("doc_id", "1 as toxic")),
    ],
)
def test_empty_tables(spark, operator):
    assert operator(frame(spark, [])).count() == 0


def test_empty_tables_of_pages_and_vectors(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    vectors = spark.createDataFrame([], VECTORS)
    assert html_text.main_text(pages).count() == 0
    assert url_filter.judge(pages, labels).count() == 0
    assert embedding_dedup.near_vectors(vectors).count() == 0


def _near_texts():
    words = [f"w{i}" for i in range(60)]
    one, other = " ".join(words), " ".join(f"v{i}" for i in range(60))
    return one, other, " ".join([*words[:30], "changed", *words[31:]])


def _grouped(rows, linked):
    """The smallest id reachable, for rows ``(id, content)``: equal ids and linked contents are joined."""
    links = [
        (a, b) for a, x in rows for b, y in rows if a is not None and b is not None and linked(x, y)
    ]
    return brute.components({i for i, _ in rows if i is not None}, links)


@pytest.mark.parametrize("turn", range(4))
def test_minhash_of_an_id_with_several_texts(spark, turn):
    a, b, near_a = _near_texts()
    rows = [(1, a), (1, b), (9, b), (20, near_a), (30, "alone x y"), (1, a), (9, b)]
    rows = rows[turn:] + rows[:turn] if turn < 3 else [(i, {a: b, b: a}.get(t, t)) for i, t in rows]
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string").repartition(3)

    def linked(x, y):
        s, t = brute.shingles(x, 2), brute.shingles(y, 2)
        return 100 * len(s & t) >= 80 * len(s | t)

    of = _grouped(rows, linked)
    found = minhash.near_duplicates(docs).select("doc_id", "component_id", "kept").collect()
    assert sorted(map(tuple, found)) == sorted((i, of[i], of[i] == i) for i, _ in rows)


@pytest.mark.parametrize("turn", range(4))
def test_vectors_of_an_id_with_several_contents(spark, turn):
    rng = np.random.default_rng(4)
    a, b = (rng.normal(size=16).round(3).tolist() for _ in range(2))
    near_a = [x + 0.001 for x in a]
    rows = [(1, a), (1, b), (9, b), (20, near_a), (30, [-x for x in a]), (1, a)]
    rows = rows[turn:] + rows[:turn] if turn < 3 else [(i, b if v is a else a if v is b else v) for i, v in rows]
    frame = spark.createDataFrame([(i, 0, v) for i, v in rows], "vec_id bigint, label int, embedding array<double>")

    def linked(x, y):
        x, y = np.array(x), np.array(y)
        return x @ y >= 0.98 * np.sqrt((x @ x) * (y @ y))

    of = _grouped(rows, linked)
    contents = {(i, tuple(v)) for i, v in rows}
    expected = [
        (i, sum(linked(v, w) for j, w in contents if (j, w) != (i, tuple(v))), of[i], of[i] == i)
        for i, v in rows
    ]
    found = embedding_dedup.near_vectors(frame).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_sample_is_ranked_in_parts(spark):
    """No task sorts all ids of a label; the first ids by the hash are taken all the same."""
    marked = spark.range(4000).selectExpr("id as doc_id", "cast(id % 2 as int) as label")
    found = samples._first_ids(marked, 1500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= 2 and "part" in plan
    usable = marked.where(~samples.held_out(F.col("doc_id"))).withColumn(
        "spot", F.xxhash64(F.lit(samples.SEED), "doc_id")
    )
    for label in (0, 1):
        own = usable.where(F.col("label") == label).orderBy("spot", "doc_id").limit(1500)
        assert rows_of(found.where(F.col("label") == label).select("doc_id")) == rows_of(own.select("doc_id"))


def test_spans_of_a_very_long_text_take_linear_time(spark):
    import time

    texts = ["you are a stupid idiot and a fool", "a calm clean day at the sea"] * 40
    model = toxicity.fit(texts, [i % 2 == 0 for i in range(len(texts))])
    long = "stupid clean " * 250_000
    start = time.perf_counter()
    _, (spans,) = toxicity.score_texts(model, [long])
    assert time.perf_counter() - start < 60
    assert spans == [(0, len(long) - 1)]


MENU = "<div class=m>" + "".join(f"<p>Section {k} of our shop sells things of kind {k}</p>" for k in range(8)) + "</div>"


@pytest.mark.parametrize("count", [2, 3, 6])
def test_html_menu_longer_than_the_article(spark, count):
    stories = [f"short story number {k} has some nine words {k * k}" for k in range(count)]
    for wrap in ("<div class=b><p>{}</p></div>", "<section><div><p>{}</p></div></section>"):
        found = html_rows(spark, [MENU + wrap.format(s) for s in stories], host=f"h{count}.x")
        assert found == dict(enumerate(stories))


def test_html_pages_that_differ_by_a_date_keep_their_article(spark):
    story = "".join(f"<p>paragraph {k} of the only article on this host</p>" for k in range(4))
    found = html_rows(spark, [f"<div class=b>{story}</div><div class=d>day {k}</div>" for k in range(3)])
    assert all("paragraph 3 of the only article on this host" in text for text in found.values())


def test_html_sections_of_an_article_keep_their_names():
    body = (
        "<article><p>first</p><div class=related><p>Real section</p></div><section id=search><p>On search</p></section>"
        "<div class=ad><p>buy</p></div><div class=comments><p>hm</p></div></article><div class=related><p>more</p></div>"
    )
    assert html_text.extract(page(body), None) == "first\n\nReal section\n\nOn search"


def test_html_against_a_plain_reading_without_articles(spark):
    """Pages of several hosts, menu and footer in plain elements: what only one page of a host has is its article."""
    rng = np.random.default_rng(8)
    words = np.array("alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
    rows, expected = [], []
    for host in range(4):
        top = "".join(f"<p>host {host} menu {k}</p>" for k in range(int(rng.integers(1, 9))))
        for k in range(int(rng.integers(2, 7))):
            own = [f"h{host} p{k} t{n} " + " ".join(rng.choice(words, 9)) for n in range(int(rng.integers(1, 5)))]
            body = f"<div class=t><ul>{top}</ul></div><div class=c>{''.join(f'<p>{t}</p>' for t in own)}</div><div class=z><p>host {host} end</p></div>"
            rows.append((len(rows), f"http://h{host}.x/{k}", page(body)))
            expected.append((len(expected), "\n\n".join(own)))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert same(picked(html_text.main_text(pages), "page_id", "text"), expected)
