"""Plain versions of the operators, row by row, for comparison on small tables."""

import hashlib
import re
from collections import defaultdict

BLANKS = " \t\n\x0b\x0c\r"
_LOWER = {u: u + 32 for u in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def line_dedup(docs):
    """``doc_id, n_lines, n_dropped, kept_sha256`` of ``(doc_id, text)`` with distinct ids."""

    def key(line):
        return line.strip(BLANKS).translate(_LOWER)

    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    rows = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if len(key(line)) < 40
            or len(holders[key(line)]) < 5
            or doc_id == max(holders[key(line)], key=lambda i: (i is not None, i))
        ]
        rows.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return rows


def exact_dedup(docs):
    """``doc_id, keep_id, group_size, kept, text_sha256`` of ``(doc_id, text)`` with distinct ids."""
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    return [
        (i, min(ids), len(ids), i == min(ids), sha(norm)) for norm, ids in groups.items() for i in ids
    ]


def components(nodes, links):
    """The smallest node reachable from each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_duplicates(docs, size=2):
    """``doc_id, n_shingles, component_id, kept`` of ``(doc_id, text)`` with distinct ids."""
    sets = {i: shingles(t, size) for i, t in docs}
    holders = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for x, a in enumerate(ids):
            for b in ids[x + 1 :]:
                shared[min(a, b), max(a, b)] += 1
    links = [
        (a, b)
        for (a, b), n in shared.items()
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)
    ]
    of = components(sets, links)
    return [(i, len(s), of[i], of[i] == i) for i, s in sets.items()]


def targets(sizes, weights=(1, 2, 3)):
    """Target per source: shares by weight, the excess over three times a source's size reshared."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [n for n in names if n not in full]
        left = total - sum(full.values())
        share = {n: left * weight[n] / sum(weight[m] for m in rest) for n in rest}
        over = [n for n in rest if share[n] > 3 * sizes[n]]
        if not over:
            return {**share, **full}
        full.update({n: 3.0 * sizes[n] for n in over})
