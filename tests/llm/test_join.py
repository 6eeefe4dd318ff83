"""n-gram Jaccard classes against all pairs."""

import random
import re

import numpy as np
import pytest

from matchlake.llm import ngram_join
from matchlake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, n, percent):
    """Sorted (doc_id, set size, smallest linked doc_id) by comparing all pairs of texts."""
    sets = {i: shingles(t, n) for i, (_, t) in enumerate(rows)}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    ids = {i: ("row", i) if d is None else d for i, (d, _) in enumerate(rows)}
    nodes = list(sets)
    for a in nodes:
        root(ids[a])
        for b in nodes[:a]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(ids[a])] = root(ids[b])
    least = {}
    for i in nodes:
        if not isinstance(ids[i], tuple):
            r = root(ids[i])
            least[r] = min(least.get(r, ids[i]), ids[i])
    return sorted(map(str, ((d, len(sets[i]), least.get(root(ids[i])) if sets[i] else d) for i, (d, _) in enumerate(rows))))


def row_classes(rows, n, percent):
    """Lists of the numbers of rows that are linked, directly, by others, or by their doc_id; a row without words is alone."""
    sets = [shingles(t, n) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            same = rows[a][0] is not None and rows[a][0] == rows[b][0]
            if x and y and (same or 100 * len(x & y) >= percent * len(x | y)) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if v == old else v for v in label]
    return [[i for i, v in enumerate(label) if v == c] for c in sorted(set(label))]


@pytest.mark.parametrize("which", ["odd_documents", "documents", "no_documents"])
@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_classes(which, n, percent, request):
    docs = request.getfixturevalue(which)
    got = ngram_join.ngram_classes(docs, n, percent, block=2000).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute([(r.doc_id, r.text) for r in docs.collect()], n, percent)


def mutated(seed, copies):
    """Chains of near copies around the threshold."""
    rng = random.Random(seed)
    rows, words = [], [f"v{rng.randrange(400)}" for _ in range(80)]
    for i in range(copies):
        if i % 12 == 0:
            words = [f"v{rng.randrange(400)}" for _ in range(rng.randrange(1, 90))]
        copy = list(words)
        for _ in range(rng.randrange(0, 4)):
            copy[rng.randrange(len(copy))] = f"m{rng.randrange(30)}"
        rows.append((i, " ".join(copy)))
        if rng.random() < 0.4:
            words = copy
    return rows


def test_near_copies_at_the_threshold(session):
    rows = mutated(5, 300)
    docs = session.createDataFrame(rows, "doc_id long, text string")
    for block in (1_000_000, 700):  # whole groups, and groups in blocks
        got = ngram_join.ngram_classes(docs, 3, 90, block=block).collect()
        assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(rows, 3, 90)


def test_derived_answers_equal_direct_ones():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 40, 200).astype(np.uint64))
    sets = []
    for k in range(60):
        keep = base[rng.random(len(base)) > rng.random() * 0.2]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 50, k % 7).astype(np.uint64)])))
    index = ngram_join.IndexBlock(sets, 80)
    answered = []
    for s in sets:
        numbers = index.numbers(s)
        vector = ngram_join._answer(index, numbers[numbers >= 0], answered)
        assert vector.tolist() == [len(np.intersect1d(s, t)) for t in sets]
        linked = {i for i, t in enumerate(sets) if 100 * vector[i] >= 80 * (len(s) + len(t) - vector[i])}
        assert linked <= set(index.candidates(numbers).tolist())


def test_components(session):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7), (200, 201), (201, 200)]
    got = components(session.createDataFrame(edges, "a long, b long")).collect()
    want = {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert {r.node: r.component for r in got} == want
    assert len(got) == len(want)
    assert components(session.createDataFrame([], "a long, b long")).count() == 0
