"""Budgets, subset sums and the mix as a whole."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights, share, repeats):
    """Share, stop at the cap, share the excess again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, out, open_ = share * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while budget > 1e-9 and open_:
        total, excess = sum(weight[s] for s in open_), 0.0
        for s in sorted(open_, key=names.index):
            out[s] += budget * weight[s] / total
        for s in list(open_):
            if out[s] >= repeats * sizes[s]:
                excess += out[s] - repeats * sizes[s]
                out[s] = repeats * sizes[s]
                open_.discard(s)
        budget = excess
    return out


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 300), st.integers(1, 30), min_size=1, max_size=25), st.floats(0, 1), st.sampled_from([1, 64, 1 << 16]))
def test_fit(classes, part, exact):
    sizes, counts = np.array(list(classes)), np.array(list(classes.values()))
    budget = int(part * (sizes * counts).sum())
    taken = mixing.fit(sizes, counts, budget, exact)
    assert ((taken >= 0) & (taken <= counts)).all()
    words = int((sizes * taken).sum())
    if exact == 1 << 16:
        assert abs(budget - words) < sizes.max()
    if exact == 1 << 16 and classes.get(1, 0) >= 30:
        assert words == budget


def check(session, docs, **options):
    rows = mixing.mix(docs, **options).collect()
    again = mixing.mix(docs, **options).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(rows, key=key) == sorted(again, key=key)
    given_ = docs.collect()
    assert len(rows) == len(given_)
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted(str((r.doc_id, size(r.text))) for r in given_) == sorted(str((r.doc_id, r.size)) for r in rows)
    sizes = {}
    for r in given_:
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    want = plain_targets(sizes, (3, 1, 2), 1.5, 2)
    place = {}
    for r in given_:
        place.setdefault((r.doc_id, size(r.text)), []).append(r.source)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        source = next(s for s in place[(r.doc_id, r.size)] if sizes[s] == r.source_size)
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    return want, taken


def test_given_documents(session, documents):
    want, taken = check(session, documents)
    for source, goal in want.items():
        assert abs(taken[source] - goal) <= max(2, 0.01 * goal), source


def test_fit_finds_the_nearest_sum():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sizes = np.unique(rng.integers(1, 60, 5))
        counts = rng.integers(1, 4, len(sizes))
        budget = int(rng.integers(0, (sizes * counts).sum()))
        sums = {0}
        for z, c in zip(sizes, counts):
            sums = {t + k * int(z) for t in sums for k in range(c + 1)}
        base = int((sizes * (counts * budget // int((sizes * counts).sum()))).sum())
        got = int((sizes * mixing.fit(sizes, counts, budget)).sum())
        best = min(abs(t - budget) for t in sums)
        assert abs(got - budget) >= best
        if base == 0:
            assert abs(got - budget) == best


def test_odd_documents(session, odd_documents, no_documents):
    want, taken = check(session, odd_documents)
    assert set(taken) == set(want)
    assert mixing.mix(no_documents).isEmpty()
    repeated = mixing.repeat(odd_documents)
    assert repeated.columns == odd_documents.columns
    rows = mixing.mix(odd_documents).collect()
    assert repeated.count() == sum(r.copies for r in rows)
    assert mixing.repeat(no_documents).isEmpty()
