"""Centroid clusters and whitening against plain Python and numpy."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import pivot_clusters, whitening
from matchlake.llm.pivot_clusters import Centroids, far_apart, to_pivots
from matchlake.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, distance string, x string, place string"


def table(session, rows):
    return session.createDataFrame([(i, v, 1, "c", "d", "x", "p") for i, v in rows], VECTORS)


@pytest.fixture(scope="module")
def given_vectors(session):
    frame = session.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    return [(r.vec_id, list(r.embedding)) for r in frame.collect()]


def odd(given_vectors):
    """Nulls, other lengths, values that are no numbers, repeated rows and ids, a large group of copies."""
    copies = [(9000 + i, given_vectors[0][1]) for i in range(150)]
    return given_vectors + copies + [
        (1, None), (2, []), (3, [1.0] * 63), (4, [None] + [0.5] * 63), (5, [float("nan")] + [0.5] * 63),
        (6, [float("-inf")] * 64), (None, [0.25] * 64), (7, [-0.5] * 64), (7, [-0.5] * 64), (7, [0.125] * 64)]


def usable(rows, dims=64):
    return [(i, v) for i, v in rows if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]


def ints(rows):
    return np.array([[int(np.floor(64 * float(c))) for c in v] for _, v in rows], np.int64).reshape(-1, 64)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-6, 6)] * 3), min_size=1, max_size=30), st.lists(st.tuples(*[st.integers(-6, 6)] * 3), min_size=1, max_size=6), st.integers(1, 4))
def test_nearest_with_ties(vectors, centroids, pivots):
    x, c = np.array(vectors, np.int64), np.array(centroids, np.int64)
    fixed = far_apart(x, pivots)
    label, best, exact = Centroids(c, to_pivots(c, fixed)).nearest(x, to_pivots(x, fixed))
    plain = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert label.tolist() == plain.argmin(axis=1).tolist() and best.tolist() == plain.min(axis=1).tolist()
    assert len(x) <= exact <= plain.size


def test_bounds_leave_centroids_out():
    rng = np.random.default_rng(3)
    c = rng.integers(-1000, 1000, (20, 8))
    x = c[rng.integers(0, 20, 2000)] + rng.integers(-30, 30, (2000, 8))
    fixed = far_apart(c, 6)
    _, _, exact = Centroids(c, to_pivots(c, fixed)).nearest(x, to_pivots(x, fixed))
    assert exact < 2000 * 20 / 4


def brute_clusters(rows, k=16, rounds=3):
    rows = usable(rows)
    x = ints(rows)
    key = lambda i: (rows[i][0] is None, hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest(), x[i].tolist())
    c = x[sorted(range(len(rows)), key=key)[:k]]
    for at in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        label = d.argmin(axis=1)
        if at < rounds:
            c = np.array([x[label == j].sum(axis=0) // (label == j).sum() if (label == j).any() else c[j] for j in range(len(c))])
    best = d.min(axis=1)
    return sorted(((str(i), int(j), int(b), int(best[label == j].sum()), int(best.sum()),
                    hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for (i, _), j, b in zip(rows, label, best)))


@pytest.mark.parametrize("which", ["given", "odd", "few"])
def test_clusters(session, given_vectors, which):
    rows = {"given": given_vectors, "odd": odd(given_vectors), "few": odd(given_vectors)[-4:]}[which]
    got = pivot_clusters.with_inertia(*pivot_clusters.cluster(table(session, rows).repartition(4)))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_clusters(rows)


def test_no_vectors(session):
    got = pivot_clusters.with_inertia(*pivot_clusters.cluster(table(session, [(1, None)])))
    assert got.collect() == []
    assert whitening.whiten(table(session, [(1, None), (2, [])])).collect() == []


@pytest.mark.parametrize("which", ["given", "odd"])
def test_whitening(session, given_vectors, which):
    rows = {"given": given_vectors, "odd": odd(given_vectors)}[which]
    got = whitening.whiten(table(session, rows).repartition(4)).collect()
    rows = usable(rows)
    x = ints(rows) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    off = [[n * int(v) - int(s) for v, s in zip(row, total)] for row in x]
    centred = np.array(off) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1][:, :32]
    z = centred @ axes / np.sqrt(values[:32])
    assert len(got) == 32 * n and {r.n for r in got} == {n}
    deviation = sorted(sum(d * d for d in row) for row in off)
    assert sorted(r.deviation for r in got if r.component == 1) == deviation
    assert {r.identity_error for r in got} == {got[0].identity_error} and 0 <= got[0].identity_error < 1e-9
    for k in range(32):
        mine = [r for r in got if r.component == k + 1]
        assert all(abs(r.explained - values[k] / values.sum()) < 1e-9 for r in mine)
        a, b = sorted(r.whitened for r in mine), sorted(z[:, k])
        flipped = sorted(-z[:, k])
        assert np.allclose(a, b, atol=1e-6) or np.allclose(a, flipped, atol=1e-6)
    one = next(i for i, (d, _) in enumerate(rows) if d == 10)
    mine = sorted((r for r in got if r.vec_id == 10), key=lambda r: r.component)
    assert np.allclose(np.abs([r.whitened for r in mine]), np.abs(z[one]), atol=1e-6)


def test_whitening_without_variance(session):
    got = whitening.whiten(table(session, [(1, [0.5, 1.0]), (2, [0.5, 2.0]), (3, [1.0])])).collect()
    assert sorted((r.vec_id, r.component, abs(r.whitened), r.explained) for r in got) == [
        (1, 1, 1.0, 1.0), (1, 2, 0.0, 0.0), (2, 1, 1.0, 1.0), (2, 2, 0.0, 0.0)]
    assert got[0].identity_error == 1.0
    same = whitening.whiten(table(session, [(1, [0.5])])).collect()
    assert [(r.whitened, r.explained, r.deviation) for r in same] == [(0.0, 0.0, 0)]


def test_queries(session):
    assert {"op11_pivot_clusters", "op12_block_whitening"} <= set(QUERIES)
