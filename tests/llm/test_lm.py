"""The backoff automaton against a plain n-gram model over strings."""

import math
import re
import zlib
from collections import Counter

import pytest

from matchlake.llm import backoff_lm
from matchlake.llm.queries import op7_backoff_lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
END = None


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), END]


class Plain:
    """Counts as dictionaries, probabilities by recursion."""

    def __init__(self, texts, order, share):
        grams = [Counter() for _ in range(order + 1)]
        for t in map(tokens, texts):
            for n in range(1, order + 1):
                grams[n].update(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
        self.n, self.v = sum(grams[1].values()), len(grams[1])
        least = max(2, math.ceil(share * self.n))
        self.counts = [None, grams[1]] + [Counter({g: c for g, c in grams[n].items() if c >= least}) for n in range(2, order + 1)]
        self.order, self.below = order, {}
        self.arcs = {}
        for n in range(2, order + 1):
            for g in self.counts[n]:
                self.arcs.setdefault(g[:-1], []).append(g[-1])

    def base(self, w):
        return (self.counts[1][(w,)] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def p(self, context, w):
        if not context:
            return self.base(w)
        if context not in self.arcs:
            return self.p(context[1:], w)
        gram = (*context, w)
        of = self.counts[len(context)][context]
        if gram in self.counts[len(gram)]:
            return (self.counts[len(gram)][gram] - backoff_lm.DISCOUNT) / of
        if context not in self.below:
            kept = sum((self.counts[len(gram)][(*context, x)] - backoff_lm.DISCOUNT) / of for x in self.arcs[context])
            lower = sum(self.p(context[1:], x) for x in self.arcs[context])
            self.below[context] = max(1 - kept, 1e-12) / max(1 - lower, 1e-12)
        return self.below[context] * self.p(context[1:], w)

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.p(tuple(t[max(0, i - self.order + 1):i]), w)) for i, w in enumerate(t))


@pytest.mark.parametrize("which", ["odd_documents", "documents"])
@pytest.mark.parametrize("share, per_chunk", [(1e-4, 1 << 20), (2e-3, 500)])
def test_scores(which, share, per_chunk, request):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    plain = Plain([t for d, t in rows if not held(d)], 3, share)
    from matchlake.llm.language_id import held_out

    model = backoff_lm.train(docs.filter(~held_out("doc_id", 5, 1)), 3, share, per_chunk)
    got = backoff_lm.score(docs, model, per_chunk).collect()
    assert (model.total, model.distinct) == (plain.n, plain.v)
    want = {}
    for d, t in rows:
        toks = tokens(t)
        want.setdefault(d, []).append((len(toks), sum(plain.counts[1][(w,)] > 0 for w in toks),
                                       sum(math.log10(plain.base(w)) for w in toks), plain.score(t)))
    assert len(got) == len(rows)
    for d, expected in want.items():
        actual = sorted((r.n_tokens, r.n_known, r.base_score, r.score) for r in got if r.doc_id == d)
        for a, e in zip(actual, sorted(expected), strict=True):
            assert a == pytest.approx(e, rel=1e-6, abs=1e-6)


def test_probabilities_sum_to_one(documents):
    texts = [r.text for r in documents.collect()]
    plain = Plain(texts, 3, 1e-3)
    for context in [(), *list(plain.arcs)[:5]]:
        total = sum(plain.p(context, w) for (w,) in plain.counts[1]) + plain.p(context, "never seen")
        assert total == pytest.approx(1, abs=1e-3)


def test_model_beats_the_base_on_held_out_texts(session):
    got = op7_backoff_lm(session, "/root/testdata/sf0.01").toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_without_training_texts(session, odd_documents, no_documents):
    model = backoff_lm.train(no_documents)
    rows = backoff_lm.score(odd_documents, model).collect()
    assert {(r.n_known, r.score, r.base_score) for r in rows} == {(0, 0.0, 0.0)}
    assert backoff_lm.score(no_documents, backoff_lm.train(odd_documents)).isEmpty()


@pytest.mark.parametrize("per_chunk", [1 << 20, 3000])
def test_repeated_ngrams_are_arcs_at_every_size(session, per_chunk):
    """What occurs twice is an arc, however many tokens there are, and however many of them a chunk holds."""
    filler = [" ".join(f"w{i * 7 % 101} v{i * 11 % 89}" for i in range(k, k + 25_000)) for k in range(0, 250_000, 25_000)]
    rare = [f"a{k} b{k} c{k} d{k % 5}" for k in range(50)] * 2 + [f"a{k} b{k} only{k}" for k in range(50)]
    asked = ["a3 b3 c3 d3", "a3 b3 w7", "never a4 b4 c4", "w7 v11 w14", "", None]
    rows = list(enumerate([*filler, *rare]))
    training = session.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plain = Plain([t for _, t in rows], 3, 0)
    model = backoff_lm.train(training, per_chunk=per_chunk)
    wanted = session.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: r for r in backoff_lm.score(wanted, model, per_chunk).collect()}
    assert model.total > 500_000 and len(got) == len(asked)
    for i, t in enumerate(asked):
        known = sum(plain.counts[1][(w,)] > 0 for w in tokens(t))
        base = sum(math.log10(plain.base(w)) for w in tokens(t))
        assert (got[i].n_known, got[i].base_score, got[i].score) == pytest.approx((known, base, plain.score(t)), rel=1e-6)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_long_text_in_lanes(session, order):
    """A text of many lanes, whose state must not be lost where it is cut; models of other orders."""
    text = " ".join(f"t{i * i % 37} u{i * 5 % 11}" for i in range(2000))
    training = session.createDataFrame([(1, text), (2, text[:3000]), (3, "t1 u5")], "doc_id long, text string")
    plain = Plain([r.text for r in training.collect()], order, 0)
    model = backoff_lm.train(training, order, per_chunk=700)
    asked = {1: text, 2: "new " + text[100:9000] + " t4 never t9 u1", 3: None}
    got = backoff_lm.score(session.createDataFrame(list(asked.items()), "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.score for r in got} == pytest.approx({d: plain.score(t) for d, t in asked.items()}, rel=1e-6)
