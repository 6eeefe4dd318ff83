"""Language identification: held-out accuracy and edge cases; the code matrix."""

import math
import zlib
from collections import Counter

import numpy as np

from matchlake.llm import language_id
from matchlake.llm.queries import op3_language_id


def test_held_out_accuracy(session):
    got = op3_language_id(session, "/root/testdata/sf0.01").toPandas()
    truth = session.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert (held.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4) == 2).all()
    assert len(held) > 150
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert both.score.between(0, 1).all()


def test_edge_cases(session, odd_documents, no_documents):
    model = language_id.train(odd_documents)
    rows = language_id.predict(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert letters or r.score == 0
    assert language_id.train(no_documents) is None
    assert language_id.predict(no_documents, model).isEmpty()
    untrained = language_id.predict(odd_documents, None)
    assert {r.lang_pred for r in untrained.collect()} == {"und"}
    one = language_id.train(odd_documents.filter("lang = 'de'"))
    assert {r.lang_pred for r in language_id.predict(odd_documents, one).collect()} == {"und", "de"}


def test_counts_against_plain_python():
    import pyarrow as pa

    texts = ["abAB", "", "xy", "é", None, "abcabc"]
    label = np.array([0, 0, 1, 1, 0, 1])
    got = language_id.count_grams(pa.array(texts), label, 2)
    want = np.zeros_like(got)
    for text, c in zip(texts, label):
        raw = np.frombuffer((text or "").lower().encode(), np.uint8)
        for o, order in enumerate(language_id.ORDERS):
            np.add.at(want[c, o], language_id.grams(raw, order), 1)
    assert (got == want).all()


def test_codewords_differ():
    for classes in (2, 3, 4, 7, 8, 40):
        codes = language_id.codewords(classes)
        apart = (codes[:, None] != codes[None]).sum(axis=2) + np.eye(classes, dtype=int) * 99
        assert apart.min() >= max(1, codes.shape[1] // 4)
        assert (np.abs(codes.sum(axis=0)) < classes).all()


def test_ambiguous_texts_are_flagged():
    model = language_id.CodeModel(["a", "b"], np.ones((2, 3, 1 << language_id.BITS)))
    _, score, unsure = model.predict(np.array([[0.0], [3.0]]), 0.05)
    assert unsure.tolist() == [True, False]
    assert score[0] == 0.5 and score[1] > 0.9


def plain_prediction(train, text):
    """Language and score, worked out gram by gram. ``train``: pairs of text and language."""
    def cells(t):
        raw = "".join(c.lower() if c.isascii() else c for c in t).encode()
        for order in (2, 3, 4):
            for i in range(len(raw) - order + 1):
                code = int.from_bytes(raw[i:i + order], "big")
                yield order, code if order == 2 else (code * 0x9E3779B1 % 2**32) >> 16

    languages = sorted({lang for _, lang in train})
    share = {}
    for lang in languages:
        counts = Counter(c for t, x in train if x == lang for c in cells(t))
        share[lang] = {c: n / sum(counts.values()) for c, n in counts.items()}
    splits = range(1 << (len(languages) - 1), (1 << len(languages)) - 1)
    code = {lang: [1 if s >> k & 1 else -1 for s in splits] for k, lang in enumerate(languages)}

    def margin(t, b):
        total, n = 0.0, 0
        for c in cells(t):
            side = {s: sum(share[x].get(c, 0.0) for x in languages if code[x][b] == s) for s in (1, -1)}
            mass = {s: sum(code[x][b] == s for x in languages) for s in (1, -1)}
            total, n = total + math.log((side[1] / mass[1] + 1e-8) / (side[-1] / mass[-1] + 1e-8)), n + 1
        return total / max(n, 1)

    bits, loss = range(len(splits)), {}
    m = [margin(text, b) for b in bits]
    for lang in languages:
        own = [[margin(t, b) for b in bits] for t in {t for t, x in train if x == lang}]
        weight = [max(sum(np.sign(o[b]) == code[lang][b] for o in own) / len(own) - 0.5, 0.01) for b in bits]
        loss[lang] = sum(w * math.log1p(math.exp(-8 * x * c)) for w, x, c in zip(weight, m, code[lang])) / sum(weight)
    best = min(languages, key=lambda x: loss[x])
    return best, 1 / sum(math.exp(loss[best] - x) for x in loss.values())


def test_prediction_against_plain_python(session):
    train = [("the cat sat on the mat", "en"), ("the dog and the Hat", "en"), ("der Hund und die Katze", "de"), ("die Straße ist naß", "de"),
             ("le chat est sur la table", "fr"), ("the cat sat on the mat", "en"), ("la mer et le ciel", "fr"), ("le the der", "de")]
    texts = ["the mat", "die Katze", "la table et le chat", "x", "der cat le", "THE HUND"]
    model = language_id.train(session.createDataFrame(train, "text string, lang string").repartition(3))
    got = language_id.predict(session.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    for r in got:
        lang, score = plain_prediction(train, r.text)
        assert r.lang_pred == lang or abs(score - 1 / 3) < 1e-6
        assert abs(r.score - score) < 1e-4


def test_columns_named_like_a_result(session):
    docs = session.createDataFrame([("ab cd", "en", "mine", 5), ("", "de", "mine", 6)], "text string, lang string, Lang_Pred string, score int")
    got = language_id.predict(docs, language_id.train(docs))
    assert got.columns == ["text", "lang", "lang_pred", "score", "ambiguous"]
    assert {r.text: r.lang_pred for r in got.collect()} == {"ab cd": "en", "": "und"}
