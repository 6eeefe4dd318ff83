"""Benchmark windows against a plain search over word lists."""

import hashlib
import re

import pytest

from matchlake.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add("" if item is None else str(item))
    out = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def benchmark(session):
    rows = [(1, "One two"), (2, " ".join(f"word{i}" for i in range(30, 45))), (3, None), (4, "?!"), (1, "one TWO"), (None, "É ü ß"),
            (5, " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000, 40_030)))]
    return session.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_hits(session, odd_documents, benchmark, block):
    got = decontaminate.scan(odd_documents, benchmark, 10, block).collect()
    want = brute([(r.doc_id, r.text) for r in odd_documents.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    assert sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in got) == want


def test_given_tables(session, documents):
    items = session.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = decontaminate.scan(documents, items).collect()
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in got) == want
    assert any(r.n_hit for r in got)


def test_clean_keeps_columns_and_cuts_spans(session, odd_documents, benchmark):
    whole = decontaminate.clean(odd_documents, benchmark)
    assert whole.columns == odd_documents.columns
    assert decontaminate.scan(whole, benchmark).filter("n_hit > 0").isEmpty()
    cut = decontaminate.clean(odd_documents, benchmark, spans=True)
    assert cut.count() == odd_documents.count()
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert (7, "") in texts and (4, None) in texts
    assert next(t for d, t in texts if d == 1) == " ".join(f"word{i}" for i in range(30)) + "  " + " ".join(f"word{i}" for i in range(45, 120))


def test_empty(session, no_documents, benchmark, odd_documents):
    assert decontaminate.scan(no_documents, benchmark).isEmpty()
    none = benchmark.limit(0)
    assert decontaminate.scan(odd_documents, none).filter("n_hit > 0").isEmpty()
    assert decontaminate.scan(odd_documents, none).select(decontaminate.digest("items")).first()[0] == hashlib.sha256(b"").hexdigest()
