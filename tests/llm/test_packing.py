"""Packing against brute force: best fillings, and the pieces of all documents by the library on whole texts."""

import zlib
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import packing
from matchlake.llm.bin_slack import Lengths, powers
from matchlake.llm.encoders import Words, encoder, vocabulary_path
from matchlake.llm.scratch import stored

NAME = "word_bpe_49k.json"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=8), st.integers(0, 40))
def test_best_filling(lengths, capacity):
    left = Lengths(lengths)
    picked = left.best(capacity)
    assert all(0 < n <= lengths.count(length) for length, n in picked.items())
    sums = [sum(a for a, chosen in zip(lengths, choice) if chosen) for choice in product((0, 1), repeat=len(lengths))]
    assert sum(length * n for length, n in picked.items()) == max(s for s in sums if s <= capacity)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40))
def test_groups_are_packed_without_padding(lengths):
    group = packing.Group(16)
    for i, n in enumerate(lengths):
        group.add(i, np.full(n, i, np.uint16))
    full = list(group.sequences())
    assert all(sum(n for _, _, n in window) == 16 for window in full)
    tail = list(group.carried().tail())
    assert all(sum(n for _, _, n in window) in (1, 2, 4, 8) for window in tail)
    assert sum(lengths) == sum(n for window in full + tail for _, _, n in window)


def test_powers():
    assert powers(4095) == [1 << b for b in range(11, -1, -1)] and powers(0) == []


def test_words_are_recognised():
    assert isinstance(encoder(vocabulary_path(NAME)), Words)


@pytest.mark.parametrize("which", ["odd_documents", "documents", "no_documents"])
def test_pieces(which, request):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(vocabulary_path(NAME))
    want = {}
    for row in docs.collect():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 2]
        want.setdefault(row.doc_id, []).append(np.array(ids, "<u4"))
    sequences = packing.pack_sequences(docs.repartition(3), vocabulary_path(NAME), 2, 1024, 20_000, 1 << 14)
    got = packing.pieces(stored(sequences, "test-sequences")).collect()
    fill, left = {}, {d: sorted(len(i) for i in all_) for d, all_ in want.items()}
    by_doc = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
        assert any(len(i) == r.doc_tokens and zlib.crc32(i[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for i in want[r.doc_id])
    assert {d: sum(sizes) for d, sizes in left.items()} == {d: sum(r.length for r in rows) for d, rows in by_doc.items()}
    for d, rows in by_doc.items():
        if len(want[d]) == 1:
            assert np.array_equal(np.sort([p for r in rows for p in range(r.start, r.start + r.length)]), np.arange(len(want[d][0])))
    for parts in fill.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        total = sum(n for _, n in parts)
        assert total <= 1024 and total & (total - 1) == 0
    whole = sum(len(i) for all_ in want.values() for i in all_)
    assert sum(1 for p in fill.values() if sum(n for _, n in p) < 1024) <= 3 * 10 and sum(n for p in fill.values() for _, n in p) == whole
