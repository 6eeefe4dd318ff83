"""Token counts and token shards against the libraries on whole texts."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import token_counts, token_store
from matchlake.llm.encoders import token_ids, vocabulary_path
from matchlake.llm.repair import compress
from matchlake.session import scratch_path


def reference(name):
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_file=vocabulary_path(name)).encode
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


TEXTS = st.text(st.sampled_from("ab Z9'sΣ\u0338\u0301=.,'\n\t\r 　▁é日😀<|>/s"), max_size=40) | st.text(max_size=30)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"])
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXTS | st.just("a <|endoftext|> b</s> <s>"), min_size=1, max_size=6))
def test_segments_give_the_same_ids(name, texts):
    import pyarrow as pa

    ids, lengths = token_ids(pa.array(texts), vocabulary_path(name))
    parts = np.split(ids, np.cumsum(lengths)[:-1])
    assert [p.tolist() for p in parts] == [list(r) for r in reference(name)(texts)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=60), min_size=1, max_size=5), st.booleans())
def test_repair_round_trip(texts, narrow):
    ids = np.array([i for t in texts for i in [*t, 0]], np.uint32)
    last = np.zeros(len(ids), dtype=bool)
    last[np.cumsum([len(t) + 1 for t in texts]) - 1] = True
    base = 7 if narrow else 70_000
    symbols, ends, grammar = compress(ids, last, base, least=2, rules=9)
    assert grammar.decode(symbols).tolist() == ids.tolist()
    assert ends.sum() == len(texts)
    assert [grammar.at(symbols, i) for i in range(len(ids))] == ids.tolist()


def brute_counts(rows, name):
    encode = reference(name)
    return [(d, t or "", list(encode([t or ""])[0])) for d, t in rows]


@pytest.mark.parametrize("which", ["odd_documents", "documents", "no_documents"])
def test_counts(which, request):
    docs = request.getfixturevalue(which)
    got = token_counts.count_tokens(docs, vocabulary_path("piece_bpe_32k.model"), 100, 1 << 16).collect()
    want = brute_counts([(r.doc_id, r.text) for r in docs.collect()], "piece_bpe_32k.model")
    assert sorted(map(str, map(tuple, got))) == sorted(str((d, len(t.encode()), len(i), len(i) > 100)) for d, t, i in want)


@pytest.mark.parametrize("which", ["odd_documents", "documents", "no_documents"])
def test_store(which, request, session):
    docs = request.getfixturevalue(which)
    folder = scratch_path(session, "test-tokens")
    token_store.write_tokens(docs, folder, vocabulary_path("byte_bpe_50k.json"), 0, 50257, 1 << 16)
    got = token_store.read_documents(session, folder).orderBy("start").collect()
    want = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _ in want]
    rest, start = {}, 0
    for d, _, ids in brute_counts(want, "byte_bpe_50k.json"):
        rest.setdefault(d, []).append((len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())))
    for r in got:
        assert r.start == start
        rest[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens


def test_words_are_hashed_in_bounded_memory():
    """Blocks take little memory beside the text and change no hash, whatever lies on their edges."""
    import tracemalloc

    from matchlake.llm.packed import span_hashes

    data = np.frombuffer(b"some words and more " * 200_000, np.uint8)
    starts = np.arange(0, len(data), 5)
    ends = starts + 4
    tracemalloc.start()
    whole = span_hashes(data, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
    odd = np.array([0, 3, 4, 900, 901]), np.array([3, 4, 900, 901, 5000])
    assert all((span_hashes(data, *odd, block_bytes=n) == span_hashes(data, *odd)).all() for n in (1, 4, 897, 1 << 20))
    assert len(set(whole.tolist())) == 4


def test_a_shard_is_encoded_in_slices(session):
    """A shard's text is handed to the encoder in parts of ``slice_bytes``; its documents come back whole."""
    docs = session.createDataFrame([(i, f"w{i} " * 500) for i in range(40)], "doc_id long, text string").coalesce(1)
    folder = scratch_path(session, "test-slices")
    token_store.write_tokens(docs, folder, vocabulary_path("byte_bpe_50k.json"), 0, 50_300, slice_bytes=4000)
    got = {r.doc_id: r for r in token_store.read_documents(session, folder).collect()}
    want = reference("byte_bpe_50k.json")([f"w{i} " * 500 for i in range(40)])
    for i, ids in enumerate(want):
        assert got[i].ids_crc32 == zlib.crc32(np.array([*ids, 0], "<u4").tobytes())
    assert got[39].start == sum(len(ids) + 1 for ids in want[:39])
