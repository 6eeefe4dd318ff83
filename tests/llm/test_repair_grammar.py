"""The grammar of a shard: rules are opened once, however often they stand in the symbols."""

import numpy as np

from matchlake.llm import repair


def test_rules_are_opened_once_and_copied():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 40, 30_000).astype(np.uint32)
    ids[5_000:9_000] = 7
    last = rng.random(len(ids)) < 0.01
    last[-1] = True
    symbols, _, grammar = repair.compress(ids, last, 50)
    opened = grammar.opened()
    assert len(opened) == grammar.expansions.sum() and opened.max() < 50
    assert np.array_equal(grammar.decode(symbols), ids)
    tripled = np.tile(symbols, 3)
    assert np.array_equal(grammar.decode(tripled), np.tile(ids, 3))
    assert np.array_equal(grammar.lengths(symbols), [len(grammar.decode(symbols[i:i + 1])) for i in range(len(symbols))])


def test_no_symbols_and_no_rules():
    symbols, _, grammar = repair.compress(np.array([3], np.uint32), np.array([True]), 50)
    assert grammar.decode(symbols).tolist() == [3] and grammar.decode(symbols[:0]).tolist() == []


def test_pairs_of_one_hash_place_keep_their_rules():
    # far more rules a round than a table of 2^20 places holds without clashes
    ids = np.tile(np.random.default_rng(5).integers(0, 60_000, 30_000), 9).astype(np.uint32)
    last = np.zeros(len(ids), dtype=bool)
    last[-1] = True
    symbols, _, grammar = repair.compress(ids, last, 60_000, rules=90_000, rounds=1)
    assert len(grammar.left) > 14_000 and len(symbols) < 0.56 * len(ids)
    assert np.array_equal(grammar.decode(symbols), ids)
