import numpy as np

from lakegauge.llm import repair


def test_rules_are_expanded_once():
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 900, 700)
    tokens = np.concatenate([np.tile(passage, 12), rng.integers(0, 40, 9000), np.full(3000, 7)])
    last = np.zeros(len(tokens), bool)
    last[[700, 8399, -1]] = True
    symbols, _, rules, sizes = repair.grammar(tokens, last, 1000)
    assert sizes.max() > 2
    assert np.array_equal(repair.expand_all(symbols, rules, sizes, 1000), tokens)


def test_without_rules_or_symbols():
    none = np.zeros(0, np.int64)
    assert repair.expand_all(none, none.reshape(0, 2), none, 1000).tolist() == []
    assert repair.expand_all(np.array([3, 999, 3]), none.reshape(0, 2), none, 1000).tolist() == [3, 999, 3]
