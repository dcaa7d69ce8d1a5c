"""How the whole Katz model orders its n-grams and takes in what the buckets answer, without Spark."""

import numpy as np
import pytest

from titlepulse.llm import katz_whole


@pytest.mark.parametrize("top", [1, 1 << 30, (1 << 64) - 1])
def test_keys_are_ordered_with_equal_ones_as_they_come(top):
    drawn = np.random.default_rng(5).integers(0, 40, 3000).astype(np.uint64)
    keys = np.where(drawn == 39, np.uint64(top), drawn)
    order, ordered = katz_whole.in_order(keys)
    assert np.array_equal(order, np.argsort(keys, kind="stable")) and np.array_equal(ordered, np.sort(keys))
    assert [len(x) for x in katz_whole.in_order(keys[:0])] == [0, 0]
    low = keys % np.uint64(1 << 32)
    first, number = katz_whole.numbered(drawn, low)
    assert np.array_equal(drawn[first][number], drawn) and np.array_equal(low[first][number], low)


def test_a_block_keeps_two_numbers_of_each_context(monkeypatch):
    # A table of eight sums of each context took most of a task's memory, and its product ran on threads of its own.
    shapes, zeros = [], np.zeros
    block = object.__new__(katz_whole.Block)
    block.totals, block.k = katz_whole.Totals(1, 100), 2
    block.totals.factors = {1: np.ones(6), 2: np.array([1.0, 0.5, 0.6, 0.7, 0.8, 0.9])}
    # A context with two grams, counted once and seven times, and one with a gram that was not counted.
    block.context_words, block.hot = zeros((3, 1), np.int64), zeros(3, bool)
    block.of, block.pieces, block.shorter, block.p = np.array([1, 1, 2]), [np.arange(3)], np.arange(3), np.array([0.2, 0.3, 0.1])
    sums = [np.array(x) for x in ([8, 0], [1, 0], [0, 0], [0, 0], [0, 0], [0, 0], [7, 0])]
    answer = katz_whole.pack(np.array([1, 7, 0]), *sums, zeros(2, bool), zeros(2, bool), zeros(0))
    monkeypatch.setattr(katz_whole.np, "zeros", lambda shape, *a, **k: shapes.append(shape) or zeros(shape, *a, **k))
    block.read([answer])
    assert block.p == pytest.approx([0.5 / 8, 7 / 8, 0.1])
    assert all(np.prod(shape) <= 3 for shape in shapes)
