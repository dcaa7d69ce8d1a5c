"""Substring dedup and the Jaccard join against brute force."""

import hashlib

import pytest

from tests_llm_helpers import corpus, frame, ready, words  # noqa: F401
from titlepulse.llm import ngram_join, substring_dedup


def plain_dedup(rows):
    first = {}
    for doc_id, text in rows:
        if doc_id is not None:
            split = words(text)
            for n in range(len(split) - 12):
                key = tuple(split[n : n + 13])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        split = words(text)
        gone = set()
        if doc_id is not None:
            for n in range(len(split) - 12):
                if first[tuple(split[n : n + 13])] < doc_id:
                    gone |= set(range(n, n + 13))
        kept = [w for n, w in enumerate(split) if n not in gone]
        out.append((doc_id, len(split), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("frequent", [substring_dedup.FREQUENT, 0.01])
def test_substring_dedup_equals_brute_force(spark, frame, monkeypatch, frequent):
    # with the second value, shared passages count as frequent and take the ways for frequent runs and windows
    monkeypatch.setattr(substring_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(substring_dedup, "WINDOW_FREQUENT", frequent / 4)
    monkeypatch.setattr(substring_dedup, "LEAST", 2)
    rows = corpus(3)
    found = substring_dedup.dedup(frame(rows).repartition(3))
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()], key=str) == plain_dedup(rows)


def test_substring_dedup_of_an_empty_table(frame):
    assert substring_dedup.dedup(frame([])).collect() == []


def plain_groups(rows):
    sets = []
    for doc_id, text in rows:
        split = [w.lower() for w in words(text)]
        sets.append({tuple(split[n : n + 5]) for n in range(len(split) - 4)} if len(split) >= 5 else {tuple(split)} if split else set())
    root = {doc_id: doc_id for doc_id, _ in rows if doc_id is not None}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for n, (a, _) in enumerate(rows):
        for m, (b, _) in enumerate(rows[:n]):
            common = len(sets[n] & sets[m])
            if a is not None and b is not None and common and 100 * common >= 80 * len(sets[n] | sets[m]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return sorted([(doc_id, len(s), None if doc_id is None else top(doc_id)) for (doc_id, _), s in zip(rows, sets)], key=str)


@pytest.mark.parametrize("block", [ngram_join.CLUSTER_BLOCK, 4])
def test_jaccard_groups_equal_brute_force(frame, monkeypatch, block):
    # with the second value, a cluster is many blocks
    monkeypatch.setattr(ngram_join, "CLUSTER_BLOCK", block)
    rows = corpus(5)
    found = ngram_join.groups(frame(rows).repartition(3))
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()], key=str) == plain_groups(rows)


def test_sketches_never_rule_out_an_overlap():
    import random

    import numpy as np

    rng = random.Random(1)
    for size in (1, 5, 40, 700, 9000):
        a = np.unique(np.array([rng.getrandbits(64) for _ in range(size)], np.uint64))
        b = np.unique(np.concatenate([a[: rng.randint(0, len(a))], np.array([rng.getrandbits(64) for _ in range(rng.randint(0, 3 * size))], np.uint64)]))
        common = len(np.intersect1d(a, b))
        assert ngram_join.most_overlap(ngram_join.sketch(a), len(a), ngram_join.sketch(b), len(b)) >= common
    empty = np.empty(0, np.uint64)
    assert ngram_join.most_overlap(ngram_join.sketch(empty), 0, ngram_join.sketch(empty), 0) == 0


def test_one_of_each_group_stays(frame):
    text = " ".join(f"w{n}" for n in range(30))
    rows = [(4, text), (2, text), (9, text.upper()), (1, "something else"), (3, None), (5, ""), (None, text)]
    kept = ngram_join.keep_one(frame(rows))
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [1, 2, 3, 5, None]
    assert ngram_join.keep_one(frame([])).collect() == []


def test_overlaps_in_blocks_of_columns(monkeypatch):
    import numpy as np

    monkeypatch.setattr(ngram_join, "COLUMNS", 3)
    sets = [np.array(x, np.uint64) for x in ([1, 2, 3, 4, 9], [2, 3, 4, 5, 9], [9], [1, 2, 3, 4, 5, 6, 7, 9])]
    expected = [[len(set(a) & set(b)) for b in sets] for a in sets]
    found = ngram_join.overlaps(sets)
    assert all(found[n, m] == expected[n][m] for n in range(4) for m in range(4) if n != m)
