"""Ranked lexical search, reversed: documents stream through an index of the items.

The items are few, the documents are not.  So the items' terms form the inverted index, which every task holds, and
each document's term counts go through it once: they add to the scores of the items that share a term, and a score
that beats the item's worst one so far enters the item's heap of ``k``.  A task returns its heaps, which are merged in
two rounds, so that no task sees the heaps of all others.

The index is built from items in blocks: one block after the other, until a block's texts reach ``BLOCK_BYTES`` or its
items ``BLOCK_ITEMS``.  A block is all that the driver holds, and the bound on what is broadcast; an item longer
than the bound is a block of its own, no larger than the row that it already is.  Each block takes two passes over
the documents: one for the number of documents, of terms, and of documents that hold each of the block's terms, from
which the weights follow; one for the scores.  Nothing of the documents is shuffled but those counts and the heaps.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case.  With ``N``
documents that have a term, ``L`` terms in all, ``n`` in the document, ``df`` documents that hold the term and ``tf``
occurrences of it in the document, a term weighs ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and adds
``w * ((10**9 tf) div (1000 tf + 8 m))`` for each of its occurrences in the item, ``m = 25 + (75 n N) div L``.

Null and empty texts have no terms: such documents count nowhere, and such items have no results.  Texts of any
length are read whole.  Every row is a document, and every row an item, of its own, also where ids are repeated or
null: a repeated item has a list for each of its rows.  Equal scores rank by ascending doc_id, null after all others.
Empty tables give an empty result.  Further columns, whatever their names, are left out.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.operators.ranking import top_within
from titlepulse.sources.shared import stage

K = 10
BLOCK_BYTES, BLOCK_ITEMS = 8 << 20, 20_000

_TERM_BYTES = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLDED = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _TERM_BYTES else 0x20 for b in range(256))

# Rows of the table of counts that are no term's.
_DOCUMENTS, _TERMS = -1, -2
_LAST = (1 << 63) - 1


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text as UTF-8.  All bytes of a character beyond ASCII are above 0x7F, so bytes can be judged one by one."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLDED).split() if text else []


class Index:
    """The items' terms: a number per term, and for each term the items that hold it and how often."""

    def __init__(self, texts: list[str | None]):
        held = [Counter(terms_of(text)) for text in texts]
        self.items = len(texts)
        self.number = {term: n for n, term in enumerate(dict.fromkeys(term for terms in held for term in terms))}
        listed: list[list[tuple[int, int]]] = [[] for _ in self.number]
        for item, terms in enumerate(held):
            for term, times in terms.items():
                listed[self.number[term]].append((item, times))
        self.size = np.array([len(own) for own in listed], np.int64)
        self.start = np.cumsum(self.size) - self.size
        flat = np.array([pair for own in listed for pair in own], np.int64).reshape(-1, 2)
        self.item, self.times = flat[:, 0], flat[:, 1]

    def counts(self, terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and occurrences of the index's terms among a document's."""
        number = self.number
        found = [(number[term], times) for term, times in Counter(terms).items() if term in number]
        flat = np.array(found, np.int64).reshape(-1, 2)
        return flat[:, 0], flat[:, 1]

    def weighted(self, weights: np.ndarray) -> np.ndarray:
        """Of each posting: the weight of its term, as often as the item holds it."""
        return self.times * np.repeat(weights, self.size)


class Heaps:
    """The ``k`` best documents of each item so far.  An entry is (score, -doc_id): its least is the first to go."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # what a score must reach: above 0, or the worst of a full heap
        self.scores = np.zeros(items, np.int64)

    def add(self, doc_id: int | None, items: np.ndarray, gains: np.ndarray) -> None:
        scores = self.scores
        np.add.at(scores, items, gains)
        reached = np.unique(items[scores[items] >= self.least[items]])
        for item in reached.tolist():
            heap, entry = self.heaps[item], (int(scores[item]), -(_LAST if doc_id is None else doc_id))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[item] = max(1, heap[0][0])
        scores[items] = 0

    def entries(self) -> Iterator[tuple[int, int | None, int]]:
        for item, heap in enumerate(self.heaps):
            for score, negated in heap:
                yield item, None if negated == -_LAST else -negated, score


def blocks(items: DataFrame, most_bytes: int = BLOCK_BYTES, most_items: int = BLOCK_ITEMS) -> Iterator[list[tuple[int | None, str | None]]]:
    """``(item_id, text)`` of all items, in lists within the bounds."""
    block, held = [], 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        width = len(row[1] or "") * 4
        if block and (held + width > most_bytes or len(block) >= most_items):
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += width
    if block:
        yield block


def corpus_counts(docs: DataFrame, index) -> dict[int, int]:
    """Documents that hold each term of the broadcast index, documents with a term, and terms in all."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        held = np.zeros(len(own.number), np.int64)
        documents = terms = 0
        for batch in batches:
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                documents += bool(words)
                terms += len(words)
                held[own.counts(words)[0]] += 1
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array([_DOCUMENTS, _TERMS, *seen.tolist()], pa.int64()), "n": pa.array([documents, terms, *held[seen].tolist()], pa.int64())}
        )

    counted = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {row["term"]: row["n"] for row in counted.collect()}  # a row for each term of the block


def search_block(docs: DataFrame, block: list[tuple[int | None, str | None]], k: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` of one block of items."""
    spark = docs.sparkSession
    index = spark.sparkContext.broadcast(Index([text for _, text in block]))
    counts = corpus_counts(docs, index)
    documents, terms = counts.get(_DOCUMENTS, 0), counts.get(_TERMS, 0)
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * counts.get(n, 0) + 1))) for n in range(len(index.value.number))]
    gains = spark.sparkContext.broadcast(index.value.weighted(np.array(weights, np.int64)))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, gain = index.value, gains.value
        heaps = Heaps(own.items, k)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms_of(text.as_py())
                numbers, times = own.counts(words)
                if not len(numbers):
                    continue
                m = 25 + 75 * len(words) * documents // terms
                part = (1_000_000_000 * times) // (1000 * times + 8 * m)
                sizes = own.size[numbers]
                postings = np.arange(sizes.sum()) + np.repeat(own.start[numbers] - (np.cumsum(sizes) - sizes), sizes)
                heaps.add(doc_id, own.item[postings], gain[postings] * np.repeat(part, sizes))
        columns = list(zip(*heaps.entries())) or [(), (), ()]
        yield pa.RecordBatch.from_pydict({name: pa.array(values, pa.int64()) for name, values in zip(("item", "doc_id", "score"), columns)})

    heaps = docs.mapInArrow(score, "item long, doc_id long, score long")
    best = top_within(heaps, ["item"], [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], k)
    names = spark.createDataFrame([(n, item_id) for n, (item_id, _) in enumerate(block)], "item long, item_id long")
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 for every item."""
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [search_block(bare, block, k) for block in blocks(items, block_bytes, block_items)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found[0] if len(found) == 1 else reduce(DataFrame.unionAll, [stage(one, "found") for one in found])
