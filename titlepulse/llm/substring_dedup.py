"""Substring dedup over super-k-mers.

A window is ``WINDOW`` consecutive words.  Its minimiser is the least, by hash, of the runs of ``RUN`` words inside it;
neighbouring windows mostly share one, and such windows travel together, as one packed string of words, to the bucket
of their minimiser.  Equal windows have equal minimisers, so a bucket sees all copies of its windows; there, entries
with one minimiser are opened and sorted as text, which finds equal windows exactly: hashes only choose the bucket.

Frequent runs come last in the order of minimisers, so that a passage that many documents share does not draw what
stands around it into one bucket.  Windows made of frequent runs alone travel singly, by their own hash; those that
are frequent themselves are settled before, from an aggregate of each one's smallest doc_id, and do not travel.  Both
lists are bounded by the share that makes an entry frequent.  Buckets are sent as compressed blocks, as many buckets
as the words of the corpus need.

A word goes if a window that covers it also starts in a document with a smaller doc_id.  Rows with equal doc_ids do
not remove each other's words.  A row with a null id removes nothing and loses nothing.  Null and empty texts, and
those with fewer words than a window, stay as they are (as words).  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.llm.common import arrow_map, window_hashes, word_hashes, words_of
from titlepulse.sources.shared import stage

WINDOW, RUN = 13, 3
# A run is frequent from this share of all runs on, a window from ten times the share on: at most 250,000 and 25,000.
FREQUENT = 4e-6
WINDOW_FREQUENT = 10 * FREQUENT
# Never frequent below so many in one block of words.
LEAST = 4
BLOCK_WORDS = 1_000_000
BUCKET_WORDS = 4_000_000

# Words in a task at once while they are packed.
PACK_WORDS = 800_000

TOP = np.uint64(1 << 63)


class Block:
    """The words of several documents in one row, with what places them."""

    def __init__(self, docs: list[tuple[int, int, list[bytes]]]):
        self.ids = np.array([d[0] for d in docs], np.int64)
        self.keys = np.array([d[1] for d in docs], np.int64)
        counts = np.array([len(d[2]) for d in docs], np.int64)
        self.words = [w for d in docs for w in d[2]]
        self.doc = np.repeat(np.arange(len(docs)), counts)
        self.first = np.cumsum(counts) - counts
        self.hashes = word_hashes(self.words)
        runs = window_hashes(self.hashes, RUN)
        inside = self.doc[: len(runs)] == self.doc[RUN - 1 : RUN - 1 + len(runs)]
        self.runs, self.run_inside = runs & ~TOP, inside

    def windows(self, frequent: np.ndarray):
        """``(valid, minimiser)`` per window start; a minimiser with the top bit: frequent runs only."""
        count = len(self.words) - WINDOW + 1
        if count <= 0:
            return np.empty(0, bool), np.empty(0, np.uint64)
        order = self.runs
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, order), len(frequent) - 1)
            order = np.where(frequent[at] == order, order | TOP, order)
        span, least = 1, order
        runs = WINDOW - RUN + 1
        while 2 * span <= runs:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:count], least[runs - span : runs - span + count])
        return self.doc[:count] == self.doc[WINDOW - 1 :], least

    def text(self):
        """The words as one string with blanks, and where each begins and ends."""
        ends = np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1) - 1
        begins = np.concatenate([[0], ends[:-1] + 1])
        return b" ".join(self.words), begins, ends


def blocks(batches: Iterator[pa.RecordBatch], words: int = BLOCK_WORDS) -> Iterator[Block]:
    held, count = [], 0
    for batch in batches:
        for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), batch.column("text")):
            split = words_of(text.as_py())
            if len(split) >= WINDOW:
                held.append((doc_id, key, split))
                count += len(split)
            if count >= words:
                yield Block(held)
                held, count = [], 0
    if held:
        yield Block(held)


def planes(numbers: np.ndarray) -> bytes:
    """The bytes of numbers, all lowest bytes first: that compresses better."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def frequent_runs(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Sorted frequent runs, and the number of words in documents that have a window."""

    def count(batches):
        for block in blocks(batches):
            values, counts = np.unique(block.runs[block.run_inside], return_counts=True)
            many = counts >= max(LEAST, FREQUENT * len(block.words))
            yield pa.RecordBatch.from_pydict(
                {"run": np.concatenate([values[many].astype(np.int64), [-1]]), "n": np.concatenate([counts[many], [len(block.words)]]).astype(np.int64)}
            )

    counted = stage(rows.mapInArrow(count, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")), "runs")
    total = counted.where("run = -1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = counted.where((F.col("run") >= 0) & (F.col("n") >= FREQUENT * total)).select("run").toArrow().column("run")
    return np.sort(found.to_numpy().astype(np.uint64)), total


def frequent_windows(rows: DataFrame, runs, total: int) -> dict[bytes, int]:
    """The smallest doc_id of every frequent window made of frequent runs alone."""

    def count(batches):
        for block in blocks(batches):
            valid, least = block.windows(runs.value)
            starts = np.flatnonzero(valid & (least >= TOP))
            text, begins, ends = block.text()
            found: dict[bytes, list[int]] = {}
            for begin, end, doc in zip(begins[starts].tolist(), ends[starts + WINDOW - 1].tolist(), block.ids[block.doc[starts]].tolist()):
                entry = found.setdefault(text[begin:end], [doc, 0])
                entry[0] = min(entry[0], doc)
                entry[1] += 1
            if found:
                yield pa.RecordBatch.from_pydict({"w": list(found), "doc": [e[0] for e in found.values()], "n": [e[1] for e in found.values()]})

    counted = rows.mapInArrow(count, "w binary, doc long, n long").groupBy("w").agg(F.min("doc").alias("doc"), F.sum("n").alias("n"))
    return {bytes(r["w"]): r["doc"] for r in counted.where(F.col("n") >= max(LEAST, WINDOW_FREQUENT * total)).select("w", "doc").toLocalIterator()}


def super_kmers(rows: DataFrame, runs, settled, buckets: int) -> DataFrame:
    """``(bucket, block)``: the packed strings of a task for one bucket, compressed."""

    def send(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for block in blocks(batches, PACK_WORDS):
            valid, least = block.windows(runs.value)
            starts = np.flatnonzero(valid)
            if not len(starts):
                continue
            text, begins, ends = block.text()
            single = least[starts] >= TOP
            removed: dict[int, list[int]] = {}
            alone = []
            for start in starts[single].tolist():
                window = text[begins[start] : ends[start + WINDOW - 1]]
                smallest = settled.value.get(window)
                if smallest is None:
                    alone.append((start, xxhash.xxh3_64_intdigest(window)))
                elif smallest < block.ids[block.doc[start]]:
                    removed.setdefault(int(block.doc[start]), []).append(int(start - block.first[block.doc[start]]))
            rest = starts[~single]
            value = least[rest]
            new = np.ones(len(rest), bool)
            new[1:] = (value[1:] != value[:-1]) | (rest[1:] != rest[:-1] + 1)
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(rest)) - 1
            begin_word = np.concatenate([rest[heads], np.array([a[0] for a in alone], np.int64)])
            last_window = np.concatenate([rest[tails], np.array([a[0] for a in alone], np.int64)])
            value = np.concatenate([value[heads], np.array([a[1] for a in alone], np.uint64)]) * np.uint64(0xD6E8FEB86659FD93)
            bucket = ((value >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            minimiser = (value & np.uint64(0xFFFFFFFF)).astype(np.int64)
            order = np.lexsort((minimiser, bucket))
            begin_byte, end_byte = begins[begin_word], ends[last_window + WINDOW - 1]
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            passed = {}
            for doc, windows in removed.items():
                passed.setdefault(hash(int(block.keys[doc])) % buckets, []).append((int(block.ids[doc]), int(block.keys[doc]), windows))
            for a, b in zip(cuts, np.append(cuts[1:], len(order))):
                own = order[a:b]
                docs, doc = np.unique(block.doc[begin_word[own]], return_inverse=True)
                start = begin_word[own] - block.first[docs][doc]
                packed = b"\n".join([text[x:y] for x, y in zip(begin_byte[own].tolist(), end_byte[own].tolist())])
                content = (
                    block.ids[docs].tobytes(), block.keys[docs].tobytes(), planes(np.diff(minimiser[own], prepend=0)),
                    planes(doc), planes(start), packed, passed.pop(int(bucket[own[0]]), []),
                )
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([int(bucket[own[0]])], pa.int64()), "block": [packer.compress(pickle.dumps(content))]})
            for number, entries in passed.items():
                empty = (b"", b"", b"", b"", b"", b"", entries)
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([number], pa.int64()), "block": [packer.compress(pickle.dumps(empty))]})

    return rows.mapInArrow(send, "bucket long, block binary")


def repeated_windows(packed: list[bytes]) -> tuple[list, list]:
    """Of the blocks of one bucket: ``(id, key, [first window, number of windows, ...])`` of windows to remove."""
    opener = zstandard.ZstdDecompressor()
    ids, keys, minimisers, starts, strings, out = [], [], [], [], [], []
    for block in packed:
        doc_ids, doc_keys, deltas, docs, start, text, passed = pickle.loads(opener.decompress(block))
        for doc_id, key, windows in passed:
            out.append((doc_id, key, [n for w in windows for n in (w, 1)]))
        if docs:
            doc = unplaned(docs)
            ids.append(np.frombuffer(doc_ids, np.int64)[doc])
            keys.append(np.frombuffer(doc_keys, np.int64)[doc])
            minimisers.append(np.cumsum(unplaned(deltas).astype(np.int64)))
            starts.append(unplaned(start))
            strings += text.split(b"\n")
    if not ids:
        return out
    ids, keys, minimisers, starts = (np.concatenate(x) for x in (ids, keys, minimisers, starts))
    order = np.lexsort((ids, minimisers))
    heads = np.flatnonzero(np.diff(minimisers[order], prepend=-1))
    tails = np.append(heads[1:], len(order))
    several = ids[order[heads]] != ids[order[tails - 1]]
    for a, b in zip(heads[several].tolist(), tails[several].tolist()):
        opened = []
        for entry in order[a:b].tolist():
            words = strings[entry].split(b" ")
            doc_id = int(ids[entry])
            opened += [(b" ".join(words[n : n + WINDOW]), doc_id, entry, n) for n in range(len(words) - WINDOW + 1)]
        opened.sort()
        window, smallest, marked = None, 0, []
        for text, doc_id, entry, n in opened:
            if text != window:
                window, smallest = text, doc_id
            elif doc_id > smallest:
                marked.append((entry, n))
        marked.sort()
        ranges: dict[int, list[int]] = {}
        for entry, n in marked:
            own = ranges.setdefault(entry, [])
            if own and own[-2] + own[-1] == n + int(starts[entry]):
                own[-1] += 1
            else:
                own += [n + int(starts[entry]), 1]
        out += [(int(ids[entry]), int(keys[entry]), own) for entry, own in ranges.items()]
    return out


def removed_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, key, ranges``: starts and numbers of windows whose words go; ``key`` is the hash of the text."""
    spark = docs.sparkSession
    rows = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("key"), F.col("text").cast("string").alias("text")
    )
    frequent, total = frequent_runs(rows)
    runs = spark.sparkContext.broadcast(frequent)
    settled = spark.sparkContext.broadcast(frequent_windows(rows, runs, total) if len(frequent) else {})
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_WORDS)

    def open_bucket(held: pa.Table) -> pa.Table:
        found = repeated_windows([b.as_py() for b in held.column("block")])
        return pa.table(
            {"doc_id": pa.array([f[0] for f in found], pa.int64()), "key": pa.array([f[1] for f in found], pa.int64()), "ranges": pa.array([f[2] for f in found], pa.list_(pa.int32()))}
        )

    sent = super_kmers(rows, runs, settled, buckets)
    return sent.groupBy("bucket").applyInArrow(open_bucket, "doc_id long, key long, ranges array<int>")


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, kept_sha256`` of every document."""
    gone = removed_windows(docs).groupBy("doc_id", "key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("key"), F.col("text").cast("string").alias("text")
    )

    def cut(batch):
        out = {"doc_id": batch.column("doc_id").to_pylist(), "n_words": [], "n_removed": [], "kept_text": [], "kept_sha256": []}
        for text, ranges in zip(batch.column("text"), batch.column("ranges")):
            words = words_of(text.as_py())
            count = len(words)
            if ranges.is_valid:
                pairs = ranges.values.to_numpy().reshape(-1, 2)
                # +1 where a range's first word is, -1 after the last word of its last window
                level = np.zeros(count + 1, np.int64)
                np.add.at(level, pairs[:, 0], 1)
                np.add.at(level, pairs[:, 0] + pairs[:, 1] + WINDOW - 1, -1)
                words = [words[n] for n in np.flatnonzero(np.cumsum(level[:-1]) == 0)]
            kept = b" ".join(words)
            out["n_words"].append(count)
            out["n_removed"].append(count - len(words))
            out["kept_text"].append(kept.decode("utf-8", "surrogatepass"))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        yield out

    joined = texts.join(gone, ["doc_id", "key"], "left").select("doc_id", "text", "ranges")
    return arrow_map(joined, cut, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
