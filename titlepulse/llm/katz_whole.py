"""Katz backoff over every word and every n-gram of the training documents, up to a given order.

Tokens are those of ``katz_lm``; a document is led in by ``order - 1`` beginnings.  Every n-gram of every length is
counted, with no cutoff by count and no bound on words.  With a context h, h' its words but the first, and n(h) the
occurrences of h before a token:

    P(w | h) = d(n) * n(h w) / n(h)     where h w was counted, else
    P(w | h) = backoff(h) * P(w | h')   with backoff(h) = 1 where h was not counted

and so on down to single words, where tokens never counted share the mass that Good and Turing estimate for them.  The
discounts d are found for each length apart.  The backoff weights follow from exact sums over everything counted after a
context, so that every context sums to 1.

Documents are tokenized once, into blocks of some two million tokens that are written to the shared folder.  Length after
length, each block deals its different n-grams, sorted and packed, to buckets by context.  A bucket sees all that follows
its contexts: it adds up counts and sends each block, in the order of what came, the counts of its n-grams and the sums of
its contexts.  These answers are the model's tables, kept in parts by length, bucket and block.  From those of the shorter
lengths a block knows what the next one needs; from all of them it scores its documents, recursively for each token.

What a block sends has each n-gram once, however often and in however many documents it occurs.  A context with more than
``HOT_TOKENS`` tokens after it (or a 100,000th of all, if that is more) is split over several buckets by what follows it;
the sums of its slices, less than three for each 100,000th of the corpus, are added up and sent to all tasks.
"""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.llm import katz_lm
from titlepulse.llm.common import word_hashes
from titlepulse.sources.shared import fresh_path, shuffles_dropped, stage, staging_root

BLOCK_TOKENS = 2_000_000
BUCKET_TOKENS = 2_000_000
LEAST_BUCKETS = 24
HOT_TOKENS = 1_000_000
HOT_SHARE = 100_000
NO_BACKOFF = 1e-300
RARE = katz_lm.DISCOUNTED
BLOCKS = "block long, size long, about binary, words binary, tokens binary"
SENT = "bucket long, block long, payload binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in the narrowest type, bytes of equal weight together, compressed."""
    parts = []
    for array in arrays:
        if array.dtype.kind in "iu":
            low, high = (int(array.min()), int(array.max())) if len(array) else (0, 0)
            array = array.astype(np.min_scalar_type(high) if low >= 0 else np.int64)
        parts.append((array.dtype.str, np.ascontiguousarray(array.view(np.uint8).reshape(len(array), array.itemsize).T).tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    out = []
    for kind, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(kind))
    return out


def mixed(*columns: np.ndarray) -> np.ndarray:
    """A hash of each row of whole numbers, the same in all tasks."""
    out = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        out = (out ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def bits(values: np.ndarray) -> int:
    return int(values.max()).bit_length() if len(values) else 0


def in_order(keys: np.ndarray):
    """``(order, sorted)``: the places of the keys in order, equal ones as they come, and the keys in it.

    A key and its place are sorted as one number where 64 bits hold both, which is several times as fast.
    """
    width = max(len(keys) - 1, 0).bit_length()
    if bits(keys) + width > 64:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    both = keys << np.uint64(width)
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    return (both & np.uint64((1 << width) - 1)).view(np.int64), both >> np.uint64(width)


def paired(left: np.ndarray, right: np.ndarray):
    """``(pairs, width)``: both, below 2^32, in one number with ``width`` bits for the right one, ordered by left and right."""
    width = bits(right)
    return left.astype(np.uint64) << np.uint64(width) | right.astype(np.uint64), width


def numbered(left: np.ndarray, right: np.ndarray):
    """``(first, number)``: a row of each different pair, in order, and which pair each row is.  Both below 2^32."""
    order, pairs = in_order(paired(left, right)[0])
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    number = np.empty(len(pairs), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def below_32_bits(values: np.ndarray) -> np.ndarray:
    """The values themselves if they are, or else their places in order."""
    return values if not len(values) or values.max() < 1 << 32 else np.unique(values, return_inverse=True)[1]


def write_blocks(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        held, tokens, count = [], 0, 0

        def row():
            ids, out, hashes = zip(*held)
            words, at = np.unique(np.concatenate(hashes), return_inverse=True)
            null = np.array([i is None for i in ids])
            about = pack(np.array([i or 0 for i in ids], np.int64), null, np.array(out), np.array([len(h) for h in hashes]))
            values = [(TaskContext.get().partitionId() << 32) + count, tokens, about, pack(words), pack(at)]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["block", "size", "about", "words", "tokens"])

        for doc_id, words in katz_lm.documents(batches):
            held.append((doc_id, katz_lm.held_out(doc_id), word_hashes(words)))
            tokens += len(words)
            if tokens >= size:
                yield row()
                held, tokens, count = [], 0, count + 1
        if held:
            yield row()

    return stage(katz_lm.bare(docs).mapInArrow(run, BLOCKS), "blocks")


class Totals:
    """What all tasks know: the sums over all words, and for each longer length the discounts and the sums of split contexts."""

    def __init__(self, buckets: int, hot: int):
        self.buckets, self.hot = buckets, hot
        self.total = self.types = self.once = self.documents = 0
        self.factors: dict[int, np.ndarray] = {}
        self.split: dict[int, dict[tuple, np.ndarray]] = {}

    @property
    def spare(self) -> int:
        """As many tokens as there are words seen once are held for words not seen."""
        return max(1, self.once)

    def mass(self, k: int, n: np.ndarray) -> np.ndarray:
        return np.where(n <= RARE, self.factors[k][np.minimum(n, RARE)] * n, n)


def words_sent(rows: pd.DataFrame, totals: Totals):
    """A block's words, with the times they occur in its training documents."""
    for row in rows.itertuples():
        (words,), (tokens,) = unpack(row.words), unpack(row.tokens)
        _, _, out, lengths = unpack(row.about)
        n = np.bincount(tokens[np.repeat(~out, lengths)], minlength=len(words))
        bucket = (mixed(words) % np.uint64(totals.buckets)).astype(np.int64)
        for b in np.unique(bucket):
            yield int(b), int(row.block), pack(words[bucket == b], n[bucket == b])


def words_answered(bucket: int, sent: pd.DataFrame, totals: Totals):
    """Counts, and a number for each word: different ones in all buckets, small ones for frequent words, 0 for none."""
    parts = [unpack(p) for p in sent["payload"]]
    words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.bincount(at, np.concatenate([p[1] for p in parts]), len(words)).astype(np.int64)
    ids = np.empty(len(words), np.int64)
    ids[np.lexsort((words, -n))] = np.arange(len(words)) * totals.buckets + bucket + 1
    ends = np.cumsum([len(p[0]) for p in parts])
    for block, mine in zip(sent["block"], np.split(at, ends[:-1])):
        yield block, pack(n[mine], ids[mine])
    end = n[words == word_hashes([katz_lm.END])[0]].sum()
    yield -1, pack(np.array([n.sum(), (n > 0).sum(), (n == 1).sum(), end]))


def number_words(row, answers: list[bytes], buckets: int):
    """The block with the words' numbers and counts in place of their hashes, frequent words first."""
    (words,), (tokens,) = unpack(row.words), unpack(row.tokens)
    bucket = (mixed(words) % np.uint64(buckets)).astype(np.int64)
    n, ids = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
    for b, payload in zip(np.unique(bucket), answers, strict=True):
        n[bucket == b], ids[bucket == b] = unpack(payload)
    order = np.argsort(ids)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words)) + 1
    return row.block, row.size, row.about, pack(np.diff(ids[order], prepend=0), n[order]), pack(place[tokens])


class Block:
    """A block's tokens, and for each length its different n-grams and contexts with what has been answered about them."""

    def __init__(self, row, totals: Totals, answers: dict[int, list[bytes]]):
        self.totals = totals
        ids, n = unpack(row.words)
        (tokens,) = unpack(row.tokens)
        self.doc_ids, self.null, self.out, self.lengths = unpack(row.about)
        self.training = np.repeat(~self.out, self.lengths)
        # Words by their number; 0 is the beginning.
        self.ids = np.concatenate([[0], np.cumsum(ids, dtype=np.int64)])
        self.word = tokens.astype(np.int64)
        starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self.later = np.ones(len(tokens), bool)
        self.later[starts] = False
        n = np.concatenate([[totals.documents], n.astype(np.int64)])
        self.known = n[self.word]
        # For the length reached: which gram each token ends, counts, probabilities, and what these are made of.
        self.gram = self.word
        self.n, self.p = n, np.where(n > 0, n, totals.spare) / (totals.total + totals.spare)
        self.lower = n, np.full(len(n), float(totals.total + totals.spare))
        self.k = 1
        while self.k + 1 in answers:
            self.lengthen()
            self.read(answers[self.k])

    def lengthen(self) -> None:
        """On to the n-grams with one word more."""
        self.k += 1
        # The context of a token is the gram that ends one before it; number 0 is that of a document's first token.
        context = np.where(self.later, np.roll(self.gram, 1) + 1, 0)
        # The contexts by their words, last one first.
        grams = np.arange(len(self.n))[:, None] if self.k == 2 else np.column_stack([self.last, self.context_words[self.of]])
        self.context_words = np.concatenate([np.zeros((1, self.k - 1), np.int64), grams])
        self.follow = np.concatenate([[self.totals.documents], self.n])
        first, gram = numbered(self.word, context)
        self.shorter, self.gram = self.gram[first], gram
        self.of, self.last = context[first], self.word[first]
        self.count = np.bincount(gram[self.training], minlength=len(first))
        self.hot = self.follow > self.totals.hot
        buckets = np.uint64(self.totals.buckets)
        base = mixed(*(self.ids[c] for c in self.context_words.T))
        self.bucket = (base % buckets).astype(np.min_scalar_type(self.totals.buckets))[self.of]
        cut = np.flatnonzero(self.hot[self.of])
        slice_ = mixed(self.ids[self.last[cut]]) % (2 * self.follow[self.of[cut]] // self.totals.hot).astype(np.uint64)
        self.bucket[cut] = (base[self.of[cut]] + slice_) % buckets
        # By bucket, context and last word.
        keys, width = paired(self.bucket, self.of)
        order, keys = in_order(keys)
        self.pieces = np.split(order, np.flatnonzero(np.diff(keys >> np.uint64(width))) + 1)

    def send(self):
        """The n-grams of the length reached, by bucket: contexts, how many words follow each, the words, their counts, and the shorter grams'."""
        for rows in self.pieces:
            heads = np.flatnonzero(np.diff(self.of[rows], prepend=-1))
            contexts = self.of[rows[heads]]
            columns = [self.ids[c] for c in self.context_words[contexts].T]
            columns[0] = np.diff(columns[0], prepend=0)
            n, size = self.lower
            runs = np.diff(np.append(heads, len(rows)))
            short = self.shorter[rows]
            payload = pack(*columns, self.hot[contexts], runs, self.ids[self.last[rows]], self.count[rows], n[short], size[short[heads]])
            yield int(self.bucket[rows[0]]), payload

    def read(self, answers: list[bytes]) -> None:
        """Take in what the buckets have answered."""
        totals, k = self.totals, self.k
        total = np.zeros(len(self.of), np.int64)
        divisor, backoff = np.ones(len(self.context_words)), np.ones(len(self.context_words))
        weights = totals.factors[k][1:] * np.arange(1, RARE + 1)

        def settle(contexts, all_, counts, big, seen, full):
            """Contexts nothing was counted after keep 1 for both."""
            mass = big + sum(w * c for w, c in zip(weights, counts))
            # A context that would leave nothing is given one more, unseen; one that has everything after it stored has
            # nothing to back off to, and the stored share all.
            size = all_ + (mass > all_ * (1 - 1e-9))
            there = all_ > 0
            divisor[contexts] = np.where(there, np.where(full, mass, size), 1.0)
            rest = np.where(full | ~there, 1.0, 1 - seen)
            backoff[contexts] = np.where(there, np.where(full, NO_BACKOFF, (1 - mass / np.where(there, size, 1)) / rest), 1.0)

        for rows, payload in zip(self.pieces, answers, strict=True):
            contexts = self.of[rows[np.flatnonzero(np.diff(self.of[rows], prepend=-1))]]
            total[rows], all_, *counts, big, full, asked, found = unpack(payload)
            seen = np.zeros(len(contexts))
            seen[asked] = found
            settle(contexts, all_.astype(float), counts, big, seen, full)
        cut = np.flatnonzero(self.hot)
        if len(cut):
            nothing = np.zeros(RARE + 3)
            words = map(tuple, np.column_stack([self.ids[c] for c in self.context_words[cut].T]).tolist())
            all_, *counts, big, seen = np.array([totals.split[k].get(w, nothing) for w in words]).T
            settle(cut, all_, counts, big, seen, 1 - seen < 1e-12)
        own = totals.mass(k, total) / divisor[self.of]
        self.p = np.where(total > 0, own, backoff[self.of] * self.p[self.shorter])
        self.n, self.lower = total, (total, divisor[self.of])

    def scores(self) -> pd.DataFrame:
        totals, n = self.totals, self.known
        document = np.repeat(np.arange(len(self.lengths)), self.lengths)
        add = lambda values: np.bincount(document, values, len(self.lengths))
        return pd.DataFrame({
            "doc_id": pd.array([None if none else int(i) for i, none in zip(self.doc_ids, self.null)], "Int64"),
            "held_out": self.out, "n_tokens": self.lengths.astype(np.int64), "n_known": add(n > 0).astype(np.int64),
            "base_score": add(np.log10((n + 1) / (totals.total + totals.types + 1))), "score": add(np.log10(self.p)[self.gram]),
        })


def grams_answered(k: int, sent: pd.DataFrame, totals: Totals):
    """A bucket's counts and sums of length ``k``, for each block in the order of what it sent."""
    parts = [unpack(p) for p in sent["payload"]]
    for part in parts:
        part[0] = np.cumsum(part[0])
    *columns, hot, runs, words, counts, short, size = map(np.concatenate, zip(*parts))
    context = np.zeros(len(hot), np.int64)
    for column in columns:
        first, context = numbered(context, below_32_bits(column))
    of = np.repeat(context, runs)
    shown, gram = numbered(of, below_32_bits(words))
    n = np.bincount(gram, counts, len(shown)).astype(np.int64)
    p = totals.mass(k - 1, short[shown]) / np.repeat(size, runs)[shown]
    of = of[shown]
    add = lambda values: np.bincount(of, values, len(first))
    seen = add(np.where(n > 0, p, 0))
    sums = [x.astype(np.int64) for x in (add(n), *[add(n == r) for r in range(1, RARE + 1)], add(np.where(n > RARE, n, 0)))]
    full = 1 - seen < 1e-12
    contexts = np.split(context, np.cumsum([len(part[0]) for part in parts])[:-1])
    grams = np.split(gram, np.cumsum([len(part[k + 1]) for part in parts])[:-1])
    for block, part, c, g in zip(sent["block"], parts, contexts, grams):
        # What a context has seen is asked for where it has to back off.
        asked = np.bincount(np.repeat(np.arange(len(c)), part[k]), n[g] == 0, len(c)) > 0
        yield block, pack(n[g], *[x[c] for x in sums], full[c], asked, seen[c[asked]])
    cut = first[hot[first]]
    yield -1, pack(np.bincount(np.minimum(n, RARE + 2), minlength=RARE + 3)[: RARE + 2], *[x[cut] for x in columns], *[x[context[cut]] for x in sums], seen[context[cut]])


def learn(k: int, blocks: DataFrame, answers: DataFrame | None, totals: Totals, tasks: int) -> DataFrame:
    """The answers of length ``k``, as a table; ``totals`` takes in the sums over all of them."""
    known = blocks.sparkSession.sparkContext.broadcast(totals)

    def send_words(batches):
        for rows in batches:
            yield pd.DataFrame(list(words_sent(rows, known.value)), columns=["bucket", "block", "payload"])

    def send(rows, answered):
        block = opened(rows, answered, known.value)
        block.lengthen()
        return pd.DataFrame([(bucket, rows["block"][0], payload) for bucket, payload in block.send()], columns=["bucket", "block", "payload"])

    def answer(key, sent):
        sent = sent.sort_values("block", ignore_index=True)
        found = words_answered(key[0], sent, known.value) if k == 1 else grams_answered(k, sent, known.value)
        return pd.DataFrame([(k, key[0], block, payload) for block, payload in found], columns=["level", "bucket", "block", "payload"])

    if k == 1:
        sent = blocks.mapInPandas(send_words, SENT)
    else:
        sent = with_answers(blocks, answers, tasks, send, SENT)
    found = sent.repartition(totals.buckets, "bucket").groupBy("bucket").applyInPandas(answer, f"level int, {SENT}")
    found = stage(found, f"answers-{k}")
    own = [unpack(r["payload"]) for r in found.where("block = -1").select("payload").collect()]
    if k == 1:
        for (part,) in own:
            totals.total, totals.types, totals.once, totals.documents = (int(a) + int(b) for a, b in zip((totals.total, totals.types, totals.once, totals.documents), part))
        totals.factors[1] = np.ones(RARE + 1)
        return found
    histogram = sum((part[0].astype(np.int64) for part in own), np.zeros(RARE + 2, np.int64))
    totals.factors[k] = np.array(katz_lm.discounts({r: int(histogram[r]) for r in range(1, RARE + 2)}))
    split: dict[tuple, np.ndarray] = {}
    for part in own:
        for row in zip(*part[1:]):
            context = tuple(int(x) for x in row[: k - 1])
            split[context] = split.get(context, 0) + np.array(row[k - 1 :], float)
    totals.split[k] = split
    return found


def with_answers(blocks: DataFrame, answers: DataFrame | None, tasks: int, function, schema: str) -> DataFrame:
    """``function(block, its answers)`` for each block, which is read where it lies if the table is bucketed."""
    blocks = blocks.groupBy("block")
    if answers is None:
        return blocks.applyInPandas(lambda rows: function(rows, None), schema)
    return blocks.cogroup(answers.where("block >= 0").repartition(tasks, "block").groupBy("block")).applyInPandas(function, schema)


def opened(rows: pd.DataFrame, answered: pd.DataFrame | None, totals: Totals) -> Block:
    answers = {}
    if answered is not None:
        answers = {k: list(part) for k, part in answered.sort_values(["level", "bucket"]).groupby("level")["payload"]}
    return Block(next(rows.itertuples()), totals, answers)


def numbered_blocks(docs: DataFrame, block_tokens: int, bucket_tokens: int, hot_tokens: int):
    """``(blocks, totals, tasks)``: the blocks as a table bucketed by block, so that later lengths do not move them.

    The blocks with hashes and the answers about words are deleted once it is written.
    """
    spark = docs.sparkSession
    path, name = fresh_path(spark, "numbered"), f"katz_blocks_{uuid.uuid4().hex}"
    with staging_root(spark, "hashed"):
        blocks = write_blocks(docs, block_tokens)
        count, size = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        tasks = max(LEAST_BUCKETS, 2 * count)
        totals = Totals(max(LEAST_BUCKETS, size // bucket_tokens), max(hot_tokens, size // HOT_SHARE))
        answers = learn(1, blocks, None, totals, tasks)
        buckets = totals.buckets

        def run(rows, answered):
            row = number_words(next(rows.itertuples()), list(answered.sort_values("bucket")["payload"]), buckets)
            return pd.DataFrame([row], columns=list(rows.columns))

        with_answers(blocks.repartition(tasks, "block"), answers, tasks, run, BLOCKS).write.bucketBy(tasks, "block").option("path", path).saveAsTable(name)
    return spark.table(name), totals, tasks


def score(docs: DataFrame, order: int, block_tokens: int = BLOCK_TOKENS, bucket_tokens: int = BUCKET_TOKENS, hot_tokens: int = HOT_TOKENS) -> DataFrame:
    """The columns of ``katz_lm.score``."""
    answers = None
    with shuffles_dropped(docs.sparkSession):
        blocks, totals, tasks = numbered_blocks(docs, block_tokens, bucket_tokens, hot_tokens)
        for k in range(2, order + 1):
            found = learn(k, blocks, answers, totals, tasks)
            answers = found if answers is None else answers.unionAll(found)
    known = docs.sparkSession.sparkContext.broadcast(totals)

    def run(rows, answered):
        return opened(rows, answered, known.value).scores()

    scored = with_answers(blocks, answers, tasks, run, SCORES)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.total).cast("long").alias("train_tokens"), "base_score", "score")
