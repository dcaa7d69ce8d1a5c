"""Alignment of two tokenizers' tokens over whole texts, and the counts of the id pairs that they link.

Both tokenizers cover the bytes of one blank and the text.  Where tokens of both end at one byte, the tokens are cut into groups;
two tokens are linked where their byte ranges overlap.  A pair's count is the number of links in the whole corpus
that link its two ids.

**Fragments.**  A long document is dealt into byte ranges; a token belongs to the range in which it ends.  A range alone
knows its common ends, so it yields a ``Fragment``: an open prefix (tokens up to its first common end), closed
groups, and an open suffix (tokens after the last one); without a common end, all of it is prefix.  Fragments that
follow each other compose: the left suffix and the right prefix become a closed group, unless one of them has
no common end.  This is associative, so Spark reduces the fragments of a document as a tree: each level brings up
to ``FAN`` neighbouring ranges of a document together in a group of its own.  Closed groups of a range do not
travel: they stay where they are, only what is open, and the groups closed by composition, go up.  A range and a group of
the tree are all that a task holds of a document, whatever its length.  Texts beyond ``SEGMENT_CHARS`` are also tokenized in
segments, on any executor: cut at a single blank between two other characters, where both tokenizers give the same ids as for the whole
text.  For the first, the pattern that splits texts always splits there; for the second, none of its pieces has
a blank after another character, which is verified (else texts stay whole).

**Counts.**  Token ids are written once, two bytes each, and read twice: to count pairs (each task sends a sum for each pair it has seen)
and to look the counts up.  The ``CACHED_PAIRS`` most frequent pairs are held by every task; links of other pairs, which are rare, are joined to
the table of counts by shuffle.  That changes the work, not the result.

Null and empty texts, and texts that either tokenizer does not give back byte for byte, have no tokens: zeros and
an empty digest; they count nowhere.  The strings of special tokens are plain text.  Texts of any length are read whole.  Every row is a document of its own,
also where ids are repeated or null.  An empty table gives an empty result.  Further columns, whatever their names, are left out.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlepulse.llm.common import arrow_map, least_count
from titlepulse.llm.packing import encoder, tokenizer_path
from titlepulse.sources.shared import fresh_path, stage

SEGMENT_CHARS = 1 << 16
RANGE_BYTES = 1 << 15
FAN = 16
CACHED_PAIRS = 1 << 20
CHUNK_TOKENS = 400_000  # tokens that are aligned at once

_BLANK = "▁"
_CUT = re.compile(rf"(?<=[^\s{_BLANK}]) (?=\S)")


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# ---- tokenizers ----------------------------------------------------------------------------------------------


class Vocabularies:
    """Both tokenizers: ids of a text that starts with one blank, and the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = encoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.b_bytes = [
            b"" if self.b.is_control(n) or self.b.is_unknown(n)
            else bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace(_BLANK, " ").encode()
            for n, p in enumerate(pieces)
        ]
        self.a_size, self.b_size = self.a.n_vocab, len(pieces)
        self.a_length = np.zeros(self.a_size, np.int64)
        for token in self.a.token_byte_values():
            self.a_length[self.a.encode_single_token(token)] = len(token)
        self.b_length = np.fromiter(map(len, self.b_bytes), np.int64, self.b_size)
        self.separable = not any(_BLANK in p.lstrip(_BLANK) for p in pieces)
        self.kind = "<u2" if max(self.a_size, self.b_size) <= 1 << 16 else "<u4"
        # Decimal ids with each separator after them: none, comma, bar, semicolon.
        self.decimals = [f"{n}{mark}" for mark in ("", ",", "|", ";") for n in range(max(self.a_size, self.b_size))]

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text whose first character is the blank; None where either side does not give its bytes back."""
        data = text.encode("utf-8", "surrogatepass")
        a, b = self.a.encode_ordinary(text), self.b.encode(text[1:])
        if self.a.decode_bytes(a) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


@functools.lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def segments_of(text: str, most: int, separable: bool) -> Iterator[str]:
    """The text with its blank, cut where both tokenizers split anyway; every segment starts with a blank."""
    whole, start = " " + text, 0
    while separable and len(whole) - start > most:
        cut = _CUT.search(whole, start + most)
        if cut is None:
            break
        yield whole[start : cut.start()]
        start = cut.start()
    yield whole[start:]


# ---- fragments -----------------------------------------------------------------------------------------------

Tokens = tuple[tuple[int, ...], tuple[int, ...]]
NONE: Tokens = ((), ())


def _then(left: Tokens, right: Tokens) -> Tokens:
    return left[0] + right[0], left[1] + right[1]


@dataclass(frozen=True)
class Fragment:
    """Neighbouring tokens of a document.  ``cut``: they hold a common end; else all of them are in ``prefix``.

    ``at`` is the place of the range with the first common end.  ``closed`` lists the groups that composition has
    closed, each with the place of the range whose common end closes it.
    """

    place: int
    ok: bool = True
    cut: bool = False
    prefix: Tokens = NONE
    suffix: Tokens = NONE
    at: int = -1
    closed: tuple[tuple[int, Tokens], ...] = field(default=())

    def __add__(self, right: Fragment) -> Fragment:
        place, ok = min(self.place, right.place), self.ok and right.ok
        if not self.cut:
            return Fragment(place, ok, right.cut, _then(self.prefix, right.prefix), right.suffix, right.at, right.closed)
        if not right.cut:
            return Fragment(place, ok, True, self.prefix, _then(self.suffix, right.prefix), self.at, self.closed)
        between = _then(self.suffix, right.prefix)
        closed = (*self.closed, *([(right.at, between)] if between != NONE else []), *right.closed)
        return Fragment(place, ok, True, self.prefix, right.suffix, self.at, closed)


def fragment_of(place: int, first: bool, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray):
    """A range's fragment, and the tokens of the groups that are closed inside it.  The document's start is a common end."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    tokens = lambda x, y: (tuple(x.tolist()), tuple(y.tolist()))
    if not first and not len(common):
        return Fragment(place, prefix=tokens(a, b)), (a[:0], b[:0])
    a0, b0 = (0, 0) if first else (np.searchsorted(a_ends, common[0]) + 1, np.searchsorted(b_ends, common[0]) + 1)
    a1, b1 = (np.searchsorted(a_ends, common[-1]) + 1, np.searchsorted(b_ends, common[-1]) + 1) if len(common) else (0, 0)
    return Fragment(place, True, True, tokens(a[:a0], b[:b0]), tokens(a[a1:], b[b1:]), place), (a[a0:a1], b[b0:b1])


_FRAGMENT = (
    "row long, doc_id long, place long, ok boolean, cut boolean, prefix_a array<int>, prefix_b array<int>, suffix_a array<int>, "
    "suffix_b array<int>, at long, closed array<struct<place: long, a: array<int>, b: array<int>>>"
)


def _fragment_columns(fragment: Fragment) -> dict:
    return {
        "place": fragment.place, "ok": fragment.ok, "cut": fragment.cut, "prefix_a": fragment.prefix[0], "prefix_b": fragment.prefix[1],
        "suffix_a": fragment.suffix[0], "suffix_b": fragment.suffix[1], "at": fragment.at, "closed": [{"place": p, "a": t[0], "b": t[1]} for p, t in fragment.closed],
    }


def _fragment_from(row: dict) -> Fragment:
    closed = tuple((c["place"], (tuple(c["a"]), tuple(c["b"]))) for c in row["closed"])
    tokens = lambda side: (tuple(row[f"{side}_a"]), tuple(row[f"{side}_b"]))
    return Fragment(row["place"], row["ok"], row["cut"], tokens("prefix"), tokens("suffix"), row["at"], closed)


def reduce_fragments(fragments: DataFrame, range_bytes: int) -> DataFrame:
    """One composed fragment per document (``row``), by a tree whose groups hold neighbouring ranges only."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(fragments.schema)

    def compose(key: tuple[pa.Scalar, ...], held: pa.Table) -> pa.Table:
        rows = sorted(held.to_pylist(), key=lambda row: row["place"])
        composed = functools.reduce(lambda a, b: a + b, map(_fragment_from, rows))
        return pa.Table.from_pylist([{"row": rows[0]["row"], "doc_id": rows[0]["doc_id"]} | _fragment_columns(composed)], schema=schema)

    last = fragments.agg(F.max("place")).first()[0] or 0
    width = range_bytes
    while True:
        width *= FAN
        fragments = fragments.groupBy("row", F.floor(F.col("place") / width).alias("_part")).applyInArrow(compose, _FRAGMENT)
        if width > last:
            return fragments


# ---- tokens --------------------------------------------------------------------------------------------------


def tokenized(docs: DataFrame, a_path: str, b_path: str, segment_chars: int, range_bytes: int) -> DataFrame:
    """A row per document or, of long ones, per byte range (``whole`` is false): the ids of its closed groups and its fragment."""
    bare = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    fields = "row long, doc_id long, place long, only boolean, text string"

    def split(batch):
        own = vocabularies(a_path, b_path)
        for row, doc_id, text in zip(*(batch.column(n).to_pylist() for n in ("row", "doc_id", "text"))):
            parts, place = list(segments_of(text, segment_chars, own.separable)), 0
            for part in parts:
                yield {"row": [row], "doc_id": [doc_id], "place": [place], "only": [len(parts) == 1], "text": [part]}
                place += len(part.encode("utf-8", "surrogatepass"))

    is_long = F.length("text") > segment_chars
    short = bare.where(~is_long).select("row", "doc_id", F.lit(0).cast("long").alias("place"), F.lit(True).alias("only"), F.concat(F.lit(" "), "text").alias("text"))
    # Segments of one text go to different tasks.
    long = arrow_map(bare.where(is_long), split, fields).repartition("row", "place")

    def encode(batch):
        own = vocabularies(a_path, b_path)
        out = []
        for row, doc_id, base, only, text in zip(*(batch.column(n).to_pylist() for n in ("row", "doc_id", "place", "only", "text"))):
            ids = own.ids(text) if len(text) > 1 else None
            about = {"row": row, "doc_id": doc_id, "a": b"", "b": b""}
            if ids is None:
                out.append(about | {"whole": only} | _fragment_columns(Fragment(base, ok=False)))
                continue
            a_ends, b_ends = (base + np.cumsum(length[x]) for length, x in zip((own.a_length, own.b_length), ids))
            if only and a_ends[-1] <= range_bytes:
                blobs = {n: x.astype(own.kind).tobytes() for n, x in zip("ab", ids)}
                out.append(about | blobs | {"whole": True} | _fragment_columns(Fragment(0, cut=True, at=0)))
            else:
                for n in range(base // range_bytes, (a_ends[-1] - 1) // range_bytes + 1):
                    edges = np.array([n, n + 1]) * range_bytes
                    (a0, a1), (b0, b1) = np.searchsorted(a_ends, edges, "right"), np.searchsorted(b_ends, edges, "right")
                    place = max(base, n * range_bytes)
                    fragment, closed = fragment_of(place, place == 0, ids[0][a0:a1], ids[1][b0:b1], a_ends[a0:a1], b_ends[b0:b1])
                    blobs = {name: x.astype(own.kind).tobytes() for name, x in zip("ab", closed)}
                    out.append(about | blobs | {"whole": False} | _fragment_columns(fragment))
            if len(out) >= 2000:
                yield {name: [row[name] for row in out] for name in out[0]}
                out = []
        if out:
            yield {name: [row[name] for row in out] for name in out[0]}

    encoded = arrow_map(short.unionAll(long), encode, f"{_FRAGMENT}, whole boolean, a binary, b binary")
    path = fresh_path(docs.sparkSession, "tokens")
    encoded.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(encoded.schema).parquet(path)


# ---- alignment -----------------------------------------------------------------------------------------------


class Aligned:
    """Pieces (runs of whole groups) put one after the other: every piece ends at a common end, so they are aligned at once."""

    def __init__(self, own: Vocabularies, a: list[bytes], b: list[bytes]):
        self.own = own
        width = np.dtype(own.kind).itemsize
        self.a = np.frombuffer(b"".join(a), own.kind).astype(np.int64)
        self.b = np.frombuffer(b"".join(b), own.kind).astype(np.int64)
        self.a_until, self.b_until = (np.cumsum([len(x) // width for x in side]) for side in (a, b))
        self.a_ends, self.b_ends = np.cumsum(own.a_length[self.a]), np.cumsum(own.b_length[self.b])
        # Where tokens end, by byte: cheaper than merging sorted ends.
        self.a_at, self.b_at = (np.zeros(self.a_ends[-1] + 1, bool) for _ in range(2))
        self.a_at[self.a_ends] = self.b_at[self.b_ends] = True
        self.ends = np.flatnonzero(self.a_at | self.b_at)
        self.common = np.flatnonzero(self.a_at & self.b_at)
        # An elementary range between two neighbouring ends is the overlap of exactly one pair of tokens.
        a_here, b_here = self.a_at[self.ends], self.b_at[self.ends]
        self.pairs = self.a[np.cumsum(a_here) - a_here] * own.b_size + self.b[np.cumsum(b_here) - b_here]
        bytes_until = self.a_ends[self.a_until - 1]
        self.links_until = np.searchsorted(self.ends, bytes_until, "right")
        self.groups_until = np.searchsorted(self.common, bytes_until, "right")

    def per_piece(self, values: np.ndarray) -> list[int]:
        """Sums of the links' values."""
        return np.add.reduceat(values.astype(np.int64), np.concatenate(([0], self.links_until[:-1]))).tolist()

    def texts(self) -> Iterator[str]:
        """``a1,a2|b1;a3|b2`` of each piece."""
        a_last, b_last = self.b_at[self.a_ends], self.a_at[self.b_ends]  # in their groups
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        marks = len(self.own.decimals) // 4
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.searchsorted(b_group, a_group, "left")] = self.a + marks * np.where(a_last, 2, 1)
        codes[np.arange(len(self.b)) + np.searchsorted(a_group, b_group, "right")] = self.b + marks * np.where(b_last, 3, 1)
        until = self.a_until + self.b_until
        codes[until - 1] %= marks  # nothing follows the last token
        table, start = self.own.decimals, 0
        for end in until.tolist():
            yield "".join(map(table.__getitem__, codes[start:end].tolist()))
            start = end


def _in_chunks(own: Vocabularies, batches: Iterable[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[dict[str, list], Aligned]]:
    """Pieces with tokens, so many at once that about ``CHUNK_TOKENS`` tokens are held, and their other columns."""
    for batch in batches:
        a, b = (batch.column(n).to_pylist() for n in "ab")
        others = {n: batch.column(n).to_pylist() for n in names}
        start, size = 0, 0
        for n in range(len(a)):
            size += len(a[n])
            if size >= 2 * CHUNK_TOKENS or n == len(a) - 1:
                yield {name: values[start : n + 1] for name, values in others.items()}, Aligned(own, a[start : n + 1], b[start : n + 1])
                start, size = n + 1, 0


@dataclass
class Alignment:
    """``tokens`` per document or range, ``pieces`` of long documents, ``counts`` of pairs."""

    tokens: DataFrame  # of tokenized()
    failed: DataFrame  # row, doc_id: long documents without tokens
    pieces: DataFrame  # row, doc_id, place, kind (0: closed by composition, 1: closed inside its range), a, b
    counts: DataFrame  # a_id, b_id, n, best
    a_path: str
    b_path: str
    cached_pairs: int

    def runs(self) -> DataFrame:
        """``row, doc_id, place, kind, a, b`` of all documents' closed groups; ids as packed numbers."""
        return _whole(self.tokens).select("row", "doc_id", "place", F.lit(1).alias("kind"), "a", "b").unionAll(self.pieces)

    def groups(self) -> DataFrame:
        """``row, doc_id, place, kind, a_ids, b_ids, a_sizes, b_sizes``: the ids of a run, and of each of its groups how many are its own."""
        a_path, b_path = self.a_path, self.b_path

        def unpack(batches):
            own = vocabularies(a_path, b_path)
            for batch in batches:
                for one in (batch.slice(n, 1) for n in range(batch.num_rows)):
                    for held, run in _in_chunks(own, [one], ("row", "doc_id", "place", "kind")):
                        edges = [np.searchsorted(ends, run.common, "right") for ends in (run.a_ends, run.b_ends)]
                        sizes = [np.diff(e, prepend=0).tolist() for e in edges]
                        values = held | {"a_ids": [run.a.tolist()], "b_ids": [run.b.tolist()], "a_sizes": [sizes[0]], "b_sizes": [sizes[1]]}
                        yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int32() if n == "kind" else pa.int64() if n in held else pa.list_(pa.int32())) for n, v in values.items()})

        return self.runs().mapInArrow(unpack, "row long, doc_id long, place long, kind int, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>")


def _whole(tokens: DataFrame) -> DataFrame:
    return tokens.where("whole and ok")


def align(
    docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
    segment_chars: int = SEGMENT_CHARS, range_bytes: int = RANGE_BYTES, cached_pairs: int = CACHED_PAIRS,
) -> Alignment:
    """Tokens, groups and pair counts of the whole table."""
    a_path, b_path = a_path or tokenizer_path(), b_path or piece_path()
    tokens = tokenized(docs, a_path, b_path, segment_chars, range_bytes)
    parts = tokens.where("not whole")
    reduced = stage(reduce_fragments(parts.select(*[c for c in parts.columns if c not in ("whole", "a", "b")]), range_bytes), "fragments")
    kind = vocabularies(a_path, b_path).kind

    def pack(batch):
        packed = lambda side: [np.array(ids.as_py(), kind).tobytes() for ids in batch.column(side)]
        yield {n: batch.column(n).to_pylist() for n in ("row", "doc_id", "place", "kind")} | {"a": packed("a"), "b": packed("b")}

    closed = reduced.where("ok").select("row", "doc_id", F.inline("closed")).select("row", "doc_id", "place", F.lit(0).alias("kind"), "a", "b")
    inside = parts.where("length(a) > 0").join(reduced.where("ok").select("row"), "row", "left_semi")
    pieces = arrow_map(closed, pack, "row long, doc_id long, place long, kind int, a binary, b binary").unionAll(
        inside.select("row", "doc_id", "place", F.lit(1).alias("kind"), "a", "b")
    )
    result = Alignment(tokens, reduced.where("not ok").select("row", "doc_id"), stage(pieces, "pieces"), None, a_path, b_path, cached_pairs)
    result.counts = stage(_counts(result), "pair-counts")
    return result


def _counts(aligned: Alignment) -> DataFrame:
    a_path, b_path = aligned.a_path, aligned.b_path
    b_size = vocabularies(a_path, b_path).b_size

    def count(batches):
        for _, run in _in_chunks(vocabularies(a_path, b_path), batches, ()):
            pairs, n = np.unique(run.pairs, return_counts=True)
            yield pa.RecordBatch.from_pydict({"pair": pairs, "n": n.astype(np.int64)})

    counted = aligned.runs().select("a", "b").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    ids = counted.select(F.floor(F.col("pair") / b_size).cast("int").alias("a_id"), F.pmod("pair", F.lit(b_size)).cast("int").alias("b_id"), "n")
    return ids.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b_id")))


def _cached(aligned: Alignment) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], bool]:
    """The most frequent pairs, at most ``cached_pairs``: sorted pairs, counts, whether best; and whether there are others."""
    b_size = vocabularies(aligned.a_path, aligned.b_path).b_size
    total = aligned.counts.count()
    held = aligned.counts
    if total > aligned.cached_pairs:
        held = held.where(F.col("n") >= least_count(held, aligned.cached_pairs))
    found = held.select((F.col("a_id").cast("long") * b_size + F.col("b_id")).alias("pair"), "n", "best").toArrow().sort_by("pair")
    return tuple(found.column(c).to_numpy() for c in ("pair", "n", "best")), found.num_rows < total


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def documents(aligned: Alignment) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per document."""
    spark = aligned.tokens.sparkSession
    a_path, b_path = aligned.a_path, aligned.b_path
    arrays, rare = _cached(aligned)
    held = spark.sparkContext.broadcast(arrays)

    def look_up(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each link: whether its pair is held, its count, whether it is best; zeros where it is not held."""
        known, n, best = held.value
        if not len(known):
            return np.zeros(len(pairs), bool), np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
        there = known[at] == pairs
        return there, np.where(there, n[at], 0), there & best[at]

    def measured(batches, digested: bool):
        own = vocabularies(a_path, b_path)
        for about, run in _in_chunks(own, batches, ("row", "doc_id", "place", "kind")):
            _, n, best = look_up(run.pairs)
            each = lambda until: np.diff(until, prepend=0).tolist()
            texts = run.texts()
            out = about | {
                "n_a": each(run.a_until), "n_b": each(run.b_until), "n_groups": each(run.groups_until), "n_links": each(run.links_until),
                "n_best": run.per_piece(best), "count_sum": run.per_piece(n),
                "text": [hashlib.sha256(t.encode()).hexdigest() for t in texts] if digested else list(texts),
            }
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.string() if k == "text" else pa.int32() if k == "kind" else pa.int64()) for k, v in out.items()})

    schema = "row long, doc_id long, place long, kind int, " + ", ".join(f"{n} long" for n in _NUMBERS) + ", text string"
    whole = _whole(aligned.tokens).select("row", "doc_id", "place", F.lit(1).alias("kind"), "a", "b").mapInArrow(lambda batches: measured(batches, True), schema)
    short = whole.select("row", "doc_id", *_NUMBERS, F.col("text").alias("groups_sha256"))

    def in_order(batches):
        """Adds up the pieces of each document, which come in order, and hashes their texts as they come."""
        row, sums, digest = None, None, None
        for batch in batches:
            for piece in batch.to_pylist():
                if row is None or piece["row"] != row["row"]:
                    if row is not None:
                        yield row, sums, digest
                    row, sums, digest = piece, [0] * len(_NUMBERS), None
                if digest is None:
                    digest = hashlib.sha256()
                else:
                    digest.update(b";")
                digest.update(piece["text"].encode())
                sums = [total + piece[n] for total, n in zip(sums, _NUMBERS)]
        if row is not None:
            yield row, sums, digest

    def joined(batches):
        for row, sums, digest in in_order(batches):
            values = {"row": row["row"], "doc_id": row["doc_id"]} | dict(zip(_NUMBERS, sums)) | {"groups_sha256": digest.hexdigest()}
            yield pa.RecordBatch.from_pydict({k: pa.array([v], pa.string() if k == "groups_sha256" else pa.int64()) for k, v in values.items()})

    pieces = aligned.pieces.mapInArrow(lambda batches: measured(batches, False), schema)
    ordered = pieces.repartition("row").sortWithinPartitions("row", "place", "kind")
    long = ordered.mapInArrow(joined, "row long, doc_id long, " + ", ".join(f"{n} long" for n in _NUMBERS) + ", groups_sha256 string")
    without = aligned.tokens.where("whole and not ok").select("row", "doc_id").unionAll(aligned.failed)
    zeros = without.select("row", "doc_id", *[F.lit(0).cast("long").alias(n) for n in _NUMBERS], F.lit("").alias("groups_sha256"))
    found = short.unionAll(long).unionAll(zeros)

    if rare:
        found = _with_rare(aligned, found, look_up)
    return found.drop("row")


def _with_rare(aligned: Alignment, found: DataFrame, look_up) -> DataFrame:
    """Add what the links of pairs that no task holds contribute: they meet their counts in a shuffle."""
    a_path, b_path = aligned.a_path, aligned.b_path
    b_size = vocabularies(a_path, b_path).b_size

    def others(batches):
        for about, run in _in_chunks(vocabularies(a_path, b_path), batches, ("row",)):
            there, _, _ = look_up(run.pairs)
            rows = np.repeat(np.array(about["row"], np.int64), np.diff(run.links_until, prepend=0))
            yield pa.RecordBatch.from_pydict({"row": rows[~there], "pair": run.pairs[~there]})

    links = aligned.runs().select("row", "a", "b").mapInArrow(others, "row long, pair long").groupBy("row", "pair").agg(F.count(F.lit(1)).alias("_times"))
    counts = aligned.counts.select((F.col("a_id").cast("long") * b_size + F.col("b_id")).alias("pair"), "n", "best")
    further = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("_times") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("_times") * F.col("n")).alias("_sum")
    )
    added = {"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}
    return found.join(further, "row", "left").withColumns(added).drop("_best", "_sum")
