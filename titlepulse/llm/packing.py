"""Packing by shortest-pack-first over the length histogram.

A document is cut at every ``width`` tokens; full pieces are sequences of their own.  The histogram of the other
pieces' lengths, at most ``width`` numbers, is all that the driver sees.  Lengths are placed longest first, each into
the open pattern that is shortest so far (with most room), as often as it fits, and a pattern's count is split where
only some of its packs get the length.  A pattern is a tuple of lengths with a count, so the work follows the number of different
lengths and not of documents.  Then every piece gets its rank among the pieces of its length, and an interval of
ranks belongs to each place in a pattern.

``pack_mixed`` does this inside windows of the order of a mix (``mixing.mix``): consecutive slots with at least
``WINDOW_DOCS`` documents are packed among themselves, and the sequences of earlier windows come first.  Inside a window, pieces of
one length are ranked in the order of the mix.  A window's histogram is packed in its own task.

Null texts are empty: one end token.  A null id stays null.  A text of any length is tokenized whole, in one
call.  Rows with the same id and text are interchangeable.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.llm.common import arrow_map, rank_in_groups
from titlepulse.sources.shared import stage

WIDTH, END = 2048, 1
WINDOW_SLOTS, WINDOW_DOCS = 16, 16_384


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level BPE of a ``tokenizers`` file, run by tiktoken, which is four times as fast with equal ids.

    The file's added tokens are special tokens here: found in a text before it is split, if ``encode`` allows them.

    A byte-level vocabulary writes each byte as one printable character: itself where it is printable, else the next
    free character from 256 on.  A token's rank is its id, as merges are listed in the order of ids.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    vocabulary, added = read["model"]["vocab"], read["added_tokens"]
    if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that take part in their surroundings have no counterpart in tiktoken")
    special = {token["content"]: token["id"] for token in added}
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
    ranks = {bytes(byte_of[c] for c in token): n for token, n in vocabulary.items() if all(c in byte_of for c in token)}
    for content in special:
        ranks.pop(content.encode(), None)
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def pieces(docs: DataFrame, path: str | None = None, width: int = WIDTH, added: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, order_key`` per piece; the key orders pieces of one length.

    Whole numbers of the documents in the columns ``carried`` go with their pieces.

    With ``added``, an added token of the file that a text spells out has the id of that token, as in
    ``Tokenizer.encode``; without it is text like any other, as with ``encode_special_tokens``.
    """
    path = path or tokenizer_path()

    def cut(batch):
        own = encoder(path)
        special = own.special_tokens_set if added else ()

        def encode(text):
            # Without an added token both calls give the same ids; this one is faster.
            if not any(token in text for token in special):
                return own.encode_ordinary(text)
            return own.encode(text, allowed_special="all", disallowed_special=())

        out = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "order_key", *carried)}
        others = [(name, batch.column(name).to_pylist()) for name in carried]
        for row, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"))):
            ids = np.array([*encode(text.as_py() or ""), END], dtype="<u4")
            data = ids.tobytes()
            for start in range(0, len(ids), width):
                piece = data[4 * start : 4 * (start + width)]
                crc = zlib.crc32(piece)
                out["doc_id"].append(doc_id)
                out["start"].append(start)
                out["length"].append(len(piece) // 4)
                out["ids_crc32"].append(crc)
                out["doc_tokens"].append(len(ids))
                out["order_key"].append(f"{zlib.crc32(f'{doc_id}:{start}:{crc}'.encode()):08x}:{doc_id}:{start}:{crc}")
                for name, values in others:
                    out[name].append(values[row])
        yield out

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    further = "".join(f", {name} long" for name in carried)
    return arrow_map(bare, cut, f"doc_id long, start long, length long, ids_crc32 long, doc_tokens long, order_key string{further}")


def pack_histogram(counts: dict[int, int], width: int = WIDTH) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, number of packs)``: the patterns for a histogram, by shortest-pack-first.

    Longest lengths first.  Each goes to the open packs that are filled least; if those do not have room, no
    pack has, and new packs are opened.  Patterns of equal filling wait in one heap.
    """
    heap: list[tuple[int, int, tuple[int, ...], int]] = []
    order = 0
    done = []
    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left = counts[length]
        grown = []
        while left:
            if heap and heap[0][0] + length <= width:
                filled, _, pattern, packs = heapq.heappop(heap)
                fit = (width - filled) // length
                if left >= packs:
                    # all packs of the pattern get one, and as many more as they hold while some are left
                    each = min(fit, left // packs)
                    grown.append((filled + each * length, pattern + (length,) * each, packs))
                    left -= each * packs
                else:
                    order += 1
                    heapq.heappush(heap, (filled, order, pattern, packs - left))
                    grown.append((filled + length, (*pattern, length), left))
                    left = 0
            else:
                # new packs, filled with this length alone as far as it goes
                each = width // length
                if left >= each:
                    grown.append((each * length, (length,) * each, left // each))
                    left %= each
                else:
                    grown.append((left * length, (length,) * left, 1))
                    left = 0
        for filled, pattern, packs in grown:
            order += 1
            if filled == width:
                done.append((pattern, packs))
            else:
                heapq.heappush(heap, (filled, order, pattern, packs))
    return done + [(pattern, packs) for _, _, pattern, packs in sorted(heap)]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, packs, first sequence, offset)`` of every place in a pattern, and so of every rank."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, packs in patterns:
        offset = 0
        for length in pattern:
            first = taken.get(length, 0)
            out.append((length, first, packs, sequence, offset))
            taken[length] = first + packs
            offset += length
        sequence += packs
    return out


def pack(docs: DataFrame, path: str | None = None, width: int = WIDTH, added: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, path, width, added), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = places(pack_histogram(counts, width))
    ranked = rank_in_groups(cut, "length", F.col("order_key"), "_rank", digits=2)
    # At most a few places for each pattern and at most two new patterns for each length: some thousand rows.
    table = spark.createDataFrame(found, "length long, first long, packs long, sequence long, offset long")
    listed = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "packs", "sequence", "offset"))).alias("places"))
    placed = ranked.join(F.broadcast(listed), "length").withColumn(
        "p", F.expr("filter(places, p -> _rank >= p.first and _rank < p.first + p.packs)[0]")
    )
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.expr("p.sequence + _rank - p.first").alias("sequence_id"),
        F.col("p.offset").alias("offset"),
    )


def windows(mixed: DataFrame, window_slots: int = WINDOW_SLOTS, window_docs: int = WINDOW_DOCS) -> list[tuple[int, int, int, int]]:
    """``(part, window, first slot, slots)``: parts of ``window_slots`` slots, joined to windows of ``window_docs`` documents or more.

    The driver sees one count for each part, at most one for every slot in use.
    """
    part = F.expr(f"_slot div {window_slots}")
    counts = sorted(tuple(r) for r in mixed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    grouped: list[list[int]] = [[]]
    held = 0
    for found, n in counts:
        if held >= window_docs:
            grouped.append([])
            held = 0
        grouped[-1].append(found)
        held += n
    return [(p, n, parts[0] * window_slots, (parts[-1] - parts[0] + 1) * window_slots) for n, parts in enumerate(grouped) for p in parts]


def pack_mixed(mixed: DataFrame, path: str | None = None, width: int = WIDTH, added: bool = False, window_slots: int = WINDOW_SLOTS, window_docs: int = WINDOW_DOCS) -> DataFrame:
    """The columns of ``pack`` for documents with ``_slot`` and ``_offset``, packed in windows of slots."""
    spark = mixed.sparkSession
    cut = stage(pieces(mixed, path, width, added, ("_slot", "_offset")).drop("order_key"), "pieces")
    listed = spark.createDataFrame(windows(mixed, window_slots, window_docs), "_part long, _window long, _first long, _slots long")
    placed = cut.withColumn("_part", F.expr(f"_slot div {window_slots}")).join(F.broadcast(listed), "_part")
    placed = placed.withColumn("_group", F.concat_ws(":", "_window", "length"))
    # Two hex digits for the place in the window, then slot, offset and start, all in one text that sorts like the numbers.
    digits = lambda column, n: F.lpad(F.hex(column), n, "0")
    order = F.concat(digits(F.expr("(_slot - _first) * 256 div _slots"), 2), digits(F.col("_slot"), 16), digits(F.col("_offset"), 8), digits(F.col("start"), 16))
    ranked = rank_in_groups(placed, "_group", order, "_rank", digits=2)
    histograms = placed.groupBy("_window", "length").agg(F.count(F.lit(1)).alias("n"))

    def lay_out(key, table):
        import pyarrow as pa

        counts = dict(zip(table.column("length").to_pylist(), table.column("n").to_pylist()))
        found = places(pack_histogram(counts, width))
        names = ("length", "first", "packs", "sequence", "offset")
        columns = [pa.array([p[n] for p in found], pa.int64()) for n in range(len(names))]
        return pa.table([pa.array([key[0].as_py()] * len(found), pa.int64()), *columns], ["_window", *names])

    laid = stage(histograms.groupBy("_window").applyInArrow(lay_out, "_window long, length long, first long, packs long, sequence long, offset long"), "places")
    used = sorted(tuple(r) for r in laid.groupBy("_window").agg(F.max(F.expr("sequence + packs"))).collect())
    starts = list(zip([window for window, _ in used], itertools.accumulate([n for _, n in used], initial=0)))
    bases = spark.createDataFrame(starts, "_window long, _base long")
    by_group = (
        laid.join(F.broadcast(bases), "_window").withColumn("_group", F.concat_ws(":", "_window", "length")).groupBy("_group")
        .agg(F.sort_array(F.collect_list(F.struct("first", "packs", (F.col("_base") + F.col("sequence")).alias("sequence"), "offset"))).alias("places"))
    )
    found = ranked.join(by_group, "_group").withColumn("p", F.expr("filter(places, p -> _rank >= p.first and _rank < p.first + p.packs)[0]"))
    return found.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.expr("p.sequence + _rank - p.first").alias("sequence_id"),
        F.col("p.offset").alias("offset"),
    )
