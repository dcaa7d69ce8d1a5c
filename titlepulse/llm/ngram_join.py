"""N-gram Jaccard join by set relations, and the groups of documents it links.

A document's set is its distinct shingles of ``SHINGLE`` lower-cased words.  Two link when their Jaccard similarity is
at least 4/5.  The result is the linked groups, so no pair inside a group has to be listed.

The index holds each set's prefix: its first shingles in one order of all shingles, frequent ones last; linked sets
share a shingle of both prefixes.  Entries carry size and position, and a list is met in blocks of sizes: blocks whose
sizes are too far apart, and entries whose positions leave too few shingles, are skipped without looking at the sets.

Answers are derived from those of similar sets.  Sets that are equal share one answer.  Then each set is compared with the one
before it in most of its lists, and again with one of the largest cluster that its lists name, which gathers similar
sets in clusters.  Inside a cluster sets differ little: overlaps
come from the shingles that all have, counted once, and a product over those that only some have; blocks of a cluster
that are already one group are not compared again, only what lies outside the largest group is compared with all.
Across clusters, the pairs that the index leaves are first tested on a sketch, which shows for most of
them that the sets lack too much of each other, and then compared one by one.  All comparisons are exact over the sets of
64-bit hashes of shingles.

A document with fewer than ``SHINGLE`` words has its whole sequence as its one shingle.  Null and empty texts have empty
sets and no links.  Rows with one doc_id are one document; a null doc_id has no links and no group.  An empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.llm.common import arrow_map, components, join_bounded, least_count, lower_words_of, window_hashes, word_hashes
from titlepulse.sources.shared import stage

SHINGLE = 5
# The shingles that most sets begin with come last in the order of shingles: this many at most, and none that
# fewer than ``LEAST`` sets begin with.  A set begins with its first 3/10 by hash, more than its prefix.
FREQUENT_TOKENS, LEAST = 1_000_000, 4
BEGIN_TENTHS = 3
BLOCK_ELEMENTS = 1_000_000
# Groups of equal sets from this share of all documents on are represented by one of them: at most 100,000 groups.
COPIES = 1e-5
LEAST_COPIES = 3
# Entries of one list in a task while the index is built.
LIST_ENTRIES = 4096
# Members compared with one anchor in a task, and documents of a cluster in one block.
ANCHOR_MEMBERS, CLUSTER_BLOCK = 256, 256
# Sets with this similarity, in tenths, are of one cluster.
CLOSE_TENTHS = 3
COLUMNS = 16_384


def shingles(text: str | None) -> np.ndarray:
    """The set of a text, as sorted hashes."""
    words = lower_words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    if len(words) < SHINGLE:
        return window_hashes(hashes, len(words)) ^ np.uint64(0xA0761D6478BD642F * len(words) % 2**64)
    return np.unique(window_hashes(hashes, SHINGLE))


def needed(a, b):
    """The least overlap of linked sets of these sizes."""
    return (4 * (a + b) + 8) // 9


def linked(overlap, a, b):
    return 100 * overlap >= 80 * (a + b - overlap)


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def sketch(own: np.ndarray) -> bytes:
    """A bit for each of 64 to 4096 ranges of hashes, about two a shingle: set where the set has a shingle."""
    width = min(12, max(6, int(2 * len(own) - 1).bit_length())) if len(own) else 6
    bits = np.zeros(1 << width, np.uint8)
    bits[(own >> np.uint64(64 - width)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def most_overlap(one: bytes, n_one: int, other: bytes, n_other: int) -> int:
    """At least the overlap of two sets: a range that one set alone has holds a shingle that is not shared."""
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    if len(a) != len(b):
        width = 8 * min(len(a), len(b))
        a, b = (np.packbits(np.unpackbits(x).reshape(width, -1).any(axis=1)) for x in (a, b))
    return min(n_one - int(np.bitwise_count(a & ~b).sum()), n_other - int(np.bitwise_count(b & ~a).sum()))


def set_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, n, digest, bits`` of every document; no digest for an empty set."""

    def measure(batch):
        sets = [shingles(t.as_py()) for t in batch.column("text")]
        yield {
            "doc_id": batch.column("doc_id").to_pylist(), "n": [len(s) for s in sets],
            "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], "bits": [sketch(s) for s in sets],
        }

    return arrow_map(plain(docs), measure, "doc_id long, n long, digest binary, bits binary")


def frequent_tokens(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that many sets begin with, and how many."""

    def count(batches):
        held, size = [], 0

        def rows():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["token", "n"])

        for batch in batches:
            for text in batch.column("text"):
                own = shingles(text.as_py())
                held.append(own[: -(-len(own) * BEGIN_TENTHS // 10)])
                size += len(held[-1])
            if size >= BLOCK_ELEMENTS:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    counted = plain(docs).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    often = stage(counted.where(F.col("n") >= LEAST), "often")
    limit = least_count(often, FREQUENT_TOKENS)
    found = often.where(F.col("n") >= limit).toArrow()
    tokens = found.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found.column("n").to_numpy()[order]


def postings(docs: DataFrame, frequent, copies) -> DataFrame:
    """``token, id, n, pos, salts``: the prefixes of all sets that are not represented by another."""

    def emit(batch):
        tokens_of, counts_of = frequent.value
        out = {"token": [], "id": [], "n": [], "pos": [], "salts": []}
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            own = shingles(text.as_py())
            n = len(own)
            if not n or copies.value.get(xxhash.xxh3_128_digest(own.tobytes()), doc_id) != doc_id:
                continue
            count = np.zeros(n, np.int64)
            if len(tokens_of):
                at = np.minimum(np.searchsorted(tokens_of, own), len(tokens_of) - 1)
                count = np.where(tokens_of[at] == own, counts_of[at], 0)
            first = np.lexsort((own, count))[: n - (4 * n + 4) // 5 + 1]
            out["token"].append(own[first].view(np.int64))
            out["id"].append(np.full(len(first), doc_id))
            out["n"].append(np.full(len(first), n, np.int32))
            out["pos"].append(np.arange(len(first), dtype=np.int32))
            out["salts"].append(np.maximum(1, -(-count[first] // LIST_ENTRIES)).astype(np.int32))
        if out["token"]:
            yield {name: np.concatenate(parts) for name, parts in out.items()}

    return arrow_map(plain(docs).where("doc_id is not null"), emit, "token long, id long, n int, pos int, salts int")


def index_of(entries: DataFrame) -> DataFrame:
    """The lists with more than one entry, each entry with the one before it in the order of sizes."""
    from pyspark.sql import Window

    salted = entries.withColumn("salt", F.when(F.col("salts") > 1, F.pmod(F.xxhash64("id"), F.col("salts"))).otherwise(F.lit(0)))
    order = Window.partitionBy("token", "salt").orderBy("n", "id")
    before = F.lag(F.struct("id", "n", "pos")).over(order)
    numbered = salted.withColumn("before", before).withColumn("after", F.lead("id").over(order))
    return numbered.where("salts > 1 or before is not null or after is not null").select("token", "id", "n", "pos", "before")


def may_link(n1: str, p1: str, n2: str, p2: str) -> str:
    """Of two entries of one list, the first of the smaller set: sizes and positions leave enough shingles."""
    return (
        f"5 * {n1} >= 4 * {n2} and {p1} <= {n1} - (8 * {n1} + 8) div 9 "
        f"and 1 + least({n1} - {p1}, {n2} - {p2}) - 1 >= (4 * ({n1} + {n2}) + 8) div 9"
    )


def most_shared(pairs: DataFrame) -> DataFrame:
    """``(a, b)``: of pairs ``(a, b, n)``, one for each list, the b that most lists of a name.

    Where those are few for the size n of a, none: the two would hardly be similar.
    """
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("lists"), F.first("n").alias("n"))
    best = counts.groupBy("a").agg(F.max_by(F.struct("b", "lists", "n"), F.struct("lists", "b")).alias("best"))
    return best.where("50 * best.lists >= best.n").select("a", F.col("best.b").alias("b"))


def likely(sets: DataFrame, pairs: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Of pairs ``(a, b)``, those whose sketches leave room for a similarity of numerator / denominator."""
    side = sets.where("doc_id is not null").select("doc_id", "n", "bits")
    both = pairs.join(side.toDF("a", "n_a", "bits_a"), "a").join(side.toDF("b", "n_b", "bits_b"), "b")

    def test(batch):
        out = {"a": [], "b": []}
        for a, n_a, bits_a, b, n_b, bits_b in zip(*(batch.column(n).to_pylist() for n in ("a", "n_a", "bits_a", "b", "n_b", "bits_b"))):
            most = most_overlap(bits_a, n_a, bits_b, n_b)
            if denominator * most >= numerator * (n_a + n_b - most):
                out["a"].append(a)
                out["b"].append(b)
        yield out

    return arrow_map(both, test, "a long, b long").distinct()


def verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a, b, overlap, n_a, n_b`` of the staged pairs ``(a, b)``: sets of a are compared with that of their anchor b."""
    anchors = stage(
        pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).select("b", F.ceil(F.col("n") / ANCHOR_MEMBERS).cast("int").alias("salts")), "anchors"
    )
    texts = plain(docs)
    placed = stage(pairs.join(anchors, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt")), "pairs")
    members = join_bounded(texts, placed, texts.doc_id == placed.a).select("b", "salt", F.lit(1).alias("role"), F.col("a").alias("id"), "text")
    bases = join_bounded(texts, anchors, texts.doc_id == anchors.b).select(
        "b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("b").alias("id"), "text"
    )
    dealt = bases.unionAll(members).repartition("b", "salt").sortWithinPartitions("b", "salt", "role")

    def compare(batches):
        key, base = None, []
        for batch in batches:
            out = {"a": [], "b": [], "overlap": [], "n_a": [], "n_b": []}
            for b, salt, role, id_, text in zip(*(batch.column(n).to_pylist() for n in ("b", "salt", "role", "id")), batch.column("text")):
                if (b, salt) != key:
                    key, base = (b, salt), []
                own = shingles(text.as_py())
                if role == 0:
                    base.append(own)
                    continue
                for other in base:
                    out["a"].append(id_)
                    out["b"].append(b)
                    out["overlap"].append(len(np.intersect1d(own, other, assume_unique=True)))
                    out["n_a"].append(len(own))
                    out["n_b"].append(len(other))
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return dealt.mapInArrow(compare, "a long, b long, overlap long, n_a long, n_b long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The overlaps of all pairs of different sets: shingles that all sets have count once, the others by a product of matrices."""
    flat = np.concatenate(sets)
    values, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = int((counts == len(sets)).sum())
    some = (counts > 1) & (counts < len(sets))
    number = np.cumsum(some) - 1
    keep = some[column]
    row, column = row[keep], number[column[keep]]
    out = np.full((len(sets), len(sets)), shared, np.int64)
    for start in range(0, int(some.sum()), COLUMNS):
        part = (column >= start) & (column < start + COLUMNS)
        matrix = np.zeros((len(sets), min(COLUMNS, int(some.sum()) - start)), np.float32)
        matrix[row[part], column[part] - start] = 1
        out += np.rint(matrix @ matrix.T).astype(np.int64)
    return out


def block_links(ids: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what is linked among these sets: one for each that joins two groups."""
    ids = np.array(ids)
    sizes = np.array([len(s) for s in sets])
    near = linked(overlaps(sets), sizes[:, None], sizes[None, :])
    group, links = np.arange(len(ids)), []
    for n in range(len(ids)):
        for other in np.flatnonzero(near[n, :n]):
            if group[other] != group[n]:
                links.append((int(ids[n]), int(ids[other])))
                group[group == group[other]] = group[n]
    return links


def compare_blocks(docs: DataFrame, tasks: DataFrame) -> DataFrame:
    """Links ``(a, b)`` among the documents of each block; ``tasks`` (staged): ``id, cluster, i, j``."""
    texts = plain(docs)
    dealt = join_bounded(texts, tasks, texts.doc_id == tasks.id).select("cluster", "i", "j", "id", "text").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")

    def compare(batches):
        def found(ids, sets):
            links = block_links(ids, sets)
            return pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

        key, ids, sets = None, [], []
        for batch in batches:
            for *now, id_, text in zip(*(batch.column(n).to_pylist() for n in ("cluster", "i", "j", "id")), batch.column("text")):
                if now != key:
                    if len(ids) > 1:
                        yield found(ids, sets)
                    key, ids, sets = now, [], []
                ids.append(id_)
                sets.append(shingles(text.as_py()))
        if len(ids) > 1:
            yield found(ids, sets)

    return dealt.mapInArrow(compare, "a long, b long")


def as_links(found: DataFrame, of: str) -> DataFrame:
    """The stars ``(a, b)`` of components found earlier."""
    return found.select(F.col("id").alias("a"), F.col(of).alias("b"))


def cluster_links(docs: DataFrame, clusters: DataFrame, links: DataFrame) -> DataFrame:
    """Links that connect what ``links`` do and all that is linked inside clusters ``(id, cluster)``."""
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / CLUSTER_BLOCK).cast("int").alias("blocks"))
    placed = stage(clusters.join(sizes, "cluster").select("id", "cluster", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")), "clusters")
    # Each block with itself and the next.
    near = placed.select("id", "cluster", F.explode(F.array_distinct(F.array("block", F.expr("(block + 1) % blocks")))).alias("i"), F.lit(0).alias("j"))
    near = stage(compare_blocks(docs, stage(near, "near-blocks")), "near-links")
    # Then what is not in its cluster's largest group, with everything in the cluster.
    groups = components(links.unionAll(near), "near-groups")
    labelled = stage(placed.join(groups, "id", "left").withColumn("component_id", F.coalesce("component_id", "id")), "labelled")
    counts = labelled.groupBy("cluster", "component_id").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("cluster").agg(F.max_by("component_id", F.struct("n", "component_id")).alias("largest"), F.count(F.lit(1)).alias("groups"))
    open_ = labelled.join(largest.where("groups > 1").drop("groups"), "cluster").where("blocks > 2")
    minor = stage(open_.where("component_id <> largest"), "minor")
    parts = minor.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / CLUSTER_BLOCK).cast("int").alias("parts"))
    rest = minor.join(parts, "cluster").select("id", "cluster", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    all_ = open_.join(parts, "cluster").select("id", "cluster", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.col("block").alias("j"))
    tasks = stage(rest.unionAll(all_).distinct(), "far-blocks")
    return as_links(groups, "component_id").unionAll(compare_blocks(docs, tasks))


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    spark = docs.sparkSession
    sets = stage(set_sizes(docs), "sets")
    documents = sets.count()
    frequent = spark.sparkContext.broadcast(frequent_tokens(docs))
    equal = stage(sets.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1"), "equal")
    many = equal.where(F.col("n") >= max(LEAST_COPIES, COPIES * documents))
    copies = spark.sparkContext.broadcast({bytes(r["digest"]): r["b"] for r in many.select("digest", "b").toLocalIterator()})
    same = sets.join(equal, "digest").select(F.col("doc_id").alias("a"), "b").where("a <> b")

    index = stage(index_of(postings(docs, frequent, copies)), "index")
    # The set before it in most of its lists, of those that size and position let link.
    nearest = (
        index.where("before is not null and before.id <> id").where(may_link("before.n", "before.pos", "n", "pos"))
        .select(F.col("id").alias("a"), F.col("before.id").alias("b"), "n")
    )
    compared = stage(verify(docs, stage(most_shared(nearest), "nearest")), "compared")
    is_link = F.expr("100 * overlap >= 80 * (n_a + n_b - overlap)")
    links = stage(same.unionAll(compared.where(is_link).select("a", "b")), "links")
    is_close = F.expr(f"10 * overlap >= {CLOSE_TENTHS} * (n_a + n_b - overlap)")
    close = compared.where(is_close).select("a", "b")
    clusters = stage(components(close, "cluster-edges").withColumnRenamed("component_id", "cluster"), "clusters")
    # Sets that met a distant one there are compared with one of the largest cluster in most of their lists.
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    placed = stage(
        index.drop("before").join(clusters, "id", "left").withColumn("cluster", F.coalesce("cluster", "id")).join(sizes, "cluster", "left").na.fill(1, ["members"]), "index-clusters"
    )
    largest = placed.groupBy("token").agg(
        F.max_by(F.struct("id", "cluster", "n"), F.struct("members", "cluster", "id")).alias("best"), F.min("cluster").alias("x"), F.max("cluster").alias("y")
    ).where("x < y").select("token", "best")
    straying = placed.join(largest, "token").where("cluster <> best.cluster and 5 * least(n, best.n) >= 2 * greatest(n, best.n)").select(F.col("id").alias("a"), F.col("best.id").alias("b"), "n")
    again = stage(verify(docs, stage(most_shared(straying), "straying")), "compared-again")
    links = links.unionAll(again.where(is_link).select("a", "b"))
    close = as_links(clusters, "cluster").unionAll(again.where(is_close).select("a", "b"))
    clusters = stage(components(close, "cluster-edges").withColumnRenamed("component_id", "cluster"), "clusters")
    inside = stage(cluster_links(docs, clusters, links), "cluster-links")

    # Across clusters, all that the index leaves.
    told = stage(placed.drop("cluster", "members").join(clusters, "id", "left").withColumn("cluster", F.coalesce("cluster", "id")), "index-clusters")
    mixed = told.groupBy("token").agg(F.min("cluster").alias("x"), F.max("cluster").alias("y")).where("x < y").select("token")
    left = told.join(mixed, "token").withColumn("size_block", F.floor(F.log("n") / F.log(F.lit(1.25))).cast("int"))
    small = left.select("token", *[F.col(c).alias(c + "1") for c in ("id", "n", "pos", "cluster")], F.explode(F.expr("array(size_block, size_block + 1)")).alias("size_block"))
    pairs = (
        small.join(left, ["token", "size_block"])
        .where("cluster1 <> cluster and id1 <> id and (n1 < n or n1 = n and id1 < id)").where(may_link("n1", "pos1", "n", "pos"))
        .select(F.col("id").alias("a"), F.col("id1").alias("b")).distinct()
    )
    across = stage(verify(docs, stage(likely(sets, pairs, 4, 5), "across")), "across-compared").where(is_link).select("a", "b")
    found = components(inside.unionAll(across), "groups")
    return (
        sets.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those whose group holds a smaller doc_id."""
    gone = stage(groups(docs).where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return join_bounded(docs, gone, "doc_id", "left_anti")
