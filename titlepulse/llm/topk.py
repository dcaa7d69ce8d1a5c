"""Exact top-k inner products from an impact-ordered index, score at a time.

Rows are dealt into shards of about ``SHARD_ROWS`` by a hash of their id.  A shard is indexed by dimension: its
postings lie in segments by quantised impact (component value).  A query's gain from a posting is what the
component adds over the least that the shard's rows have in this dimension, so gains are never negative.  Segments of
all dimensions are processed by descending gain.  What a row can still gain is at most the sum, over dimensions,
of the largest gain not yet processed.  Processing stops only when that proves that the rows left out can't be among
the k best; the possible members that remain are scored again exactly, over all dimensions.

Queries are a stated set and meet all rows in blocks: a shard is sent to each block of ``QUERY_ROWS`` queries.  Each
shard returns its k best for each query, from which the k best of all are ranked.  Ties go to the smaller id.

Vectors that are null, or hold a null or non-finite component, and rows without an id take no part.  Vectors of
different lengths do not meet.  A query's own id is never its result; repeated ids are ranked as rows of their own,
and a repeated query has a list for each of its rows.
Empty tables give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, EVERY, SCALE = 5, 50, 256
SHARD_ROWS, QUERY_ROWS = 4096, 512
LEVELS = 8  # segments of one dimension
ROUNDS = (0.5, 0.7, 0.85, 0.95, 1.0)  # shares of a query's segments after which the proof is tried
POSSIBLE = 64  # members left at which a query stops


def quantised(embeddings: DataFrame) -> DataFrame:
    """``row, vec_id, v``: components as floor(256 x), of the rows that take part."""
    usable = F.expr("vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return embeddings.where(usable).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.expr(f"transform(embedding, x -> cast(floor({SCALE} * cast(x as double)) as bigint))").alias("v"),
    )


class Shard:
    """An impact-ordered index of the rows ``x`` (one vector each).

    A dimension has each posting twice: by what it lies above the dimension's least value, for queries that are
    positive there, and by what it lies below the largest, for negative ones.  Either way a gain is
    |query component| times impact, at least 0.  Segments are held as the columns of one matrix, zero outside the
    segment, so that a round of segments for a block of queries is one product of matrices.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        rows, dims = x.shape
        place = np.argsort(np.argsort(x, axis=0, kind="stable"), axis=0)
        level = place * LEVELS // rows
        low, high = x.min(axis=0), x.max(axis=0)
        columns = []
        for impact in (x - low, high - x):
            columns += [np.where(level == n, impact, 0) for n in range(LEVELS)]
        self.segments = np.hstack(columns).astype(np.float64)
        self.most = self.segments.max(axis=0)

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """Yields ``(ids, scores)`` of the k best for each query."""
        rows, dims = self.x.shape
        asked = queries.astype(np.float64)
        weights = np.hstack([np.tile(np.maximum(asked, 0), LEVELS), np.tile(np.maximum(-asked, 0), LEVELS)])
        gains = weights * self.most
        # place of every segment in its query's descending order of gains
        place = np.argsort(np.argsort(-gains, axis=1, kind="stable"), axis=1)
        # sums of doubles are exact below 2**53; beyond, the proof allows for what rounding can do
        slack = np.where(gains.sum(axis=1) < 2.0**52, 0.0, gains.sum(axis=1) * 2.0**-38)
        wanted = min(rows, k + 1)
        gained = np.zeros((len(queries), rows))
        possible: list[np.ndarray | None] = [None] * len(queries)
        open_, done = np.arange(len(queries)), 0
        for share in ROUNDS:
            until = int(np.ceil(share * gains.shape[1]))
            now = (place[open_] >= done) & (place[open_] < until)
            gained[open_] += (weights[open_] * now) @ self.segments.T
            done = until
            ahead = np.where(place[open_] >= until, gains[open_], 0).reshape(len(open_), 2, LEVELS, dims)
            left = ahead.max(axis=2).sum(axis=(1, 2))
            kth = np.partition(gained[open_], rows - wanted, axis=1)[:, rows - wanted]
            member = gained[open_] + (left + slack[open_])[:, None] >= (kth - slack[open_])[:, None]
            stop = (member.sum(axis=1) <= POSSIBLE) | (share == ROUNDS[-1])
            for n in np.flatnonzero(stop):
                possible[open_[n]] = np.flatnonzero(member[n])
            open_ = open_[~stop]
            if not len(open_):
                break
        for query_id, q, members in zip(query_ids, queries, possible):
            # One more than k was proven, for the query itself; where its id is repeated, all rows are looked at.
            if (self.ids == query_id).sum() > 1:
                members = np.arange(rows)
            members = members[self.ids[members] != query_id]
            scores = self.x[members] @ q
            ranked = np.lexsort((self.ids[members], -scores))[:k]
            yield self.ids[members][ranked], scores[ranked]


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all other rows for each row whose id ``every`` divides."""
    rows = quantised(embeddings)
    sizes = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()
    shards, blocks = max(1, math.ceil(sizes[0] / shard_rows)), max(1, math.ceil(sizes[1] / query_rows))
    width = F.size("v").alias("width")
    # A hash of id and vector deals repeated ids apart; a block of queries is small enough to be held by every task.
    indexed = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).alias("shard"),
        width, F.lit(False).alias("asks"), "row", "vec_id", "v",
    )
    asking = rows.where(F.col("vec_id") % every == 0).select(
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        width, F.lit(True).alias("asks"), "row", "vec_id", "v",
    )

    def search(key: tuple[pa.Scalar, ...], held: pa.Table) -> pa.Table:
        ids, rows = held.column("vec_id").to_numpy(), held.column("row").to_numpy()
        asks = held.column("asks").to_numpy(zero_copy_only=False)
        vectors = held.column("v").combine_chunks()
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        out = {"row": [], "query_id": [], "vec_id": [], "score": []}
        if (~asks).any():
            shard = Shard(ids[~asks], x[~asks])
            for row, query_id, (found, scores) in zip(rows[asks], ids[asks], shard.best(ids[asks], x[asks], k)):
                out["row"] += [row] * len(found)
                out["query_id"] += [query_id] * len(found)
                out["vec_id"] += found.tolist()
                out["score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    met = indexed.unionAll(asking).groupBy("block", "shard", "width").applyInArrow(search, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
