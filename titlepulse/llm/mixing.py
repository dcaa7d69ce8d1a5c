"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block_docs`` documents.  Weights are held as whole ``parts`` of their sum W, exactly.
The j-th block of a source with p parts is released at floor(j*W/p) and due at ceil((j+1)*W/p); every slot goes to the
released block that is due first, of equal ones to the source that sorts first.  While all sources last, each has had
less than one block more or less than its weight at every slot.  A source that runs out leaves its slots empty: no row is
dropped or repeated.

The schedule is cut into spans of slots that tasks work out on their own.  A span is led in by the slots of the longest
window before it.  What is done when these begin is set by a rule: of the blocks released but not due, those due first.
From there on all windows are met, and once the blocks of that beginning are due, nothing of the choice is left: the same
blocks are done as in one run from slot 0.  Windows repeat every W slots, so no more than W slots are worked out.  The work
is one slot per block, times W * blocks / (parts * all blocks) of the source that lasts longest, and that of the longest
window, which the smallest weight sets.  One row holds all sources, so it is meant for up to some thousands of them.

Weights are exact as long as their whole parts add up to no more than ``MOST_PARTS``: 0.0001 and 0.9999 are 1 and 9,999 of
10,000.  Beyond it (a ratio such as the root of 2) they are rounded to parts of about ``MOST_PARTS``, each at least one; that adds less than a tenth
of a block to the deviation within 400 million slots.

DataFrame and SQL functions only.  A null source is a source of its own.  Within a source the order is by the MD5
of the doc_id, a fixed shuffle; rows with equal ids are interchangeable.  A null doc_id counts as the empty text.  Texts are not looked at: null, empty
and very long ones are documents like others.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.llm.common import rank_in_groups, set_aside
from titlepulse.sources.shared import stage

BLOCK_DOCS = 64

# Products of two parts stay within 64 bits.
MOST_PARTS = 1 << 31

# Slots of a span, at least, and of one inner fold.
SPAN, FOLD = 1024, 256

# A table of blocks, or of sources, of up to this many rows is broadcast.
TEMPLATE_ROWS = 200_000


def source_key(column: str = "source"):
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def whole_parts(weights: dict[str | None, float]) -> dict[str | None, int]:
    """Whole numbers in the ratios of the weights as they are written in decimals; weights of 0 are left out."""
    exact = {source: Fraction(str(weight)) for source, weight in weights.items()}
    if any(value < 0 for value in exact.values()):
        raise ValueError("weights must not be negative")
    exact = {source: value for source, value in exact.items() if value}
    scale = math.lcm(*[value.denominator for value in exact.values()])
    parts = {source: int(value * scale) for source, value in exact.items()}
    shared, total = math.gcd(*parts.values()) or 1, sum(parts.values())
    if total // shared > MOST_PARTS:
        return {source: max(1, (part * MOST_PARTS + total // 2) // total) for source, part in parts.items()}
    return {source: part // shared for source, part in parts.items()}


def target_parts(docs: DataFrame, weights: dict[str | None, float] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(_key, parts, need)`` per source: its weight, and its blocks up to those of one period.

    Without ``weights``, a source weighs the square root of its number of documents, to a thousandth, which raises small
    sources.  With them, a source that is not named takes no part.
    """
    counts = docs.select(source_key().alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        sized = counts.withColumn("size", F.floor(F.sqrt("n") * 1000).cast("long"))
        total = sized.agg(F.sum("size").alias("total"))
        fitted = F.expr(f"if(total <= {MOST_PARTS}, size, greatest(1L, size * {MOST_PARTS} div total))")
        sized = sized.join(F.broadcast(total), F.lit(True)).withColumn("parts", fitted)
    else:
        named = [("null" if source is None else f"={source}", part) for source, part in whole_parts(weights).items()]
        sized = counts.join(docs.sparkSession.createDataFrame(named, "_key string, parts long"), "_key")
    return sized.select("_key", "parts", F.least(F.ceil(F.col("n") / block_docs), "parts").cast("long").alias("need"))


def numbered(parts: DataFrame) -> DataFrame:
    """``(s, w)``: one row with all sources, in their order, and the sum of their parts; no row without sources."""
    listed = parts.agg(F.sort_array(F.collect_list(F.struct("_key", "parts", "need"))).alias("s")).where("size(s) > 0")
    return listed.select("s", F.expr("aggregate(s, 0L, (a, x) -> a + x.parts)").alias("w"))


def block_slots(parts: DataFrame, span: int = SPAN, fold: int = FOLD) -> DataFrame:
    """``(i, j, t)``: the slot t of the j-th block of the i-th source, for all blocks that sources need."""
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    up = lambda value: f"(({value} + {fold - 1}) div {fold} * {fold})"  # noqa: E731  to whole folds
    sizes = numbered(parts).select(
        "s",
        "w",
        F.expr("least(w, array_max(transform(s, x -> (x.need * w + x.parts - 1) div x.parts)))").alias("slots"),
        F.expr(up("w div array_min(transform(s, x -> x.parts)) + 2")).alias("lead"),
    ).withColumn("span", F.expr(f"greatest({up(span)}, lead)"))
    spans = sizes.withColumn("first", F.explode(F.expr("sequence(0L, slots - 1, span)"))).repartition(tasks, "first")
    spans = spans.withColumn("start", F.expr("greatest(0L, first - lead)"))
    # Blocks released before the start and due after it; as many of them as are missing at the start, those due first, are done.
    open_blocks = """
        array_sort(filter(
            transform(s, (x, i) -> if(x.parts * start % w > 0, struct(((x.parts * start div w + 1) * w + x.parts - 1) div x.parts as due, i as i), null)),
            x -> x is not null))
    """
    done = F.expr(f"slice({open_blocks}, 1, cast(start - aggregate(s, 0L, (a, x) -> a + x.parts * start div w) as int)).i")
    spans = spans.withColumn("done", done)
    begun = "transform(s, (x, i) -> x.parts * start div w + if(array_contains(done, i), 1L, 0L))"
    pick = """
        array_min(filter(
            transform(s, (x, i) -> if((a.c[i] * w) div x.parts <= t, struct(((a.c[i] + 1) * w + x.parts - 1) div x.parts as due, i as i), null)),
            x -> x is not null)).i
    """
    # A fold's picks are a list of their own, so that lists that grow by one element stay short.
    one_fold = f"""
        aggregate(
            sequence(u, least(u + {fold}, slots) - 1),
            named_struct('c', b.c, 'k', cast(array() as array<struct<i: int, j: bigint, t: bigint>>)),
            (a, t) -> transform(array({pick}), q -> named_struct(
                'c', transform(a.c, (v, i) -> if(i = q, v + 1, v)),
                'k', if(t < first, a.k, concat(a.k, array(named_struct('i', q, 'j', a.c[q], 't', t))))))[0])
    """
    folded = f"""
        aggregate(
            sequence(start, least(first + span, slots) - 1, {fold}L),
            named_struct('c', {begun}, 'k', cast(array() as array<array<struct<i: int, j: bigint, t: bigint>>>)),
            (b, u) -> transform(array({one_fold}), f -> named_struct('c', f.c, 'k', concat(b.k, array(f.k))))[0]
        ).k
    """
    slots = spans.select("s", F.explode(F.expr(f"flatten({folded})")).alias("x"))
    return slots.where("x.j < s[x.i].need").select("x.i", "x.j", "x.t")


def bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= TEMPLATE_ROWS else df


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Every document of a source that takes part, with ``_block, _release, _due, _slot, _offset``.

    ``_release`` and ``_due`` are those of the block's period plus the slots of all periods before.
    """
    safe, names, back = set_aside(docs)
    keyed = safe.withColumn("_key", source_key(names["source"]))
    ranked = rank_in_groups(keyed, "_key", F.md5(F.coalesce(F.col(names["doc_id"]).cast("string"), F.lit(""))), "_rank")
    parts = stage(target_parts(docs, weights, block_docs), "parts")
    slots = stage(block_slots(parts), "slots")
    sources = numbered(parts).select("w", F.posexplode("s").alias("i", "x")).select("w", "i", "x._key", "x.parts")
    blocks = (
        ranked.join(bounded(sources), "_key")
        .withColumn("_block", F.expr(f"_rank div {block_docs}"))
        .withColumn("_offset", F.expr(f"_rank % {block_docs}"))
        .withColumn("_before", F.expr("(_block div parts) * w"))
        .withColumn("j", F.expr("_block % parts"))
        .join(bounded(slots), ["i", "j"])
    )
    return (
        blocks.withColumn("_release", F.expr("_before + (j * w) div parts"))
        .withColumn("_due", F.expr("_before + ((j + 1) * w + parts - 1) div parts"))
        .withColumn("_slot", F.expr("_before + t"))
        .select(*back, "_block", "_release", "_due", "_slot", "_offset")
    )


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, their rows and files in the order of the schedule."""
    mixed = mix(docs, **options)
    return mixed.orderBy("_slot", "_offset").select(*docs.columns)
