"""Keyed upsert with a rule per column, as one full outer join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rules for a column of a row that exists on both sides.  A row on one side only is taken as it is.
BATCH = "batch"  # the batch's value, also when NULL
COALESCE = "coalesce"  # the batch's value unless NULL
EITHER = "or"  # logical or
NONEMPTY = "nonempty_array"  # the batch's array unless empty
KEEP = "keep"  # the target's value
ADD = "add"  # the sum of both; NULL, once a sum has overflowed, stays NULL
MOST = "max"  # the larger one, NULLs aside

_BATCH_SIDE = "_b_"


def _merged(name: str, rule: str, both: Column, in_batch: Column) -> Column:
    old, new = F.col(name), F.col(_BATCH_SIDE + name)
    one_side = F.when(in_batch, new).otherwise(old)
    if rule == BATCH:
        return one_side
    if rule == COALESCE:
        return F.coalesce(new, old)
    if rule == EITHER:
        return F.when(both, new | old).otherwise(one_side)
    if rule == NONEMPTY:
        return F.when(both & (F.coalesce(F.size(new), F.lit(0)) <= 0), old).otherwise(one_side)
    if rule == KEEP:
        return F.when(both, old).otherwise(one_side)
    if rule == ADD:
        return F.when(both, F.try_add(old, new)).otherwise(one_side)
    if rule == MOST:
        return F.greatest(old, new)
    raise ValueError(f"unknown rule {rule!r} for column {name!r}")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], rules: dict[str, str], unless_older: tuple[str, ...] = ()) -> DataFrame:
    """Target with the batch merged in, in the target's columns.

    With ``unless_older``, a row of the batch changes nothing if the target's is larger in these columns, or, where they
    are equal, in all others: of several rows of a key the same one wins, in whatever batches they come.

    Columns without a rule are kept; a column the batch lacks is NULL in inserted rows.  A key with a NULL part
    matches nothing, so such rows of either side are passed through.  A batch with two rows of one key fails
    the job.
    """
    new_columns = [name for name in target.columns if name in batch.columns]
    complete = _all_present(keys)
    # Rows that cannot match get a key part of their own: otherwise all of them would meet in one task.
    lone = F.when(complete, F.lit(0)).otherwise(F.xxhash64(*new_columns) + F.spark_partition_id() + 1)
    order = Window.partitionBy(*keys, "_lone").orderBy(*keys)
    repeated = (F.row_number().over(order) > 1) & complete
    clash = F.raise_error(F.concat_ws(" ", F.lit("batch has several rows for key"), *[F.col(k).cast("string") for k in keys]))
    # The window asks for the distribution and order the join needs, so the check costs no further shuffle.
    fresh = (
        batch.select(*new_columns)
        .withColumn("_lone", lone)
        .withColumn("_in_batch", F.when(repeated, clash.cast("boolean")).otherwise(F.lit(True)))
    )
    for name in new_columns:
        fresh = fresh.withColumnRenamed(name, _BATCH_SIDE + name)
    old = (
        target.withColumn("_lone", F.when(complete, F.lit(0)).otherwise(F.xxhash64(*target.columns) + F.spark_partition_id() + 1))
        .withColumn("_in_target", F.lit(True))
        .withColumnRenamed("_lone", "_target_lone")
    )
    matches = [F.col(k) == F.col(_BATCH_SIDE + k) for k in keys] + [F.col("_target_lone") == F.col("_lone")]
    joined = old.join(fresh, matches, "full_outer")

    in_batch = F.coalesce(F.col("_in_batch"), F.lit(False))
    both = in_batch & F.coalesce(F.col("_in_target"), F.lit(False))
    if unless_older:
        order = [*unless_older, *[n for n in new_columns if n not in (*keys, *unless_older)]]
        older = both & (F.struct(*order) > F.struct(*[F.col(_BATCH_SIDE + n).alias(n) for n in order]))
        in_batch, both = in_batch & ~older, both & ~older
    out = []
    for name in target.columns:
        if name in keys:
            merged = F.when(in_batch, F.col(_BATCH_SIDE + name)).otherwise(F.col(name))
        elif name in new_columns:
            merged = _merged(name, rules.get(name, KEEP), both, in_batch)
        else:
            merged = F.col(name)
        out.append(merged.cast(target.schema[name].dataType).alias(name))
    return joined.select(out)


def _all_present(keys: list[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present
