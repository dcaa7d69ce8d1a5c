"""What several of the operators share: words, staging, ranks in groups, connected components."""

from __future__ import annotations

import os
import pathlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titlepulse.sources.shared import ensure_shared_folder, stage

# White space as all contracts have it: the blank and code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A table of pairs or ids is broadcast up to this many rows (16 bytes each), and joined by a shuffle beyond.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """For registered queries: a shared folder, and this checkout on the path of a single machine's Python workers."""
    ensure_shared_folder(spark)
    root, set_ = str(pathlib.Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in set_.get("PYTHONPATH", "").split(os.pathsep):
        set_["PYTHONPATH"] = os.pathsep.join(filter(None, [root, set_.get("PYTHONPATH", "")]))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; none for null.  ``bytes.split`` cuts at exactly the six characters above."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case; other letters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` word hashes; none if there are fewer."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    mixed = np.zeros(count, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def words_column(text: Column) -> Column:
    """The words of a text as an array, inside the JVM; empty for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """The frame with names that no operator uses inside, the new name of each column, and the columns as they were."""
    safe = df.toDF(*[f"__c{n}" for n in range(len(df.columns))])
    names = dict(zip(df.columns, safe.columns))
    return safe, names, [F.col(new).alias(old) for old, new in names.items()]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator, so that Catalyst can't copy their expressions into what stands above."""
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one record batch to a dict of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    fields = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for columns in function(batch):
                arrays = [pa.array(columns[field.name], type=field.type) for field in fields]
                yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return df.mapInArrow(run, schema)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.count() <= rows


def join_bounded(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a staged table of ids: broadcast where its count is within the bound, else by a shuffle."""
    return big.join(F.broadcast(small) if is_small(small) else small, on, how)


def least_count(counted: DataFrame, most: int) -> int:
    """The least ``n`` that at most ``most`` rows of ``counted`` reach.

    From a histogram: of every count below 4096, and by powers of two above it, where it may come out too high.
    """
    power = F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("long")
    steps = counted.groupBy(F.when(F.col("n") < 4096, F.col("n")).otherwise(power).alias("step")).agg(F.count(F.lit(1)).alias("rows"))
    limit, total = 1 << 62, 0
    for row in sorted(steps.collect(), key=lambda row: -row["step"]):
        total += row["rows"]
        if total > most:
            break
        limit = row["step"]
    return limit


def rank_in_groups(df: DataFrame, group: str, order: Column, name: str, digits: int = 3) -> DataFrame:
    """Number the rows of each group from 0, by the hex digits of ``order``.

    A group of any size is split by the first ``digits`` digits; the rows of earlier splits are added from a table
    of counts.  Rows with equal ``order`` are interchangeable and numbered in any order.
    """
    cut = df.withColumn("_order", order).withColumn("_cut", F.substring("_order", 1, digits))
    counts = cut.groupBy(group, "_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "_cut", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_cut").orderBy("_order")
    numbered = cut.withColumn("_inside", F.row_number().over(inside) - 1)
    joined = numbered.join(counts, [group, "_cut"])
    return joined.withColumn(name, F.col("_before") + F.col("_inside")).drop("_order", "_cut", "_before", "_inside")


def are_stars(edges: DataFrame) -> bool:
    """Whether every u of the different edges ``(u, v)``, u above v, has one v, which is no u itself."""
    ends = edges.select(F.col("u").alias("id"), F.col("v").alias("up")).unionAll(edges.select("v", F.lit(None).cast("long")))
    of = ends.groupBy("id").agg(F.min("up").alias("least"), F.max("up").alias("most"), F.count_if(F.col("up").isNull()).alias("below"))
    return of.agg(F.count_if((F.col("least") < F.col("most")) | (F.col("least").isNotNull() & (F.col("below") > 0)))).first()[0] == 0


def components(links: DataFrame, label: str) -> DataFrame:
    """``(id, component_id)`` for every id of the links ``(a, b)``: the smallest id it reaches.

    Small star and large star in turn until only stars are left; every round is one written table, so no round depends
    on what an executor holds.  Ids without a link are not in the result.  Links given as the stars of an earlier result
    need no more rounds: pass those, and the new links, where links are added.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    while not are_stars(edges):
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            edges.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        # An edge's smaller end gives way to the smallest that this end has an edge to.
        least = small.groupBy("u").agg(F.min("v").alias("m")).toDF("v", "m")
        edges = stage(small.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v")), label)
    edges = edges.distinct()
    roots = edges.select(F.col("v").alias("id")).distinct()
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return found.unionAll(roots.select("id", F.col("id").alias("component_id")))
