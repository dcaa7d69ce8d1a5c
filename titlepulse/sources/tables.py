"""Parquet tables under one base path: append by batch, replace as a whole, upsert by key, whole or in parts."""

from __future__ import annotations

import re
import urllib.parse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlepulse.operators.upsert import upsert
from titlepulse.schemas import LAYOUTS, columns
from titlepulse.sources.shared import delete_folder, stage

_VERSION = re.compile(r"^v(\d{8})$")
_PART_VERSION = "p_version"


class Tables:
    """Named tables under ``base``.

    A replaced table gets a new version folder; once it is written, an empty file of its name in ``_committed``
    makes it the current one.  So a table can be rebuilt from itself, and a failed run leaves the old version in
    place.  Data without such a file, or a file whose folder is gone, is damage and not an empty table: reading
    raises.  One writer per table at a time.

    A table with a layout is kept in parts, by values that follow from its key (``layouts``: SQL expressions by the name
    of a partition column).  Its rows lie under ``data``, and a version of the table is a list of parts, each with the
    version of its own in which it was last written.  An upsert reads and writes only the parts that the batch
    has rows of; its commit names old and new parts together.  A version can also list what has been ``applied`` to
    the table, such as the ids of the batches merged into it: that is committed with the rows or not at all.
    """

    def __init__(self, spark: SparkSession, base: str, layouts: dict[str, dict[str, str]] | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self.layouts = LAYOUTS if layouts is None else layouts

    # -- reading -------------------------------------------------------------------------------------------

    def read(self, name: str, ddl: str) -> DataFrame:
        """The table's current rows; a table not written yet is empty, with the same columns."""
        path = self._current(name)
        if path is None:
            return self.spark.createDataFrame([], ddl)
        if name in self.layouts:
            return self._rows(name, self._parts(name), T.StructType.fromDDL(ddl))
        return self.spark.read.schema(ddl).parquet(path).select(columns(ddl))

    def exists(self, name: str) -> bool:
        return self._current(name) is not None

    def read_near(self, name: str, ddl: str, keys: DataFrame) -> DataFrame:
        """The rows of the parts in which rows with the given keys lie; of a table with a layout no other part is read."""
        if self._current(name) is None:
            return self.spark.createDataFrame([], ddl)
        touched = keys.select(*self._part_columns(name)).distinct()
        return self._rows(name, self._parts(name).join(touched, list(self.layouts[name]), "left_semi"), T.StructType.fromDDL(ddl))

    def applied(self, name: str) -> set[str]:
        """What the current version of a table with a layout says has been applied to it."""
        if self._current(name) is None:
            return set()
        return {row["applied"] for row in self._manifest(name).where("applied is not null").select("applied").toLocalIterator()}

    def partition_values(self, name: str, column: str) -> set[str]:
        """Values of a partition column of an appended table, from its folders alone."""
        found, level = set(), [f"{name}/rows"]
        while level:
            inside = [f"{folder}/{child}" for folder in level for child in self._folders(folder) if "=" in child]
            own = [child for child in inside if child.rpartition("/")[2].startswith(f"{column}=")]
            found |= {urllib.parse.unquote(child.rpartition("=")[2]) for child in own}
            level = [child for child in inside if child not in own]
        return found

    # -- writing -------------------------------------------------------------------------------------------

    def append_batch(self, name: str, rows: DataFrame, partition_by: tuple[str, ...], sort_by: tuple[str, ...] = ()) -> None:
        """Add rows under their partition values.  Writing the same batch again replaces it, so a retried job
        adds nothing twice; that needs the batch id among ``partition_by``."""
        if sort_by:
            rows = rows.sortWithinPartitions(*partition_by, *sort_by)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(f"{self.base}/{name}/rows")
        )

    def replace(self, name: str, rows: DataFrame, partition_by: tuple[str, ...] = (), applied: tuple[str, ...] = ()) -> DataFrame:
        """Make ``rows`` the table's content; they may be derived from its present content.

        Rows of one partition value are brought together in files of bounded size: ``rebalance`` splits a value
        that holds a large part of the rows.
        """
        if name in self.layouts:
            return self._write_parts(name, rows, None, applied)
        path = f"{self.base}/{name}/v{self._newest(name) + 1:08d}"
        writer = rows.write
        if partition_by:
            writer = rows.hint("rebalance", *[F.col(c) for c in partition_by]).write.partitionBy(*partition_by)
        writer.parquet(path)
        self._commit(name, path.rpartition("/")[2])
        return self.spark.read.schema(rows.schema).parquet(path).select(rows.columns)

    def upsert(
        self, name: str, batch: DataFrame, ddl: str, keys: list[str], rules: dict[str, str],
        unless_older: tuple[str, ...] = (), applied: tuple[str, ...] = (),
    ) -> DataFrame:
        """Merge a batch into the table by key; see :func:`titlepulse.operators.upsert.upsert`.

        A table with a layout is read and written only in the parts of the batch's keys.
        """
        if name not in self.layouts:
            return self.replace(name, upsert(self.read(name, ddl), batch, keys, rules, unless_older))
        fresh = stage(batch, "batch")
        merged = upsert(self.read_near(name, ddl, fresh), fresh, keys, rules, unless_older)
        kept = None
        if self._current(name) is not None:
            touched = fresh.select(*self._part_columns(name)).distinct()
            kept = self._manifest(name).join(touched, list(self.layouts[name]), "left_anti")
        return self._write_parts(name, merged, kept, applied)

    def expire(self, name: str, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` committed versions, and what failed writes before them have left.

        The current version always stays.
        """
        kept = sorted(self._committed(name))[-max(1, keep) :]
        for version in self._versions(name):
            if kept and version < kept[-1] and version not in kept:
                delete_folder(self.spark, f"{self.base}/{name}/v{version:08d}")
                delete_folder(self.spark, f"{self.base}/{name}/_committed/v{version:08d}")
        if name in self.layouts:
            self._expire_parts(name)

    def register_views(self, ddl_of: dict[str, str]) -> None:
        """A temporary view for each named table, so that it can be asked in SQL by its name."""
        for name, ddl in ddl_of.items():
            self.read(name, ddl).createOrReplaceTempView(name)

    # -- parts ---------------------------------------------------------------------------------------------

    def _part_columns(self, name: str) -> list:
        return [F.coalesce(F.expr(text).cast("string"), F.lit("none")).alias(column) for column, text in self.layouts[name].items()]

    def _manifest(self, name: str, version: int | None = None) -> DataFrame:
        """The list of parts: a row for each part with its version, and one for each thing applied."""
        ddl = ", ".join(f"{column} string" for column in (*self.layouts[name], _PART_VERSION, "applied"))
        return self.spark.read.schema(ddl).parquet(self._current(name) if version is None else f"{self.base}/{name}/v{version:08d}")

    def _parts(self, name: str) -> DataFrame:
        # The comparison holds for all versions; with it, Spark sees that the list selects folders, and prunes by it.
        return self._manifest(name).where(F.col(_PART_VERSION) > "").select(*self.layouts[name], _PART_VERSION)

    def _rows(self, name: str, parts: DataFrame, schema: T.StructType) -> DataFrame:
        """The rows of the listed parts.  The list has a row per part, so it is small beside them and is sent to all tasks."""
        folder, by = f"{self.base}/{name}/data", [*self.layouts[name], _PART_VERSION]
        if "data" not in self._folders(name):
            if not parts.isEmpty():
                raise RuntimeError(f"table {name}: its version lists parts, and its data is gone")
            return self.spark.createDataFrame([], schema)
        held = T.StructType([*schema.fields, *[T.StructField(column, T.StringType()) for column in by]])
        return self.spark.read.schema(held).parquet(folder).join(F.broadcast(parts), by, "left_semi").select(schema.names)

    def _write_parts(self, name: str, rows: DataFrame, kept: DataFrame | None, applied: tuple[str, ...]) -> DataFrame:
        """Write rows as new versions of their parts, and commit them together with the parts and notes in ``kept``."""
        by, number = list(self.layouts[name]), self._newest(name) + 1
        # What a failed run has left under its number must not be read as part of this one.
        own = f"{number:08d}-{uuid.uuid4().hex[:12]}"
        placed = rows.select("*", *self._part_columns(name), F.lit(own).alias(_PART_VERSION))
        placed.hint("rebalance", *[F.col(c) for c in by]).write.mode("append").partitionBy(*by, _PART_VERSION).parquet(f"{self.base}/{name}/data")
        ddl = ", ".join(f"{column} string" for column in (*by, _PART_VERSION, "applied"))
        written = self._written(name, own)
        fresh = [(*values, own, None) for values in written] + [(*[None] * len(by), None, note) for note in applied]
        listed = self.spark.createDataFrame(fresh, ddl)
        version = f"v{number:08d}"
        (listed if kept is None else kept.select(listed.columns).unionAll(listed)).distinct().repartition(1).write.parquet(f"{self.base}/{name}/{version}")
        self._commit(name, version)
        return self._rows(name, self._parts(name), rows.schema)

    def _written(self, name: str, own: str) -> list[tuple[str, ...]]:
        """The parts of which a version was just written, from their folders: as many as the layout has values."""
        return [values for values, version, _ in self._part_folders(name) if version == own]

    def _part_folders(self, name: str) -> list[tuple[tuple[str, ...], str, str]]:
        """``(part, version, path)`` of every version of every part that has a folder."""
        level = [((), f"{name}/data")]
        for _ in (*self.layouts[name], _PART_VERSION):
            level = [
                ((*values, urllib.parse.unquote(child.partition("=")[2])), f"{path}/{child}")
                for values, path in level for child in self._folders(path) if "=" in child
            ]
        return [(values[:-1], values[-1], path) for values, path in level]

    def _expire_parts(self, name: str) -> None:
        """Delete versions of parts that no kept version of the table lists; those of a write that is under way stay."""
        kept = sorted(self._committed(name))
        if not kept:
            return
        listed = {tuple(row) for n in kept for row in self._manifest(name, n).where(f"{_PART_VERSION} is not null").drop("applied").toLocalIterator()}
        for values, version, path in self._part_folders(name):
            if (*values, version) not in listed and int(version.partition("-")[0]) <= kept[-1]:
                delete_folder(self.spark, f"{self.base}/{path}")

    # -- folders -------------------------------------------------------------------------------------------

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.base).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _folders(self, name: str) -> list[str]:
        folder = self._path(f"{self.base}/{name}")
        if not self._fs().exists(folder):
            return []
        return [status.getPath().getName() for status in self._fs().listStatus(folder)]

    def _versions(self, name: str) -> list[int]:
        return [int(m.group(1)) for m in map(_VERSION.match, self._folders(name)) if m]

    def _committed(self, name: str) -> list[int]:
        return [int(m.group(1)) for m in map(_VERSION.match, self._folders(f"{name}/_committed")) if m]

    def _commit(self, name: str, version: str) -> None:
        self._fs().create(self._path(f"{self.base}/{name}/_committed/{version}")).close()

    def _newest(self, name: str) -> int:
        return max([*self._versions(name), *self._committed(name)], default=0)

    def _current(self, name: str) -> str | None:
        if "rows" in self._folders(name):
            return f"{self.base}/{name}/rows"
        committed, versions = self._committed(name), self._versions(name)
        if committed:
            if max(committed) not in versions:
                raise RuntimeError(f"table {name}: version {max(committed)} was committed and is gone")
            return f"{self.base}/{name}/v{max(committed):08d}"
        # A write that failed leaves Spark's own folders only.
        for version in versions:
            if any(file[0] not in "_." for file in self._folders(f"{name}/v{version:08d}")):
                raise RuntimeError(f"table {name}: version {version} holds data and no version was committed")
        return None
