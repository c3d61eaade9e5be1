"""Lakehouse tables: a V2 catalog where the session has one, versioned parquet where not.

Both stores offer the same calls, so that pipelines do not care which one they write to.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import merge_changes
from ..session import durable, no_rows

_COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("batch", T.LongType()),
        T.StructField("schema", T.StringType()),
        T.StructField("partitions", T.ArrayType(T.StringType())),
        T.StructField("parts", T.ArrayType(T.StringType())),
    ]
)


class VersionedTables:
    """Tables as parquet directories that are never changed once written.

    A commit names the directories that make up one version, so a reader sees a whole version or
    the one before, earlier versions stay readable, and a job may read the table it replaces.
    One writer per table at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def ensure_namespace(self, namespace: str) -> None:
        """Namespaces are the leading part of a table name; there is nothing to create."""

    def ensure_table(
        self, name: str, schema: T.StructType, partition_by: dict[str, str] | None = None
    ) -> None:
        if not self.exists(name):
            self.replace(
                name, no_rows(self.spark, schema), partition_by, operation="create"
            )

    def exists(self, name: str) -> bool:
        return self._last(name) is not None

    def read(self, name: str, version: int | None = None, partitions: bool = False) -> DataFrame:
        """A table's rows, now or as of a version; ``partitions`` adds the derived columns."""
        commit = self._commit(name, version)
        schema = T.StructType.fromJson(json.loads(commit.schema))
        derived = [_partition_field(entry, schema) for entry in commit.partitions]
        extra = [f for f in derived if f.name not in schema.names]
        base = f"{self._path(name)}/data"
        if not commit.parts:
            found = no_rows(self.spark, T.StructType([*schema.fields, *extra]))
        else:
            layout = [*schema.fields, *extra, T.StructField("commit", T.StringType())]
            found = (
                self.spark.read.schema(T.StructType(layout))
                .option("basePath", base)
                .parquet(*[f"{base}/{part}" for part in commit.parts])
            )
        return found.select(*schema.names, *([f.name for f in extra] if partitions else []))

    def append(self, name: str, df: DataFrame, batch: int | None = None) -> None:
        """Add rows. A ``batch`` that is committed already is left alone."""
        last = self._last(name)
        if last is None:
            self.replace(name, df, operation="append", batch=batch)
            return
        if batch is not None and self.has_batch(name, batch):
            return
        schema = T.StructType.fromJson(json.loads(last.schema))
        fitted = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        part = self._write(name, last.version + 1, fitted, list(last.partitions))
        self._record(
            name, "append", schema, list(last.partitions), [*last.parts, part], batch, last
        )

    def replace(
        self,
        name: str,
        df: DataFrame,
        partition_by: dict[str, str] | None = None,
        operation: str = "replace",
        batch: int | None = None,
    ) -> None:
        """Publish ``df`` as the whole table.

        ``partition_by`` maps columns to ``identity`` or ``days``; when it is left out the table
        keeps the partitioning it has.
        """
        last = self._last(name)
        if partition_by is None:
            partitions = list(last.partitions) if last else []
        else:
            partitions = [f"{kind}:{column}" for column, kind in partition_by.items()]
        version = last.version + 1 if last else 1
        part = self._write(name, version, df, partitions)
        self._record(name, operation, df.schema, partitions, [part], batch, last)

    def merge(self, name: str, latest: DataFrame, key: str = "id") -> None:
        """Apply one change per key (see ``merge_changes``).

        The changes are staged: the merge reads them three times, and their true size then decides
        whether they are broadcast.
        """
        staged = durable(latest, "changes")
        self.replace(name, merge_changes(self.read(name), staged, key), operation="merge")

    def add_column(self, name: str, column: str, kind: T.DataType) -> None:
        """Widen the schema; rows written before read as null."""
        last = self._commit(name, None)
        schema = T.StructType.fromJson(json.loads(last.schema))
        if column not in schema.names:
            wide = T.StructType([*schema.fields, T.StructField(column, kind)])
            self._record(
                name, "alter", wide, list(last.partitions), list(last.parts), None, last
            )

    def rollback(self, name: str, version: int) -> None:
        """Make an earlier version current again, as a new version."""
        old, last = self._commit(name, version), self._commit(name, None)
        schema = T.StructType.fromJson(json.loads(old.schema))
        self._record(
            name, "rollback", schema, list(old.partitions), list(old.parts), None, last
        )

    def history(self, name: str) -> DataFrame:
        return self._log(name).select(
            F.col("version").alias("snapshot_id"), "committed_at", "operation"
        )

    def has_batch(self, name: str, batch: int) -> bool:
        return not self._log(name).filter(F.col("batch") == batch).isEmpty()

    def _path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _log(self, name: str) -> DataFrame:
        return self.spark.read.schema(_COMMIT).json(f"{self._path(name)}/commits/*")

    def _last(self, name: str):
        if not path_exists(self.spark, f"{self._path(name)}/commits"):
            return None
        return self._log(name).orderBy(F.desc("version")).first()

    def _commit(self, name: str, version: int | None):
        if version is None:
            found = self._last(name)
        else:
            found = self._log(name).filter(F.col("version") == version).first()
        if found is None:
            raise ValueError(f"table {name} has no version {version or ''}".strip())
        return found

    def _write(self, name: str, version: int, df: DataFrame, partitions: list[str]) -> str:
        part = f"commit={version:08d}"
        columns = []
        for entry in partitions:
            kind, column = entry.split(":")
            if kind == "days":
                df = df.withColumn(f"{column}_day", F.to_date(column))
                columns.append(f"{column}_day")
            else:
                columns.append(column)
        path = f"{self._path(name)}/data/{part}"
        if columns:
            write_by(df, path, columns, "overwrite")
        else:
            df.write.mode("overwrite").parquet(path)
        return part

    def _record(self, name, operation, schema, partitions, parts, batch, last) -> None:
        version = last.version + 1 if last else 1
        values = [
            version,
            operation,
            datetime.now(timezone.utc),
            batch,
            schema.json(),
            partitions,
            parts,
        ]
        row = [
            F.lit(value).cast(field.dataType).alias(field.name)
            for field, value in zip(_COMMIT, values)
        ]
        commit = self.spark.range(0, 1, 1, 1).select(*row)
        commit.write.mode("overwrite").json(f"{self._path(name)}/commits/{version:08d}")


class CatalogTables:
    """The same calls on a V2 catalog whose tables know snapshots and row-level merges."""

    def __init__(self, spark: SparkSession, catalog: str, provider: str = "iceberg"):
        self.spark = spark
        self.catalog = catalog
        self.provider = provider

    def _name(self, name: str) -> str:
        return f"{self.catalog}.{name}"

    def ensure_namespace(self, namespace: str) -> None:
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.catalog}.{namespace}")

    def ensure_table(self, name, schema, partition_by=None) -> None:
        if not self.exists(name):
            empty = no_rows(self.spark, schema)
            self._writer(name, empty, partition_by).create()

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._name(name))

    def read(self, name: str, version: int | None = None, partitions: bool = False) -> DataFrame:
        if version is None:
            return self.spark.table(self._name(name))
        return self.spark.sql(f"SELECT * FROM {self._name(name)} VERSION AS OF {int(version)}")

    def append(self, name: str, df: DataFrame, batch: int | None = None) -> None:
        """Add rows. A ``batch`` is a condition of the writer here, by its snapshot property."""
        writer = df.writeTo(self._name(name))
        if batch is not None:
            if self.has_batch(name, batch):
                return
            writer = writer.option("snapshot-property.batch", str(batch))
        writer.append()

    def has_batch(self, name: str, batch: int) -> bool:
        snapshots = self.spark.table(f"{self._name(name)}.snapshots")
        return not snapshots.filter(F.col("summary")["batch"] == str(batch)).isEmpty()

    def replace(self, name, df, partition_by=None, operation="replace", batch=None) -> None:
        """Replacing a table also replaces its partitioning, so it is always stated here."""
        self._writer(name, df, partition_by).createOrReplace()

    def merge(self, name: str, latest: DataFrame, key: str = "id") -> None:
        columns = self.spark.table(self._name(name)).columns
        target, source = f"{self._name(name)}", latest.alias("s")
        row = {column: F.col(f"s.{column}") for column in columns}
        # As merge_changes has it: a change is stale only where both times are known.
        fresh = F.expr(f"coalesce(s.last_updated_ms >= {target}.last_updated_ms, true)")
        (
            source.mergeInto(target, F.expr(f"{target}.{key} <=> s.{key}"))
            .whenMatched(fresh & (F.col("s.op") == "d"))
            .delete()
            .whenMatched(fresh & F.col("s.op").isin("c", "u", "r"))
            .update(row)
            .whenNotMatched(F.col("s.op") != "d")
            .insert(row)
            .merge()
        )

    def add_column(self, name: str, column: str, kind: T.DataType) -> None:
        if column not in self.spark.table(self._name(name)).columns:
            self.spark.sql(
                f"ALTER TABLE {self._name(name)} ADD COLUMN {column} {kind.simpleString()}"
            )

    def rollback(self, name: str, version: int) -> None:
        self.spark.sql(
            f"CALL {self.catalog}.system.rollback_to_snapshot('{name}', {int(version)})"
        )

    def history(self, name: str) -> DataFrame:
        return self.spark.table(f"{self._name(name)}.snapshots").select(
            "snapshot_id", "committed_at", "operation"
        )

    def _writer(self, name, df, partition_by):
        writer = df.writeTo(self._name(name)).using(self.provider)
        parts = [
            F.partitioning.days(F.col(column)) if kind == "days" else F.col(column)
            for column, kind in (partition_by or {}).items()
        ]
        return writer.partitionedBy(*parts) if parts else writer


def write_by(df: DataFrame, path: str, columns: list[str], mode: str, dynamic: bool = False):
    """Write parquet partitioned by ``columns``.

    The rows of a value are brought together by a rebalance, not a repartition: AQE splits a value
    that holds most rows over several tasks and joins small ones, so files come out near the
    advisory size.
    """
    df.hint("rebalance", *columns).write.mode(mode).option(
        "partitionOverwriteMode", "dynamic" if dynamic else "static"
    ).partitionBy(*columns).parquet(path)


def write_clustered(
    df: DataFrame, path: str, folder: dict[str, Column], by: list[str], mode: str = "overwrite"
) -> None:
    """Write parquet in a few coarse folders, the rows of each file in a narrow range of ``by``.

    Rows are split by range over all of ``by``, so a busy date is spread over several files, and
    sorted inside: the least and largest values that parquet keeps of each row group then tell a
    filter on ``by`` which few to read. ``folder`` names the coarse columns and what they hold;
    they should rise with ``by``, or every task writes to every folder.
    """
    wide = df.withColumns(folder)
    ranged = wide.repartitionByRange(*folder, *by).sortWithinPartitions(*folder, *by)
    ranged.write.mode(mode).partitionBy(*folder).parquet(path)


def append_partitioned(df: DataFrame, path: str, by: str) -> None:
    write_by(df, path, [by], "append")


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace exactly the partitions that ``df`` has rows for.

    ``df`` must hold the whole content of those partitions. The mode is set on the writer, so no
    other write of the session changes its meaning.
    """
    write_by(df, path, [by], "overwrite", dynamic=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _partition_field(entry: str, schema: T.StructType) -> T.StructField:
    kind, column = entry.split(":")
    if kind == "days":
        return T.StructField(f"{column}_day", T.DateType())
    return schema[column]
