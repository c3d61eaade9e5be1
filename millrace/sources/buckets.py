"""Keyed state as parquet in hash buckets: a batch reads and writes only the buckets it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable, no_rows
from .tables import path_exists, write_by

BUCKETS = 64

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class BucketedState:
    """One row per key, dealt by a hash of the key into ``bucket=`` folders.

    ``fold`` is done once per batch number, whatever fails: new buckets are staged first, then
    written over the old ones, then the number is recorded. A run that dies before the staging is
    complete has changed nothing; one that dies later is finished from the staged rows by the next call with
    that number, which does not look at the half-written state. One writer at a time.

    Size ``buckets`` so that one of them is a few files; the number is fixed for a state's life.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS
    ):
        self.spark = spark
        self.schema = schema
        self.key = key
        self.buckets = buckets
        self.data = f"{path}/data"
        self.staged = f"{path}/staged"
        self.done = f"{path}/done"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; other folders are not listed or opened."""
        if not path_exists(self.spark, self.data):
            return no_rows(self.spark, self.schema)
        layout = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        found = self.spark.read.schema(layout).parquet(self.data)
        if buckets is not None:
            found = found.filter(F.col("bucket").isin(buckets))
        return found.select(*self.schema.names)

    def fold(self, batch: DataFrame, number: int, merge: Merge) -> list[int]:
        """Put ``merge(rows of the touched buckets, batch)`` in their place; the buckets touched.

        ``batch`` has the key column; ``merge`` returns the state's columns, and every row that
        stays.
        """
        marker, staged = f"{self.done}/{number}", f"{self.staged}/{number}"
        if path_exists(self.spark, marker):
            return []
        if not path_exists(self.spark, f"{staged}/_SUCCESS"):
            keyed = durable(batch, "fold")
            touched = [r[0] for r in keyed.select(self.bucket()).distinct().collect()]
            rows = merge(self.read(touched), keyed) if touched else no_rows(self.spark, self.schema)
            kept = rows.select(*self.schema.names).withColumn("bucket", self.bucket())
            write_by(kept, staged, ["bucket"], "overwrite")
        layout = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(layout).parquet(staged)
        written = sorted(r.bucket for r in rows.select("bucket").distinct().collect())
        if written:
            write_by(rows, self.data, ["bucket"], "overwrite", dynamic=True)
        touch(self.spark, marker)
        remove(self.spark, staged)
        return written


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, which marks that something is complete."""
    hadoop, files = _file_system(spark, path)
    files.create(hadoop, True).close()


def remove(spark: SparkSession, path: str) -> None:
    hadoop, files = _file_system(spark, path)
    files.delete(hadoop, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    hadoop, files = _file_system(spark, path)
    if not files.exists(hadoop):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(hadoop)]
