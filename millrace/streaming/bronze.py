"""Append-only bronze streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.cdc import parse_envelope
from ..operators.trips import record_columns


def run_to_end(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available, then stop; a rerun goes on after the checkpoint."""
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_to_table(rows: DataFrame, table: str, path: str, checkpoint: str) -> None:
    """The same into a parquet table of the session's catalog, created at ``path`` by the first run.

    A table that exists keeps its place. Readers of the table see files of finished micro-batches only.
    """
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .toTable(table)
    )
    query.awaitTermination()


def bronze_trip_table(records: DataFrame, table: str, path: str, checkpoint: str) -> None:
    run_to_table(records.select(*record_columns()), table, path, checkpoint)


def bronze_trip_stream(records: DataFrame, path: str, checkpoint: str) -> None:
    run_to_end(records.select(*record_columns()), path, checkpoint)


def bronze_cdc_stream(records: DataFrame, path: str, checkpoint: str) -> None:
    run_to_end(parse_envelope(records), path, checkpoint)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A streamed table: only files that the stream has committed are read."""
    return spark.read.schema(schema).parquet(path)
