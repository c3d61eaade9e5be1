"""Incremental current-state mirrors: only new bronze events are read, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cdc import fold_state, latest_changes, mirror_rows
from ..schemas import BRONZE_CDC


class TableState:
    """The state of an entity as one table of a store. Folding a batch twice changes nothing."""

    def __init__(self, tables, name: str):
        self.tables, self.name = tables, name

    def read(self) -> DataFrame:
        return self.tables.read(self.name)

    def fold(self, batch: DataFrame, number: int, merge) -> None:
        state = self.read() if self.tables.exists(self.name) else None
        self.tables.replace(self.name, merge(state, batch), operation="fold")


def run_mirror_stream(
    spark: SparkSession,
    bronze_path: str,
    state,
    *where,
    max_files: int | None = None,
) -> None:
    """Fold the new bronze events of one entity into its state, then stop.

    A batch reads and writes the buckets that its keys fall in. The state keeps deleted keys, so an
    older event that comes late cannot bring a row back. A batch that Spark replays after a failure
    is folded once.

    ``where`` is the entity and the checkpoint folder. ``state`` may also be a store of tables, with the
    table's name before the entity; a batch then writes the whole table.
    """
    *name, entity, checkpoint = where
    state = TableState(state, *name) if name else state

    def fold(batch: DataFrame, number: int) -> None:
        state.fold(latest_changes(batch, entity), number, fold_state)

    reader = spark.readStream.schema(BRONZE_CDC)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.parquet(bronze_path)
        .writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_mirror(state, *where) -> DataFrame:
    """Current rows of an entity; a store of tables takes the table's name before the entity."""
    *name, entity = where
    return mirror_rows((TableState(state, *name) if name else state).read(), entity)
