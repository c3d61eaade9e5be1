"""The change log, batch by batch: nothing that a batch does not touch is read or written.

New records are told from replays by the ledger of positions. They are appended to the log, folded into
mirrors that lie in hash buckets, and folded into one summary row per customer, from which activity
and churn follow. Each step is done once per batch number, and the number is recorded last: a
run that dies is taken up again by the next run, which gets the same number.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import changes, fold_state, latest_changes, mirror_rows, parse_envelope
from ..operators.checks import differences, duplicate_keys, parity
from ..operators.gold import (
    HISTORY,
    activity_rows,
    batch_history,
    customer_churn,
    customer_events,
    extended_history,
)
from ..schemas import BRONZE_CDC, CUSTOMERS, DRIVERS, INT, Entity
from ..session import durable, no_rows
from ..sources.buckets import BUCKETS, BucketedState, names_in, touch
from ..sources.ledger import LEDGER, positions, unseen
from ..sources.tables import path_exists

ENTITIES = {"customers": CUSTOMERS, "drivers": DRIVERS}
_STORED = T.StructType([*BRONZE_CDC.fields, T.StructField("ingest_batch", INT)])


def state_schema(spark: SparkSession, entity: Entity) -> T.StructType:
    """Columns of an entity's newest changes."""
    return changes(no_rows(spark, BRONZE_CDC), entity).schema


class IncrementalCdc:
    """Log, mirrors, customer history and gold tables below one folder. One writer at a time."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = BUCKETS,
        entities: dict[str, Entity] = ENTITIES,
    ):
        self.spark = spark
        self.root = root
        self.entities = entities
        self.states = {
            name: BucketedState(
                spark, f"{root}/{name}", state_schema(spark, entity), "id", buckets
            )
            for name, entity in entities.items()
        }
        self.history = BucketedState(spark, f"{root}/history", HISTORY, "entity_id", buckets)

    def last_batch(self) -> int:
        return max((int(n) for n in names_in(self.spark, f"{self.root}/batches")), default=0)

    def log(self, batches: int | None = None) -> DataFrame:
        """Records of all finished batches, or of the first ``batches``."""
        last = self.last_batch() if batches is None else batches
        if not path_exists(self.spark, f"{self.root}/log"):
            return no_rows(self.spark, BRONZE_CDC)
        stored = self.spark.read.schema(_STORED).parquet(f"{self.root}/log")
        return stored.filter(F.col("ingest_batch") <= last).select(*BRONZE_CDC.names)

    def ledger(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/ledger"):
            return no_rows(self.spark, LEDGER)
        layout = T.StructType([*LEDGER.fields, T.StructField("ingest_batch", INT)])
        stored = self.spark.read.schema(layout).parquet(f"{self.root}/ledger")
        return stored.filter(F.col("ingest_batch") <= self.last_batch()).select(*LEDGER.names)

    def run(self, records: DataFrame) -> int:
        """Take one batch of records; its number.

        A batch that was written to the log but not finished is finished first, as it was written.
        """
        number = self.last_batch() + 1
        if path_exists(self.spark, f"{self._folder('log', number)}/_SUCCESS"):
            self.finish(number)
            number += 1
        new = unseen(parse_envelope(records), self.ledger())
        new.write.mode("overwrite").parquet(self._folder("log", number))
        return self.finish(number)

    def finish(self, number: int) -> int:
        """What follows from a batch in the log, each step once."""
        batch = self.spark.read.schema(BRONZE_CDC).parquet(self._folder("log", number))
        positions(batch).write.mode("overwrite").parquet(self._folder("ledger", number))
        for name, entity in self.entities.items():
            self.states[name].fold(latest_changes(batch, entity), number, fold_state)
        self._fold_history(batch, number)
        touch(self.spark, f"{self.root}/batches/{number}")
        return number

    def mirror(self, name: str) -> DataFrame:
        return mirror_rows(self.states[name].read(), self.entities[name])

    def activity(self, as_of: datetime | None = None) -> DataFrame:
        return activity_rows(self.history.read(), self.mirror("customers"), as_of)

    def churn(self, as_of: datetime | None = None, mode: str = "intended") -> DataFrame:
        return customer_churn(self.activity(as_of), as_of, mode)

    def validate(self, name: str, source: DataFrame) -> DataFrame:
        """One row: parity with the source and the number of keys the mirror holds twice."""
        mirror = self.mirror(name)
        doubled = duplicate_keys(mirror, ["id"]).agg(F.count("*").alias("n")).scalar()
        return parity(mirror, source).withColumn("duplicate_keys", doubled)

    def differences(self, name: str, source: DataFrame) -> DataFrame:
        """Rows that only the mirror or only the source holds, found by fingerprints."""
        return differences(self.mirror(name).select(*source.columns), source, ["id"])

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.root}/{kind}/ingest_batch={number}"

    def _fold_history(self, batch: DataFrame, number: int) -> None:
        """Summaries of a batch after those stored.

        A customer with an event older than its stored last one cannot be summed up in order; its
        events, of all batches, are read from the log again, and only its.
        """

        def extended(stored: DataFrame, new: DataFrame) -> DataFrame:
            late = new.join(stored.select("entity_id", F.col("last").alias("_last")), "entity_id")
            late = durable(late.filter(F.col("first") <= F.col("_last")).select("entity_id"), "late")
            on_time = new.join(late, "entity_id", "left_anti")
            rest = stored.join(late, "entity_id", "left_anti")
            found = extended_history(rest, on_time)
            if late.isEmpty():
                return found
            events = customer_events(self.log(number)).join(late, "entity_id", "left_semi")
            return found.unionByName(batch_history(events).select(*HISTORY.names))

        self.history.fold(batch_history(customer_events(batch)), number, extended)
