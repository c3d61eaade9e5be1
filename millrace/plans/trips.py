"""Trip pipelines: bronze from a stream or from files, silver, gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import rounded_mean, rounded_share
from ..operators.gold import Mean, Share, hourly, payment_mix
from ..operators.ids import dense_ids
from ..operators.trips import add_trip_id, parse_trips, rename_trips, scan_filter, silver
from ..schemas import (
    BRONZE_TRIPS,
    GOLD_HOURLY,
    GOLD_PAYMENT,
    SILVER_ABOVE_ZERO,
    SILVER_PRESENT,
    SILVER_TRIPS,
    SILVER_TRIP_NAMES,
    ZONE_NAMES,
)
from ..streaming.bronze import bronze_trip_stream

HOURLY, PAYMENT = "taxi.gold_hourly_trips", "taxi.gold_payment_distribution"
SILVER, BRONZE = "taxi.silver_trips", "taxi.bronze_trips"
_POSITION = ["kafka_timestamp", "partition", "offset"]


def stream_to_bronze(records: DataFrame, path: str, checkpoint: str) -> None:
    bronze_trip_stream(records, path, checkpoint)


def files_to_bronze(
    tables, trips: DataFrame, batch: int | None = None, dense: bool = False
) -> None:
    """Append raw trips with an id. With a ``batch`` number a repeated run adds nothing.

    Ids are hashes of rows, or with ``dense`` unique numbers that go on from the table's last.
    """
    tables.ensure_namespace("taxi")
    tables.ensure_table(BRONZE, BRONZE_TRIPS)
    if batch is not None and tables.has_batch(BRONZE, batch):
        return
    if dense:
        last = tables.read(BRONZE).agg(F.max("trip_id")).first()[0] or 0
        numbered = dense_ids(trips, "trip_id", start=last + 1)
    else:
        numbered = add_trip_id(trips)
    tables.append(BRONZE, numbered, **({} if batch is None else {"batch": batch}))


def silver_from_messages(bronze: DataFrame, zones: DataFrame) -> DataFrame:
    """Silver from JSON messages; of equal trips the message that came first stays."""
    parsed = parse_trips(bronze, keep=tuple(_POSITION))
    return silver(parsed, zones, _POSITION).select(
        *SILVER_TRIP_NAMES, "kafka_timestamp", *ZONE_NAMES
    )


def silver_from_bronze(bronze: DataFrame, zones: DataFrame) -> DataFrame:
    usable = scan_filter(bronze, SILVER_PRESENT, SILVER_ABOVE_ZERO)
    return silver(rename_trips(usable), zones, ["trip_id"]).select(*SILVER_TRIPS.names)


def publish_silver(tables, rows: DataFrame) -> None:
    tables.ensure_namespace("taxi")
    tables.replace(SILVER, rows)


def publish_hourly(tables, mean: Mean = rounded_mean) -> None:
    """Hourly gold from the silver table, partitioned by day."""
    tables.ensure_table(HOURLY, GOLD_HOURLY, {"hour": "days"})
    tables.replace(HOURLY, hourly(tables.read(SILVER), mean), {"hour": "days"})


def publish_payment_mix(tables, mean: Mean = rounded_mean, share: Share = rounded_share) -> None:
    """Payment mix from the silver table, partitioned by payment type."""
    by = {"payment_type": "identity"}
    tables.ensure_table(PAYMENT, GOLD_PAYMENT, by)
    tables.replace(PAYMENT, payment_mix(tables.read(SILVER), mean, share), by)
