"""Silver and hourly trips as streams, with state that the watermark bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import rounded_mean
from ..functions.rules import SILVER_RULES, apply_rules
from ..operators.enrich import enrich
from ..operators.gold import Mean
from ..operators.trips import parse_trips
from ..schemas import SILVER_KEY, SILVER_TRIP_NAMES, ZONE_NAMES
from .bronze import run_to_end

DELAY = "2 hours"


def silver_stream(bronze: DataFrame, zones: DataFrame, delay: str = DELAY) -> DataFrame:
    """Typed, clean and enriched trips of a bronze stream, one for each trip key.

    A trip is known for ``delay`` after the message that brought it, across micro-batches and
    restarts; then its state goes. So state holds the trips of about that time, not all there have
    been. What comes again later than that is a new trip, and a message that is older than the newest
    by more than ``delay`` is left out. Of the equal trips of one micro-batch any may stay; of those of two,
    the one of the first.
    """
    parsed = apply_rules(parse_trips(bronze), SILVER_RULES)
    once = parsed.withWatermark("kafka_timestamp", delay).dropDuplicatesWithinWatermark(SILVER_KEY)
    picked = enrich(
        once, zones, "pu_location_id", {"Zone": "pickup_zone", "Borough": "pickup_borough"}
    )
    both = enrich(
        picked, zones, "do_location_id", {"Zone": "dropoff_zone", "Borough": "dropoff_borough"}
    )
    return both.select(*SILVER_TRIP_NAMES, "kafka_timestamp", *ZONE_NAMES)


def hourly_stream(silver: DataFrame, delay: str = DELAY, mean: Mean = rounded_mean) -> DataFrame:
    """Trips, mean fare and mean distance per pickup zone and hour, once the hour is closed.

    An hour is closed when a trip has been seen that began ``delay`` or more after its end. It comes out
    once and is not changed again: trips that come later are left out.
    """
    return (
        silver.withWatermark("pickup_datetime", delay)
        .groupBy("pickup_zone", F.window("pickup_datetime", "1 hour").alias("hours"))
        .agg(
            F.count("*").alias("trip_count"),
            mean("fare_amount").alias("avg_fare"),
            mean("trip_distance").alias("avg_distance"),
        )
        .select(
            "pickup_zone", F.col("hours.start").alias("hour"), "trip_count", "avg_fare", "avg_distance"
        )
    )


def write_silver(bronze: DataFrame, zones: DataFrame, path: str, checkpoint: str, delay: str = DELAY):
    run_to_end(silver_stream(bronze, zones, delay), path, checkpoint)


def write_hourly(silver: DataFrame, path: str, checkpoint: str, delay: str = DELAY) -> None:
    run_to_end(hourly_stream(silver, delay), path, checkpoint)
