"""Trip records: typing, JSON in and out, derived columns, cleaning, funnel and flag."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import generated, iso_time, safe_cast, suspicious, trip_minutes
from ..functions.rules import INGEST_RULES, SILVER_RULES, all_good, apply_rules
from ..schemas import (
    FUNNEL_KEY,
    MONEY_COLUMNS,
    PUBLISH_KEY,
    RAW_TRIP_NAMES,
    SILVER_KEY,
    TRIP_COLUMNS,
    TRIP_WIRE,
)
from .dedup import keep_first
from .enrich import enrich


def normalise(df: DataFrame) -> DataFrame:
    """Trip columns under their own names and declared types; other columns pass through.

    A trip column that the input lacks (older files) comes back as null.
    """
    given = {field.name.lower(): field.dataType for field in df.schema}
    typed = [
        safe_cast(F.col(c.raw), c.kind, given[c.raw.lower()]).alias(c.raw)
        if c.raw.lower() in given
        else F.lit(None).cast(c.kind).alias(c.raw)
        for c in TRIP_COLUMNS
    ]
    known = {name.lower() for name in RAW_TRIP_NAMES}
    return df.select(*typed, *[name for name in df.columns if name.lower() not in known])


def encode_records(
    df: DataFrame, key: str = "VendorID", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows as keyed JSON messages, times in ISO-8601. Null fields are left out of the text.

    Columns in ``keep`` stay beside the message instead of going into it.
    """
    fields = [
        iso_time(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        else F.col(f.name)
        for f in df.schema
        if f.name not in keep
    ]
    return df.select(
        *keep,
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def record_columns() -> list[Column]:
    """The message layout of bronze: text key and value plus where the message came from."""
    return [
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ]


def silver_columns() -> list[Column]:
    """The typed snake_case form of a raw trip."""
    return [safe_cast(F.col(c.raw), c.kind, c.wire).alias(c.silver) for c in TRIP_COLUMNS]


def parse_trips(bronze: DataFrame, keep: tuple[str, ...] = ("kafka_timestamp",)) -> DataFrame:
    """Trip JSON to typed silver columns; text that is not a trip gives nulls."""
    parsed = bronze.select(generated(F.from_json("value", TRIP_WIRE)), *keep)
    return parsed.select(*silver_columns(), *keep)


def rename_trips(bronze: DataFrame, keep: tuple[str, ...] = ("trip_id",)) -> DataFrame:
    """Raw trip columns, as a parquet bronze table holds them, to typed silver columns."""
    given = {field.name: field.dataType for field in bronze.schema}
    typed = [
        safe_cast(F.col(c.raw), c.kind, given[c.raw]).alias(c.silver) for c in TRIP_COLUMNS
    ]
    return bronze.select(*keep, *typed)


def scan_filter(raw: DataFrame, present: list[str], above_zero: list[str]) -> DataFrame:
    """Drop what a scan can rule out on raw columns; the rules decide again on typed values.

    The rules look at casts that no file format can evaluate. These plain comparisons can be, so
    row groups and pages without a usable trip are never decoded.
    """
    given = {field.name.lower(): field.dataType for field in raw.schema}
    for name in present:
        if name.lower() in given:
            raw = raw.filter(F.col(name).isNotNull())
    for name in above_zero:
        if isinstance(given.get(name.lower()), T.NumericType):
            raw = raw.filter(F.col(name) > 0)
    return raw


def add_trip_id(df: DataFrame, stable: bool = True) -> DataFrame:
    """A surrogate id.

    The stable form hashes the whole row: it is the same on each read, however the files are
    split, while a generated id moves with the split. Equal rows get equal ids.
    """
    made = (
        F.xxhash64(*[F.col(name) for name in df.columns])
        if stable
        else F.monotonically_increasing_id()
    )
    return df.withColumn("trip_id", made)


def derive(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        trip_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime").alias(
            "trip_duration_minutes"
        ),
        F.to_date("tpep_pickup_datetime").alias("pickup_date"),
    )


def zeroed(df: DataFrame) -> DataFrame:
    """Missing money counts as zero."""
    money = {*MONEY_COLUMNS, "fare_amount"}
    return df.select(
        *[F.coalesce(n, F.lit(0.0)).alias(n) if n in money else F.col(n) for n in df.columns]
    )


def clean(df: DataFrame) -> DataFrame:
    """The ingest rules; missing money counts as zero, and the sign of the fare is not checked."""
    return zeroed(apply_rules(df, INGEST_RULES))


def funnel(typed: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Raw, clean and deduplicated row counts of each source file, from one scan.

    Invalid rows carry a null key, which a distinct count passes over. The distinct part first
    groups by file and key together, so a file that holds most rows is still spread out.
    """
    key = key or FUNNEL_KEY
    valid = F.coalesce(all_good(INGEST_RULES), F.lit(False))
    columns = derive(typed).select(
        "source_file",
        valid.alias("valid"),
        F.when(valid, F.struct(*key)).alias("dedup_key"),
    )
    return columns.groupBy("source_file").agg(
        F.count("*").alias("raw_row_count"),
        F.count_if("valid").alias("clean_row_count"),
        F.count_distinct("dedup_key").alias("after_dedup_row_count"),
    )


def flag_suspicious(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "is_suspicious",
        suspicious(F.col("trip_duration_minutes"), F.col("trip_distance"), F.col("fare_amount")),
    )


def publishable(
    typed: DataFrame, zones: DataFrame, ingested_at: datetime | None, counted: bool = False
) -> DataFrame:
    """Clean trips, deduplicated and enriched, in the published layout with the flag.

    ``counted`` adds how many clean rows each one stands for, as ``copies``.
    """
    return published(clean(typed), zones, ingested_at, counted)


def published(
    cleaned: DataFrame, zones: DataFrame, ingested_at: datetime | None, counted: bool = False
) -> DataFrame:
    """The same from clean rows, of which it needs the dedup key only.

    All other published columns follow from the key, so the distinct runs on the key alone
    (hash aggregation on both sides of one shuffle) and the rest is derived after it.
    """
    keys = cleaned.select(*PUBLISH_KEY)
    if counted:
        unique = keys.groupBy(*PUBLISH_KEY).agg(F.count("*").alias("copies"))
    else:
        unique = keys.distinct()
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    derived = derive(unique).withColumn("ingested_at", stamp.cast("timestamp"))
    named = enrich(
        enrich(derived, zones, "PULocationID", {"Zone": "PU_Zone"}),
        zones,
        "DOLocationID",
        {"Zone": "DO_Zone"},
    )
    return flag_suspicious(named)


def suspicious_share(flagged: DataFrame) -> DataFrame:
    """One row: all trips, suspicious trips and their share in percent (null without trips)."""
    counts = flagged.agg(
        F.count("*").alias("total_trips"),
        F.count_if("is_suspicious").alias("suspicious_trips"),
    )
    share = F.try_divide(F.col("suspicious_trips") * 100.0, F.col("total_trips"))
    return counts.withColumn("suspicious_pct", share)


def silver(parsed: DataFrame, zones: DataFrame, first_by: list[str]) -> DataFrame:
    """Typed trips to silver: rules, one row per trip key, zone and borough at both ends.

    Of the rows with one key the first in ``first_by`` stays; the remaining columns break ties, so
    the choice never depends on how the rows are split.
    """
    rest = [name for name in parsed.columns if name not in [*SILVER_KEY, *first_by]]
    kept = keep_first(apply_rules(parsed, SILVER_RULES), SILVER_KEY, [*first_by, *rest])
    picked = enrich(
        kept, zones, "pu_location_id", {"Zone": "pickup_zone", "Borough": "pickup_borough"}
    )
    return enrich(
        picked, zones, "do_location_id", {"Zone": "dropoff_zone", "Borough": "dropoff_borough"}
    )
