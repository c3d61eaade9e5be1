"""Column contracts of every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIMESTAMP, BOOLEAN, DATE = T.TimestampType(), T.BooleanType(), T.DateType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


@dataclass(frozen=True)
class TripColumn:
    """One trip attribute: its raw name, its type on the wire and its silver name and type."""

    raw: str
    wire: T.DataType
    silver: str
    kind: T.DataType


# The public yellow-taxi trip record and the names its silver form uses.
TRIP_COLUMNS = (
    TripColumn("VendorID", INT, "vendor_id", INT),
    TripColumn("tpep_pickup_datetime", STRING, "pickup_datetime", TIMESTAMP),
    TripColumn("tpep_dropoff_datetime", STRING, "dropoff_datetime", TIMESTAMP),
    TripColumn("passenger_count", DOUBLE, "passenger_count", INT),
    TripColumn("trip_distance", DOUBLE, "trip_distance", DOUBLE),
    TripColumn("RatecodeID", DOUBLE, "rate_code_id", INT),
    TripColumn("store_and_fwd_flag", STRING, "store_and_fwd_flag", STRING),
    TripColumn("PULocationID", INT, "pu_location_id", INT),
    TripColumn("DOLocationID", INT, "do_location_id", INT),
    TripColumn("payment_type", INT, "payment_type", INT),
    TripColumn("fare_amount", DOUBLE, "fare_amount", DOUBLE),
    TripColumn("extra", DOUBLE, "extra", DOUBLE),
    TripColumn("mta_tax", DOUBLE, "mta_tax", DOUBLE),
    TripColumn("tip_amount", DOUBLE, "tip_amount", DOUBLE),
    TripColumn("tolls_amount", DOUBLE, "tolls_amount", DOUBLE),
    TripColumn("improvement_surcharge", DOUBLE, "improvement_surcharge", DOUBLE),
    TripColumn("total_amount", DOUBLE, "total_amount", DOUBLE),
    TripColumn("congestion_surcharge", DOUBLE, "congestion_surcharge", DOUBLE),
    TripColumn("Airport_fee", DOUBLE, "airport_fee", DOUBLE),
    TripColumn("cbd_congestion_fee", DOUBLE, "cbd_congestion_fee", DOUBLE),
)

RAW_TRIP_NAMES = [c.raw for c in TRIP_COLUMNS]
SILVER_TRIP_NAMES = [c.silver for c in TRIP_COLUMNS]

TRIP_WIRE = T.StructType([T.StructField(c.raw, c.wire) for c in TRIP_COLUMNS])
TRIP_TYPED = T.StructType([T.StructField(c.raw, c.kind) for c in TRIP_COLUMNS])
BRONZE_TRIPS = T.StructType([*TRIP_WIRE.fields, T.StructField("trip_id", LONG)])

ZONE_NAMES = ["pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough"]
SILVER_TRIPS = T.StructType(
    [T.StructField("trip_id", LONG)]
    + [T.StructField(c.silver, c.kind) for c in TRIP_COLUMNS]
    + [T.StructField(name, STRING) for name in ZONE_NAMES]
)

# Which columns the ingest rules, the two dedups and the publish step name.
MONEY_COLUMNS = [
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
]
FUNNEL_KEY = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "passenger_count",
    "trip_duration_minutes",
]
PUBLISH_KEY = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "source_file",
]
PUBLISHED_TRIP_NAMES = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "PU_Zone",
    "DO_Zone",
    "passenger_count",
    "trip_distance",
    "trip_duration_minutes",
    "pickup_date",
    "source_file",
    "ingested_at",
    "fare_amount",
]
SILVER_KEY = ["vendor_id", "pickup_datetime", "pu_location_id", "do_location_id", "fare_amount"]

# Raw columns without which, or at or below zero, a trip breaks the rules of its pipeline.
TRIP_ENDS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"]
INGEST_PRESENT = [*TRIP_ENDS, "passenger_count", "total_amount"]
INGEST_ABOVE_ZERO = ["trip_distance"]
SILVER_PRESENT = [*TRIP_ENDS, "VendorID", "passenger_count"]
SILVER_ABOVE_ZERO = ["trip_distance", "fare_amount", "total_amount"]

PUBLISHED_TRIPS = struct(
    tpep_pickup_datetime=TIMESTAMP,
    tpep_dropoff_datetime=TIMESTAMP,
    PULocationID=INT,
    DOLocationID=INT,
    PU_Zone=STRING,
    DO_Zone=STRING,
    passenger_count=INT,
    trip_distance=DOUBLE,
    trip_duration_minutes=DOUBLE,
    pickup_date=DATE,
    source_file=STRING,
    ingested_at=TIMESTAMP,
    fare_amount=DOUBLE,
    is_suspicious=BOOLEAN,
)

RECORD = struct(
    key=STRING, value=STRING, topic=STRING, partition=INT, offset=LONG, timestamp=TIMESTAMP
)

MANIFEST = struct(
    filename=STRING,
    size_bytes=LONG,
    modified_at=TIMESTAMP,
    raw_row_count=LONG,
    clean_row_count=LONG,
    after_dedup_row_count=LONG,
    processed_at=TIMESTAMP,
    batch=LONG,
)

GOLD_HOURLY = struct(
    pickup_zone=STRING, hour=TIMESTAMP, trip_count=LONG, avg_fare=DOUBLE, avg_distance=DOUBLE
)
GOLD_PAYMENT = struct(
    payment_type=INT,
    payment_label=STRING,
    trip_count=LONG,
    avg_total_amount=DOUBLE,
    pct_of_total=DOUBLE,
)

BRONZE_CDC = struct(
    topic=STRING,
    kafka_partition=INT,
    kafka_offset=LONG,
    kafka_timestamp=TIMESTAMP,
    op=STRING,
    ts_ms=LONG,
    lsn=LONG,
    before=STRING,
    after=STRING,
)

CUSTOMER_ACTIVITY = struct(
    customer_id=INT,
    first_seen_ts=TIMESTAMP,
    total_events=LONG,
    email_changes=LONG,
    country_changes=LONG,
    fields_changed_most_often=STRING,
    current_status=STRING,
    days_since_last_change=INT,
    last_change_ts=TIMESTAMP,
    ever_deleted=BOOLEAN,
    deleted_at_ts=TIMESTAMP,
)


@dataclass(frozen=True)
class Entity:
    """A captured source table: its topic and the columns its mirror keeps."""

    topic: str
    columns: T.StructType

    @property
    def mirror(self) -> T.StructType:
        fields = [T.StructField("id", INT), *self.columns.fields]
        return T.StructType([*fields, T.StructField("last_updated_ms", LONG)])

    def with_column(self, name: str, kind: T.DataType) -> Entity:
        """The entity after its source table gained a column."""
        return Entity(self.topic, T.StructType([*self.columns.fields, T.StructField(name, kind)]))


CUSTOMERS = Entity(
    "dbserver1.public.customers",
    struct(name=STRING, email=STRING, country=STRING),
)
DRIVERS = Entity(
    "dbserver1.public.drivers",
    struct(
        name=STRING,
        license_number=STRING,
        rating=DOUBLE,
        city=STRING,
        active=BOOLEAN,
        created_at=STRING,
    ),
)
