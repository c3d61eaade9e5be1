"""Hand-written trips: a good one, with the fields a test changes."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import SILVER_TRIP_NAMES, TRIP_COLUMNS, TRIP_WIRE

GOOD = dict(
    VendorID=1,
    tpep_pickup_datetime="2025-01-01 10:00:00",
    tpep_dropoff_datetime="2025-01-01 10:30:00",
    passenger_count=1.0,
    trip_distance=2.5,
    RatecodeID=1.0,
    store_and_fwd_flag="N",
    PULocationID=10,
    DOLocationID=20,
    payment_type=1,
    fare_amount=12.0,
    extra=0.5,
    mta_tax=0.5,
    tip_amount=1.0,
    tolls_amount=0.0,
    improvement_surcharge=0.3,
    total_amount=14.3,
    congestion_surcharge=0.0,
    Airport_fee=0.0,
    cbd_congestion_fee=0.0,
)


def raw(spark, *changes):
    schema = T.StructType([*TRIP_WIRE.fields, T.StructField("tag", T.StringType())])
    data = [
        tuple({**GOOD, "tag": None, **change}[name] for name in schema.names)
        for change in changes
    ]
    return spark.createDataFrame(data, schema)


def silver_row(spark, *changes):
    names = dict(zip([c.raw for c in TRIP_COLUMNS], SILVER_TRIP_NAMES))
    base = {names[key]: value for key, value in GOOD.items()}
    data = [{**base, "tag": None, **change} for change in changes]
    schema = ", ".join(f"{c.silver} {c.wire.simpleString()}" for c in TRIP_COLUMNS)
    ordered = [
        tuple(
            float(row[c.silver])
            if c.wire.simpleString() == "double" and row[c.silver] is not None
            else row[c.silver]
            for c in TRIP_COLUMNS
        )
        + (row["tag"],)
        for row in data
    ]
    df = spark.createDataFrame(ordered, schema + ", tag string")
    return df.select(*[F.col(c.silver).cast(c.kind).alias(c.silver) for c in TRIP_COLUMNS], "tag")


def zones(spark):
    return spark.createDataFrame(
        [(10, "Midtown", "Manhattan"), (20, "Astoria", "Queens")],
        "LocationID int, Zone string, Borough string",
    )
