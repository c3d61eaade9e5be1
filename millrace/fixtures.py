"""Trips, zones and change records as projections of the given star-schema and event tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators.cdc import encode_envelope
from .operators.trips import encode_records
from .schemas import CUSTOMERS, DRIVERS, RAW_TRIP_NAMES, RECORD

AS_OF = datetime(2024, 1, 31)
WEEK = date(1995, 3, 6)
DAY_MS = 86_400_000
FIRST_JOINED = datetime(2023, 6, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup: every nation with its region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("LocationID"),
            F.col("n_name").alias("Zone"),
            F.col("r_name").alias("Borough"),
        )
    )


#: An order has a few lines at every scale; this many places are kept for them.
LINES = 1 << 20
_LINE_ORDER = (
    "l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_shipdate"
    " l_returnflag"
).split()


def _record_number(line: Column, replay: Column) -> Column:
    """A number per line and copy: the order's key, the line's place in it, the copy.

    Lines are placed within their order, on the key that joins them to it anyway, so no number over all
    rows is needed and keys may be of any size.
    """
    return (F.col("l_orderkey") * LINES + line) * 2 + replay


def trips_raw(spark: SparkSession, sf_dir: str, copy: int | None = None) -> DataFrame:
    """Trips from order lines; the lines of every fifth order come a second time.

    One part in 200 each has one of the faults that the rules are about (``fault``). ``copy`` picks the
    first copies (0) or the second ones (1), so that a query which takes them in turn makes each once.

    Customers are joined to orders, not to lines, so lines are shuffled by order only, whatever the sizes.
    """
    of_order = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "o_orderpriority", "c_nationkey")
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .withColumn("line", F.row_number().over(of_order))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    fault = F.col("l_partkey") % 200
    minutes = F.when(fault == 23, -30).otherwise(F.datediff("l_shipdate", "o_orderdate") % 180)
    repeated = F.col("l_orderkey") % 5 == 0
    if copy is None:
        both = F.array(F.lit(0), F.lit(1))
        replay = F.explode(F.when(repeated, both).otherwise(F.array(F.lit(0))))
    else:
        replay = F.lit(copy)
        lines = lines.filter(repeated) if copy else lines
    begun = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (F.col("l_partkey") % 24).cast("int"), (F.col("l_suppkey") % 60).cast("int")
    )
    base = lines.withColumn("begun", begun).withColumn("replay", replay)
    zero = F.lit(0.0)
    fare = (
        F.when(F.col("l_quantity") == 49, -F.col("l_extendedprice"))
        .when(F.col("l_quantity") == 48, F.lit(None))
        .otherwise(F.col("l_extendedprice"))
    )
    payment = F.when(fault.isin(19, 20), F.lit(6)).when(
        ~fault.isin(21, 22), F.substring("o_orderpriority", 1, 1).cast("int")
    )
    passengers = F.when(fault == 5, F.lit(9.0)).when(
        F.col("l_quantity") != 50, F.col("l_linenumber").cast("double")
    )

    def missing(number: int, column: Column) -> Column:
        return F.when(fault != number, column)

    def negative(number: int, column: Column) -> Column:
        return F.when(fault == number, F.lit(-1.0)).otherwise(column)

    def zone(number: int, name: str) -> Column:
        """A nation; for some parts one that no lookup has."""
        return missing(number, F.col(name) + F.when(fault.isin(15, 16, 17), 1000).otherwise(0))

    return base.select(
        missing(18, F.col("l_suppkey").cast("int")).alias("VendorID"),
        missing(1, F.col("begun")).alias("tpep_pickup_datetime"),
        missing(2, F.col("begun") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)).alias(
            "tpep_dropoff_datetime"
        ),
        passengers.alias("passenger_count"),
        (F.col("l_quantity") * 2 - 4).alias("trip_distance"),
        F.col("l_linenumber").cast("double").alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        zone(3, "c_nationkey").cast("int").alias("PULocationID"),
        zone(4, "s_nationkey").cast("int").alias("DOLocationID"),
        payment.alias("payment_type"),
        fare.alias("fare_amount"),
        negative(
            6, F.when(F.col("l_linenumber") != 3, F.col("l_discount") + 0.0)
        ).alias("extra"),
        negative(7, F.col("l_tax") + 0.0).alias("mta_tax"),
        negative(8, zero).alias("tip_amount"),
        negative(9, zero).alias("tolls_amount"),
        negative(10, zero).alias("improvement_surcharge"),
        negative(14, F.col("l_extendedprice") + F.col("replay")).alias("total_amount"),
        negative(11, zero).alias("congestion_surcharge"),
        negative(12, zero).alias("Airport_fee"),
        negative(13, zero).alias("cbd_congestion_fee"),
        F.when(F.col("l_orderkey") % 2 == 0, "file_a.parquet")
        .otherwise("file_b.parquet")
        .alias("source_file"),
        _record_number(F.col("line"), F.col("replay")).alias("rec_id"),
    )


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_raw(spark, sf_dir).select(*RAW_TRIP_NAMES, F.col("rec_id").alias("trip_id"))


def trip_records(spark: SparkSession, sf_dir: str, copy: int | None = None) -> DataFrame:
    """Trips as JSON messages; second copies were sent an hour later, at odd offsets."""
    trips = trips_raw(spark, sf_dir, copy).select(*RAW_TRIP_NAMES, "rec_id")
    sent = F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(
        F.lit(0), (F.col("rec_id") % 2).cast("int")
    )
    return encode_records(trips, keep=("rec_id",)).select(
        "key",
        "value",
        F.lit("taxi-trips").alias("topic"),
        F.coalesce(F.col("key").try_cast("int") % 3, F.lit(0)).alias("partition"),
        F.col("rec_id").alias("offset"),
        sent.cast("timestamp").alias("timestamp"),
    )


def cdc_records(spark: SparkSession, sf_dir: str, phone_from: Column | None = None) -> DataFrame:
    """Change records from events, each delete followed by its tombstone.

    Days are cut off the source clock, so that log positions must break ties, and every third
    user's clock is shifted, so that some have been idle for longer. Updates and deletes carry the
    image before, too. Some events have no op, some images no id, and some customers never change.
    From event ``phone_from`` on the images carry one more column.
    """
    event, user = F.col("event_id"), F.col("user_id")
    customer = user % 5 != 0
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "value",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(event % 97 == 0, F.lit(None))
        .when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "view", "r")
        .when((F.col("event_type") == "error") & (user % 3 == 0), "d")
        .otherwise("u")
        .alias("op"),
        (
            F.unix_date(F.to_date("ts")).cast("long") * DAY_MS
            - F.floor(user / 3) % 4 * 4 * DAY_MS
        ).alias("ts_ms"),
        event.alias("lsn"),
    )
    born = F.unix_micros(F.lit(FIRST_JOINED)) + user * DAY_MS * 1000

    def text(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    def contact(number: Column) -> dict[str, Column]:
        steady = user % 7 == 3
        return {
            "email": text("e", user, "_", F.when(steady, 0).otherwise(number % 3), "@x"),
            "country": text("C", F.when(steady, 0).otherwise(number % 4)),
        }

    of_customer = contact(event)
    of_driver = {
        "license_number": text("TLC-", event),
        "rating": F.when(event % 50 == 0, "bad").otherwise(F.col("value").cast("string")),
        "city": text("City", event % 5),
        "active": F.when(event % 50 == 5, "zz").otherwise((event % 2 == 0).cast("string")),
    }
    known = F.when(event % 89 != 0, user.cast("int")).alias("id")
    fields = [known, text("n", user).alias("name")]
    fields += [F.when(customer, value).alias(name) for name, value in of_customer.items()]
    fields += [F.when(~customer, value).alias(name) for name, value in of_driver.items()]
    if phone_from is not None:
        fields.append(F.when(event >= phone_from, text("+", event)).alias("phone"))
    fields.append(born.alias("created_at"))

    deleted = F.coalesce(F.col("op") == "d", F.lit(False))
    earlier = [F.when(customer, v).alias(n) for n, v in contact(event + 1).items()]
    images = events.select(
        "*",
        F.when(F.col("op").isin("u", "d"), F.struct(known, *earlier)).alias("before"),
        F.when(~deleted, F.struct(*fields)).alias("after"),
    )
    both = F.when(deleted, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    sent = images.select("*", encode_envelope(images).alias("json")).select(
        "*", F.explode(both).alias("tombstone")
    )
    return sent.select(
        user.cast("string").alias("key"),
        F.when(~F.col("tombstone"), F.col("json")).alias("value"),
        F.when(customer, CUSTOMERS.topic).otherwise(DRIVERS.topic).alias("topic"),
        (event % 3).cast("int").alias("partition"),
        (event * 2 + F.col("tombstone").cast("long")).alias("offset"),
        "timestamp",
    ).select(*RECORD.names)
