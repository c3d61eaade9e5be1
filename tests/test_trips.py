import datetime as dt

from conftest import rows
from pyspark.sql import functions as F
from trip_rows import raw, silver_row, zones

from millrace.operators import trips
from millrace.operators.enrich import enrich, union_frames
from millrace.plans import trips as trip_plan
from millrace.schemas import PUBLISHED_TRIP_NAMES, SILVER_TRIP_NAMES, SILVER_TRIPS, TRIP_TYPED

AT = dt.datetime(2025, 2, 1)


def test_normalise_types_names_and_missing_columns(spark):
    df = raw(spark, dict(tag="a", RatecodeID=float("nan"))).drop("cbd_congestion_fee")
    df = df.withColumnRenamed("Airport_fee", "airport_fee")
    out = trips.normalise(df)
    assert [f.dataType for f in out.schema][:20] == [f.dataType for f in TRIP_TYPED]
    assert out.columns == [*TRIP_TYPED.names, "tag"]
    row = out.first()
    assert row.RatecodeID is None and row.cbd_congestion_fee is None and row.Airport_fee == 0.0


def test_json_has_iso_times_and_no_nulls(spark):
    df = trips.normalise(raw(spark, dict(passenger_count=None))).drop("tag")
    message = trips.encode_records(df).first()
    assert message.key == "1"
    assert '"tpep_pickup_datetime":"2025-01-01T10:00:00"' in message.value
    assert "passenger_count" not in message.value


def test_json_fraction_is_kept(spark):
    df = raw(spark, dict(tpep_pickup_datetime="2025-01-01 10:00:00.000123")).drop("tag")
    out = trips.parse_trips(trips.encode_records(trips.normalise(df)), keep=("key",))
    assert out.first().pickup_datetime == dt.datetime(2025, 1, 1, 10, 0, 0, 123)


def test_parse_survives_nan_nulls_and_broken_text(spark):
    values = [
        ('{"VendorID":1,"passenger_count":NaN,"fare_amount":NaN,"trip_distance":2.0}',),
        ('{"VendorID":2,"tpep_pickup_datetime":"yesterday","store_and_fwd_flag":null}',),
        ('{"VendorID":',),
    ]
    bronze = spark.createDataFrame(values, "value string").withColumn(
        "kafka_timestamp", F.lit(AT).cast("timestamp")
    )
    out = trips.parse_trips(bronze)
    assert out.columns == [*SILVER_TRIP_NAMES, "kafka_timestamp"]
    assert rows(out, "vendor_id", "passenger_count", "fare_amount", "pickup_datetime") == [
        (1, None, None, None),
        (2, None, None, None),
        (None, None, None, None),
    ]


def test_funnel_per_file(spark):
    df = raw(
        spark,
        dict(tag="f1"),
        dict(tag="f1"),
        dict(tag="f1", total_amount=99.0),
        dict(tag="f1", trip_distance=0.0),
        dict(tag="f2", VendorID=None),
        dict(tag="f2", VendorID=None),
        dict(tag="f3", passenger_count=9.0),
    ).withColumnRenamed("tag", "source_file")
    assert rows(trips.funnel(trips.normalise(df))) == [
        ("f1", 4, 3, 1),
        ("f2", 2, 2, 1),
        ("f3", 1, 0, 0),
    ]


def test_published_trips(spark):
    df = raw(
        spark,
        dict(tag="a"),
        dict(tag="a", VendorID=2),
        dict(tag="b"),
        dict(tag="b", DOLocationID=99, trip_distance=50.5),
        dict(tag="b", fare_amount=-1.0),
        dict(tag="b", tpep_dropoff_datetime="2025-01-01 12:00:01"),
        dict(tag="b", tpep_dropoff_datetime="2025-01-01 12:00:00"),
    ).withColumnRenamed("tag", "source_file")
    out = trips.publishable(trips.normalise(df), zones(spark), AT)
    assert sorted(out.columns) == sorted([*PUBLISHED_TRIP_NAMES, "is_suspicious"])
    assert out.count() == 6  # the vendor is not part of the second key, the file is
    assert out.filter("is_suspicious").count() == 3
    assert rows(out.filter("DOLocationID = 99"), "PU_Zone", "DO_Zone") == [("Midtown", None)]
    share = trips.suspicious_share(out).first()
    assert (share.total_trips, share.suspicious_trips, share.suspicious_pct) == (6, 3, 50.0)
    assert trips.suspicious_share(out.filter("false")).first().suspicious_pct is None


def test_silver_keeps_the_first_copy(spark):
    df = silver_row(spark, dict(total_amount=2.0), dict(total_amount=1.0)).drop("tag")
    df = df.withColumn("trip_id", F.col("total_amount").cast("long"))
    out = trips.silver(df, zones(spark), ["trip_id"])
    assert rows(out, "trip_id", "pickup_zone", "dropoff_borough") == [(1, "Midtown", "Queens")]


def test_bronze_paths_agree(spark):
    df = raw(spark, dict(), dict(fare_amount=3.0), dict(passenger_count=7.0)).drop("tag")
    from_files = trip_plan.silver_from_bronze(trips.add_trip_id(df), zones(spark))
    assert from_files.columns == SILVER_TRIPS.names
    messages = trips.encode_records(df).select(
        "*",
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(AT).cast("timestamp").alias("kafka_timestamp"),
    )
    from_messages = trip_plan.silver_from_messages(messages, zones(spark))
    assert len(from_messages.columns) == 25
    assert rows(from_files, *SILVER_TRIP_NAMES) == rows(from_messages, *SILVER_TRIP_NAMES)


def test_stable_trip_ids(spark):
    df = raw(spark, dict(), dict(fare_amount=3.0)).drop("tag")
    first = rows(trips.add_trip_id(df), "fare_amount", "trip_id")
    assert first == rows(trips.add_trip_id(df.repartition(3)), "fare_amount", "trip_id")
    made = rows(trips.add_trip_id(df, stable=False), "trip_id")
    assert len(set(made)) == 2


def test_lookup_beyond_the_broadcast_threshold_gives_the_same(spark):
    df = raw(spark, dict(tag="a"), dict(tag="b", PULocationID=77), dict(tag="c", PULocationID=None))
    small = enrich(df, zones(spark), "PULocationID", {"Zone": "z"})
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        large = enrich(df, zones(spark), "PULocationID", {"Zone": "z"})
        assert rows(large, "tag", "z") == rows(small, "tag", "z")
    finally:
        spark.conf.set(threshold, before)
    assert rows(small, "tag", "z") == [("a", "Midtown"), ("b", None), ("c", None)]


def test_union_fills_missing_columns(spark):
    one = spark.createDataFrame([(1,)], "a int")
    two = spark.createDataFrame([("x", 2)], "b string, a int")
    assert rows(union_frames([one, two])) == [(1, None), (2, "x")]
