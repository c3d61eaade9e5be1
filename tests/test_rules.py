from conftest import rows

from millrace.functions.rules import (
    EXAMPLE_RULES,
    INGEST_RULES,
    SILVER_RULES,
    apply_rules,
    bad_samples,
    quality_report,
)
from millrace.operators import trips
from trip_rows import raw, silver_row


def kept(spark, rules, built):
    return [r.tag for r in apply_rules(built, rules).orderBy("tag").collect()]


def test_ingest_passenger_and_time_bounds(spark):
    df = raw(
        spark,
        dict(tag="p0", passenger_count=0.0),
        dict(tag="p8", passenger_count=8.0),
        dict(tag="p9", passenger_count=9.0),
        dict(tag="pnull", passenger_count=None),
        dict(tag="equal", tpep_dropoff_datetime="2025-01-01 10:00:00"),
        dict(tag="before", tpep_dropoff_datetime="2025-01-01 09:59:59"),
        dict(tag="nodrop", tpep_dropoff_datetime=None),
        dict(tag="badtime", tpep_pickup_datetime="not a time"),
    )
    assert kept(spark, INGEST_RULES, trips.normalise(df)) == ["equal", "p0", "p8"]


def test_ingest_distance_money_and_zones(spark):
    df = raw(
        spark,
        dict(tag="d0", trip_distance=0.0),
        dict(tag="dnull", trip_distance=None),
        dict(tag="dnan", trip_distance=float("nan")),
        dict(tag="nozone", PULocationID=None),
        dict(tag="tip", tip_amount=-0.01),
        dict(tag="tipnull", tip_amount=None),
        dict(tag="farelow", fare_amount=-5.0),
        dict(tag="total", total_amount=-1.0),
        dict(tag="totalnull", total_amount=None),
        dict(tag="total0", total_amount=0.0),
    )
    cleaned = trips.clean(trips.normalise(df))
    assert rows(cleaned, "tag", "tip_amount") == [
        ("farelow", 1.0),
        ("tipnull", 0.0),
        ("total0", 1.0),
    ]


def test_missing_fare_becomes_zero(spark):
    cleaned = trips.clean(trips.normalise(raw(spark, dict(tag="a", fare_amount=None))))
    assert rows(cleaned, "fare_amount") == [(0.0,)]


def test_silver_bounds(spark):
    df = silver_row(
        spark,
        dict(tag="p1", passenger_count=1),
        dict(tag="p6", passenger_count=6),
        dict(tag="p7", passenger_count=7),
        dict(tag="p0", passenger_count=0),
        dict(tag="pnull", passenger_count=None),
        dict(tag="equal", dropoff_datetime="2025-01-01 10:00:00"),
        dict(tag="fare0", fare_amount=0.0),
        dict(tag="total0", total_amount=0.0),
        dict(tag="vendor", vendor_id=None),
    )
    assert kept(spark, SILVER_RULES, df) == ["p1", "p6"]


def test_quality_report_counts_unknown_as_bad(spark):
    df = trips.normalise(
        raw(
            spark,
            dict(tag="a", passenger_count=None),
            dict(tag="b", passenger_count=9.0),
            dict(tag="c", tpep_dropoff_datetime=None),
            dict(tag="d", trip_distance=0.0),
        )
    )
    report = dict(rows(quality_report(df, INGEST_RULES + EXAMPLE_RULES)))
    assert report["passengers_0_to_8"] == 2
    assert report["dropoff_present"] == 1 and report["time_ordered"] == 1
    # the shown examples leave out missing values, except for the distance
    assert report["bad_passengers"] == 1 and report["bad_time"] == 0
    assert report["bad_distance"] == 1


def test_quality_report_without_rows(spark):
    df = trips.normalise(raw(spark, dict(tag="a"))).filter("false")
    assert {n for _, n in rows(quality_report(df, INGEST_RULES))} == {0}


def test_samples_are_the_first_three(spark):
    df = trips.normalise(
        raw(spark, *[dict(tag=f"t{i}", trip_distance=-1.0) for i in range(9)])
    )
    found = bad_samples(df, EXAMPLE_RULES, ["tag"])
    assert rows(found, "rule", "sample_no", "tag") == [
        ("bad_distance", 1, "t0"),
        ("bad_distance", 2, "t1"),
        ("bad_distance", 3, "t2"),
    ]
