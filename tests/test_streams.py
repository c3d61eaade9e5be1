"""Silver and hourly streams: duplicates over batches and restarts, late rows, closed hours."""

import datetime as dt
import glob
import json
import os
import shutil

from conftest import rows
from pyspark.sql import functions as F
from trip_rows import GOOD, silver_row, zones

from millrace import fixtures as fx
from millrace.operators import gold
from millrace.schemas import RECORD
from millrace.session import workspace
from millrace.sources.records import read_records, stream_records, write_records
from millrace.operators.trips import record_columns
from millrace.streaming.bronze import bronze_trip_table
from millrace.streaming.silver import write_hourly, write_silver

SMALL = "/root/testdata/sf0.001"


def sent(spark, at, *changes, first=0):
    made = [
        ("1", json.dumps({**GOOD, **change}), "taxi-trips", 0, first + i, at)
        for i, change in enumerate(changes)
    ]
    return spark.createDataFrame(made, RECORD)


class Stream:
    def __init__(self, spark):
        self.spark = spark
        self.root = workspace(spark, "stream")

    def run(self, records):
        write_records(records, f"{self.root}/records")
        bronze = stream_records(self.spark, f"{self.root}/records").select(*record_columns())
        write_silver(bronze, zones(self.spark), f"{self.root}/silver", f"{self.root}/state", "2 hours")
        return [
            (r.fare_amount, r.extra, r.pickup_zone)
            for r in self.spark.read.parquet(f"{self.root}/silver").orderBy("fare_amount", "extra").collect()
        ]


def hour(n):
    return dt.datetime(2025, 1, 1, n)


def test_duplicates_over_batches_and_restarts(spark):
    stream = Stream(spark)
    bad = dict(trip_distance=0.0)
    assert stream.run(sent(spark, hour(1), dict(), dict(fare_amount=13.0), bad)) == [
        (12.0, 0.5, "Midtown"), (13.0, 0.5, "Midtown")
    ]
    # A copy in another run, with another detail, and one twice in its own batch.
    again = sent(spark, hour(2), dict(extra=9.0), dict(fare_amount=14.0), dict(fare_amount=14.0))
    found = stream.run(again)
    assert found == [(12.0, 0.5, "Midtown"), (13.0, 0.5, "Midtown"), (14.0, 0.5, "Midtown")]
    assert stream.run(again.limit(0)) == found


def test_state_ends_with_the_watermark(spark):
    stream = Stream(spark)
    stream.run(sent(spark, hour(1), dict()))
    stream.run(sent(spark, hour(9), dict(fare_amount=15.0)))
    stream.run(sent(spark, hour(9), dict(fare_amount=16.0)))
    # Hours later the trip is a new one; a message from before the watermark is left out.
    found = stream.run(sent(spark, hour(10), dict(extra=9.0)))
    assert [f[:2] for f in found if f[0] == 12.0] == [(12.0, 0.5), (12.0, 9.0)]
    late = stream.run(sent(spark, hour(2), dict(fare_amount=99.0)))
    assert late == found


def test_closed_hours_equal_the_batch(spark):
    root = workspace(spark, "hourly")

    def trips(*times):
        changes = [
            dict(
                pickup_datetime=t,
                dropoff_datetime=(dt.datetime.fromisoformat(t) + dt.timedelta(minutes=5)).isoformat(" "),
                fare_amount=float(10 + i),
            )
            for i, t in enumerate(times)
        ]
        found = silver_row(spark, *changes).drop("tag")
        return found.withColumn("pickup_zone", F.lit("Midtown"))

    def run(rows_in):
        rows_in.write.mode("append").parquet(f"{root}/silver")
        arriving = spark.readStream.schema(rows_in.schema).parquet(f"{root}/silver")
        write_hourly(arriving, f"{root}/hourly", f"{root}/state", "1 hour")
        return rows(spark.read.parquet(f"{root}/hourly"))

    day = "2025-01-01"
    first = run(trips(f"{day} 10:00:00", f"{day} 10:59:59", f"{day} 11:10:00"))
    assert first == []
    second = trips(f"{day} 11:20:00", f"{day} 13:05:00")
    whole = spark.read.parquet(f"{root}/silver").unionByName(second)
    expected = rows(gold.hourly(whole).filter(f"hour < timestamp'{day} 12:00:00'"))
    assert run(second) == expected and [r[2] for r in expected] == [2, 2]
    # The closed hours are not written again, and a late trip does not change them.
    assert run(trips(f"{day} 10:30:00")) == expected


def test_stream_into_a_catalog_table(spark):
    root = workspace(spark, "table")
    table = f"bronze_{root[-12:]}"

    def run(records):
        write_records(records, f"{root}/records")
        bronze_trip_table(
            stream_records(spark, f"{root}/records"), table, f"{root}/bronze", f"{root}/state"
        )
        return rows(spark.table(table))

    first = run(sent(spark, hour(1), dict(), dict(fare_amount=13.0)))
    assert [(json.loads(r[1])["fare_amount"], r[4]) for r in first] == [(12.0, 0), (13.0, 1)]
    none = sent(spark, hour(1), dict()).limit(0)
    assert spark.catalog.tableExists(table) and run(none) == first  # a rerun adds nothing
    grown = run(sent(spark, hour(2), dict(), first=2))
    assert len(grown) == 3 and set(first) < set(grown)
    # A file that no micro-batch has committed is not read.
    spark.table(table).limit(1).write.mode("append").parquet(f"{root}/stray")
    shutil.copy(glob.glob(f"{root}/stray/part-*")[0], f"{root}/bronze/part-stray.snappy.parquet")
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 3
    spark.sql(f"DROP TABLE {table}")


def test_record_files_are_compressed_and_hold_what_was_sent(spark):
    rows_in = sent(spark, hour(1), *[dict(fare_amount=float(n)) for n in range(2000)])
    text = sum(len(r.value) for r in rows_in.collect())
    for kind in ("parquet", "json"):
        path = workspace(spark, kind)
        write_records(rows_in.withColumn("partition", F.col("partition").cast("long")), path, kind)
        stored = sum(os.path.getsize(f) for f in glob.glob(f"{path}/part-*"))
        assert stored < text / 5, kind
        assert rows(read_records(spark, path, kind=kind)) == rows(rows_in)
        assert read_records(spark, path, ["other"], kind).isEmpty()


def test_copies_of_trips_make_up_all_of_them(spark):
    whole = rows(fx.trip_records(spark, SMALL))
    first, second = (rows(fx.trip_records(spark, SMALL, copy=n)) for n in (0, 1))
    assert sorted(first + second, key=repr) == whole
    assert {r[4] % 2 for r in first} == {0} and {r[4] % 2 for r in second} == {1}
