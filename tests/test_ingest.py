import datetime as dt
import glob

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F
from trip_rows import raw, zones

from millrace.functions.rules import EXAMPLE_RULES, INGEST_RULES, metric_rows, observed
from millrace.operators.trips import clean, normalise, publishable, zeroed
from millrace.plans.ingest import REPORTED, TripIngest
from millrace.schemas import PUBLISH_KEY
from millrace.session import workspace
from millrace.sources.files import last_run, list_files, load_manifest, raw_counts, read_drops

AT = dt.datetime(2025, 2, 1)


class Inbox:
    def __init__(self, spark):
        self.spark = spark
        self.root = workspace(spark, "ingest")
        self.ingest = TripIngest(spark, f"{self.root}/inbox", f"{self.root}/out")

    def drop(self, name, *changes, shape=lambda df: df):
        df = shape(raw(self.spark, *changes).drop("tag"))
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/inbox/{name}")

    def run(self):
        return self.ingest.run(zones(self.spark), AT)

    def fares(self):
        return rows(self.ingest.trips(), "source_file", "fare_amount")


@pytest.fixture
def inbox(spark):
    return Inbox(spark)


def test_only_new_files_are_taken(spark, inbox):
    inbox.drop("b.parquet", dict(fare_amount=2.0))
    inbox.drop("a.parquet", dict(fare_amount=1.0), dict(trip_distance=0.0))
    inbox.drop("taxi_zone_lookup.parquet", dict())
    assert [r.filename for r in inbox.ingest.pending().collect()] == ["a.parquet", "b.parquet"]
    assert inbox.run() == 2
    assert inbox.run() == 0
    inbox.drop("c d+5%.parquet", dict(fare_amount=3.0))
    assert inbox.run() == 1
    assert inbox.fares() == [("a.parquet", 1.0), ("b.parquet", 2.0), ("c d+5%.parquet", 3.0)]
    facts = rows(
        inbox.ingest.manifest(),
        "filename",
        "raw_row_count",
        "clean_row_count",
        "after_dedup_row_count",
        "batch",
    )
    assert facts == [
        ("a.parquet", 2, 1, 1, 1),
        ("b.parquet", 1, 1, 1, 1),
        ("c d+5%.parquet", 1, 1, 1, 2),
    ]
    assert tuple(last_run(inbox.ingest.manifest()).first()) == (AT, 3)


def test_nothing_to_do_gives_empty_frames(spark, inbox):
    inbox.drop("taxi_zone_lookup.parquet", dict())
    assert inbox.run() == 0
    assert inbox.ingest.trips().count() == 0
    assert inbox.ingest.suspicious().count() == 0


def test_second_batch_keeps_rows_of_the_same_date(spark, inbox):
    inbox.drop("a.parquet", dict(fare_amount=1.0), dict(trip_distance=60.0))
    inbox.run()
    inbox.drop("b.parquet", dict(fare_amount=2.0), dict(fare_amount=-2.0))
    inbox.run()
    assert inbox.ingest.trips().count() == 4
    assert rows(inbox.ingest.suspicious(), "source_file", "fare_amount") == [
        ("a.parquet", 12.0),
        ("b.parquet", -2.0),
    ]


def test_changed_file_replaces_its_rows(spark, inbox):
    inbox.drop("a.parquet", dict(fare_amount=1.0), dict(fare_amount=2.0))
    inbox.drop("b.parquet", dict(fare_amount=9.0))
    inbox.run()
    inbox.drop("a.parquet", dict(fare_amount=5.0, store_and_fwd_flag="a longer flag"))
    assert inbox.run() == 1
    assert inbox.fares() == [("a.parquet", 5.0), ("b.parquet", 9.0)]


def test_run_that_died_before_recording_is_repaired(spark, inbox, monkeypatch):
    inbox.drop("a.parquet", dict(fare_amount=1.0))
    inbox.run()
    inbox.drop("b.parquet", dict(fare_amount=2.0))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(TripIngest, "_record", fail)
        with pytest.raises(RuntimeError):
            inbox.run()
    assert inbox.fares() == [("a.parquet", 1.0)]
    inbox.drop("c.parquet", dict(fare_amount=3.0))
    assert inbox.run() == 2
    assert inbox.fares() == [("a.parquet", 1.0), ("b.parquet", 2.0), ("c.parquet", 3.0)]


def test_damaged_manifest_line_means_the_file_is_read_again(spark, inbox):
    inbox.drop("a.parquet", dict(fare_amount=1.0))
    inbox.drop("b.parquet", dict(fare_amount=2.0))
    inbox.run()
    for path in glob.glob(f"{inbox.root}/out/manifest/*.json"):
        lines = open(path).read().splitlines()
        with open(path, "w") as file:
            file.write("\n".join(x if "a.parquet" in x else x[:25] for x in lines) + "\n")
    for crc in glob.glob(f"{inbox.root}/out/manifest/.*.crc"):
        open(crc, "wb").close()
    manifest = f"{inbox.root}/out/manifest"
    try:
        kept = [r.filename for r in load_manifest(spark, manifest).collect()]
    except Exception:
        pytest.skip("the local checksum file system refuses the edited file")
    assert kept == ["a.parquet"]
    assert inbox.run() == 1
    assert inbox.fares() == [("a.parquet", 1.0), ("b.parquet", 2.0)]


def test_empty_file_is_recorded(spark, inbox):
    inbox.drop("a.parquet", dict(), shape=lambda df: df.filter("false"))
    assert inbox.run() == 1
    assert inbox.run() == 0
    assert rows(inbox.ingest.manifest(), "raw_row_count", "clean_row_count") == [(0, 0)]


def test_files_with_other_columns_and_types(spark, inbox):
    inbox.drop("a.parquet", dict(fare_amount=1.0))
    inbox.drop("b.parquet", dict(fare_amount=2.0), shape=lambda d: d.withColumn("new", F.lit(1)))
    inbox.drop(
        "c.parquet",
        dict(fare_amount=3.0),
        shape=lambda d: d.withColumn("passenger_count", F.col("passenger_count").cast("long"))
        .withColumn("VendorID", F.col("VendorID").cast("string"))
        .drop("cbd_congestion_fee"),
    )
    assert inbox.run() == 3
    assert inbox.fares() == [("a.parquet", 1.0), ("b.parquet", 2.0), ("c.parquet", 3.0)]


def test_listing_reads_no_content(spark, inbox):
    inbox.drop("a.parquet", dict())
    plan = list_files(spark, f"{inbox.root}/inbox")._jdf.queryExecution().executedPlan()
    assert "content" not in plan.toString()


def test_report_of_a_run(spark, inbox):
    inbox.drop("a.parquet", dict(trip_distance=0.0), dict(trip_distance=-1.0), dict(fare_amount=1.0))
    inbox.drop("b.parquet", dict(passenger_count=9.0), dict(fare_amount=1.0), dict(fare_amount=1.0))
    inbox.run()
    found = {r.rule: (r.batch, r.bad_rows, r.example) for r in inbox.ingest.report().collect()}
    assert found["distance_positive"][:2] == (1, 2) and found["bad_distance"][:2] == (1, 2)
    assert '"source_file":"a.parquet"' in found["bad_distance"][2]
    assert found["passengers_0_to_8"][:2] == (1, 1) and found["total_not_negative"] == (1, 0, None)
    kept = rows(inbox.ingest.manifest(), "raw_row_count", "clean_row_count", "after_dedup_row_count")
    assert kept == [(3, 1, 1), (3, 2, 1)]
    inbox.drop("c.parquet", dict(trip_distance=0.0))
    inbox.run()
    assert rows(inbox.ingest.report().filter("rule = 'bad_distance'"), "batch", "bad_rows") == [
        (1, 2), (2, 1)
    ]


def test_report_counts_again_when_a_stage_ran_twice(spark, inbox, monkeypatch):
    inbox.drop("a.parquet", dict(trip_distance=0.0), dict(fare_amount=1.0))
    real = Observation.get

    def doubled(self):
        return {k: 2 * v if isinstance(v, int) else v for k, v in real.fget(self).items()}

    monkeypatch.setattr(Observation, "get", property(doubled))
    inbox.run()
    assert rows(inbox.ingest.report().filter("rule = 'bad_distance'"), "bad_rows") == [(1,)]


def test_drops_are_scanned_once(spark, inbox):
    inbox.drop("a.parquet", dict(fare_amount=1.0), dict(fare_amount=2.0))
    [drop] = read_drops(spark, [f"{inbox.root}/inbox/a.parquet"])
    watched = observed(normalise(drop), Observation(), REPORTED, (), ["fare_amount"])
    found = publishable(watched, zones(spark), AT, counted=True)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1 and "CollectMetrics" in text
    # Raw rows of a file are counted without any column.
    raw = drop.groupBy("source_file").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in raw


def test_a_date_reads_few_rows(spark, tmp_path):
    from millrace.sources.tables import write_clustered

    days = spark.range(0, 60_000, 1, 8).select(
        F.expr("date_add(date'2025-01-01', int(id % 60))").alias("day"),
        (F.col("id") % 7).alias("zone"),
        F.col("id").alias("n"),
    )
    path = f"{tmp_path}/clustered"
    month = {"month": F.date_format("day", "yyyy-MM")}
    write_clustered(days.repartition(5), path, month, ["day", "zone", "n"])
    folders = sorted(p.split("=")[1] for p in map(str, glob.glob(f"{path}/month=*")))
    assert folders == ["2025-01", "2025-02", "2025-03"]
    found = spark.read.parquet(path).filter("month = '2025-02' AND day = date'2025-02-10'")
    plan = found._jdf.queryExecution().executedPlan()
    assert found.count() == 1000
    rows_read = plan.collectLeaves().apply(0)
    plan.executeCollect()
    scanned = rows_read.metrics().apply("numOutputRows").value()
    files = rows_read.metrics().apply("numFiles").value()
    assert 1000 <= scanned < 20_000 and files <= 6


def test_dates_of_a_range(spark, inbox):
    times = [f"2025-0{m}-{d:02d} 10:00:00" for m in (1, 2, 3) for d in (1, 15)]
    inbox.drop(
        "a.parquet",
        *[
            dict(
                tpep_pickup_datetime=dt.datetime.fromisoformat(t),
                tpep_dropoff_datetime=dt.datetime.fromisoformat(t) + dt.timedelta(minutes=9),
            )
            for t in times
        ],
    )
    inbox.run()
    since, until = dt.date(2025, 1, 15), dt.date(2025, 2, 15)
    found = rows(inbox.ingest.trips(since, until), "pickup_date")
    assert [r[0] for r in found] == [dt.date(2025, 1, 15), dt.date(2025, 2, 1), dt.date(2025, 2, 15)]
    assert inbox.ingest.trips(until=dt.date(2024, 12, 31)).count() == 0


def test_few_columns_pass_what_observes_and_names_are_made_once_a_part(spark, inbox):
    bad = dict(trip_distance=-1.0)
    inbox.drop("a b+c%.parquet", dict(fare_amount=None), dict(), bad, dict(extra=-1.0))
    inbox.drop("d.parquet", bad)
    paths = [f"{inbox.root}/inbox/{name}" for name in ("a b+c%.parquet", "d.parquet")]
    counts = raw_counts(spark, paths)
    assert rows(counts) == [("a b+c%.parquet", 4), ("d.parquet", 1)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    below = plan[plan.rindex("HashAggregate") :]
    assert "file_path" in below and "regexp_extract" not in below
    [drop] = read_drops(spark, paths)
    typed, watch = normalise(drop), Observation()
    passed = observed(
        typed, watch, REPORTED, EXAMPLE_RULES, ["trip_distance"], INGEST_RULES, PUBLISH_KEY
    )
    assert rows(zeroed(passed)) == rows(clean(typed).select(*PUBLISH_KEY)) and passed.count() == 2
    found = {r[0]: r[1:] for r in metric_rows(watch.get, REPORTED)}
    assert found["bad_distance"] == (2, '{"trip_distance":-1.0}')
    assert found["extra_not_negative"] == (1, None) and found["bad_time"] == (0, None)
