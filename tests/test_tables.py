import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.plans import cdc as cdc_plan
from millrace.schemas import CUSTOMERS, GOLD_HOURLY, STRING
from millrace.session import workspace
from millrace.sources.records import next_offsets, read_records, stream_records, write_records
from millrace.sources.tables import VersionedTables, append_partitioned, overwrite_partitions
from millrace.streaming.bronze import bronze_cdc_stream, read_bronze
from millrace.streaming.mirror import read_mirror, run_mirror_stream
from millrace.schemas import BRONZE_CDC
from millrace.operators.cdc import parse_envelope, rebuild_mirror

from cdc_rows import AS_OF, event, image, records, tombstone


@pytest.fixture
def tables(spark):
    return VersionedTables(spark, workspace(spark, "tables"))


def frame(spark, *data):
    return spark.createDataFrame(list(data), "id int, v string")


def test_versions_history_and_rollback(spark, tables):
    assert not tables.exists("a.t")
    tables.ensure_table("a.t", frame(spark, (0, "")).schema)
    tables.ensure_table("a.t", frame(spark, (0, "")).schema)
    tables.append("a.t", frame(spark, (1, "x")))
    tables.append("a.t", frame(spark, (2, "y")))
    tables.replace("a.t", tables.read("a.t").filter("id = 2"))
    assert rows(tables.read("a.t")) == [(2, "y")]
    assert rows(tables.read("a.t", version=3)) == [(1, "x"), (2, "y")]
    assert tables.read("a.t", version=1).count() == 0
    tables.rollback("a.t", 2)
    assert rows(tables.read("a.t")) == [(1, "x")]
    assert rows(tables.history("a.t"), "snapshot_id", "operation") == [
        (1, "create"),
        (2, "append"),
        (3, "append"),
        (4, "replace"),
        (5, "rollback"),
    ]
    with pytest.raises(ValueError):
        tables.read("a.t", version=9)


def test_append_fits_the_schema_and_skips_known_batches(spark, tables):
    tables.ensure_table("a.t", frame(spark, (0, "")).schema)
    tables.append("a.t", spark.createDataFrame([("x", 5)], "v string, id long"), batch=1)
    tables.append("a.t", frame(spark, (6, "z")), batch=1)
    assert rows(tables.read("a.t")) == [(5, "x")]


def test_added_column_is_null_in_old_rows(spark, tables):
    tables.replace("a.t", frame(spark, (1, "x")))
    tables.add_column("a.t", "w", STRING)
    tables.add_column("a.t", "w", STRING)
    tables.append("a.t", frame(spark, (2, "y")).withColumn("w", F.lit("new")))
    assert rows(tables.read("a.t")) == [(1, "x", None), (2, "y", "new")]


def hours(spark, *moments):
    data = [("A", dt.datetime.fromisoformat(m), 1, 1.0, 1.0) for m in moments]
    return spark.createDataFrame(data, GOLD_HOURLY)


def test_day_partitioning_survives_a_replace(spark, tables):
    tables.ensure_table("taxi.h", GOLD_HOURLY, {"hour": "days"})
    tables.replace("taxi.h", hours(spark, "2025-01-01T10:00:00", "2025-01-02T00:00:00"))
    assert tables.read("taxi.h").columns == GOLD_HOURLY.names
    day = tables.read("taxi.h", partitions=True).filter("hour_day = DATE '2025-01-02'")
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour_day" in plan


def test_identity_partitioning_keeps_types_and_nulls(spark, tables):
    df = spark.createDataFrame([("01", 1), (None, 2)], "code string, n int")
    tables.replace("a.t", df, {"code": "identity"})
    assert rows(tables.read("a.t")) == [("01", 1), (None, 2)]


def test_dynamic_overwrite_leaves_other_partitions(spark):
    path = workspace(spark, "parts")
    day = "id int, d string"
    append_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], day), path, "d")
    append_partitioned(spark.createDataFrame([(3, "b")], day), path, "d")
    overwrite_partitions(spark.createDataFrame([(9, "b")], day), path, "d")
    assert rows(spark.read.parquet(path), "id", "d") == [(1, "a"), (9, "b")]


FIRST = [
    event("c", 1, "2024-01-01T00:00:00", 1),
    event("c", 2, "2024-01-02T00:00:00", 2),
    event("d", 2, "2024-01-03T00:00:00", 3),
    tombstone(2, 4),
]
SECOND = [
    event("u", 1, "2024-01-04T00:00:00", 5, image(1, "b@x")),
    event("c", 3, "2024-01-05T00:00:00", 6),
]


def test_pipeline_twice_gives_the_same(spark, tables):
    cdc_plan.run(tables, records(spark, *FIRST), AS_OF)
    cdc_plan.run(tables, records(spark, *FIRST, *SECOND), AS_OF)
    one = rows(tables.read(cdc_plan.ACTIVITY))
    mirror = rows(tables.read("cdc.silver_customers"))
    cdc_plan.run(tables, records(spark, *FIRST, *SECOND), AS_OF)
    assert rows(tables.read(cdc_plan.ACTIVITY)) == one
    assert rows(tables.read("cdc.silver_customers")) == mirror
    assert tables.read(cdc_plan.BRONZE).count() == 5
    cdc_plan.rebuild_mirrors(tables)
    assert rows(tables.read("cdc.silver_customers")) == mirror
    source = tables.read("cdc.silver_customers")
    checked = cdc_plan.validate(tables, "cdc.silver_customers", source).first()
    assert tuple(checked) == (2, 2, 0, 0, 0)


def test_schema_evolution(spark, tables):
    grown = event("u", 1, "2024-01-06T00:00:00", 7, image(1, phone="+372"))
    cdc_plan.append_bronze(tables, records(spark, *FIRST, *SECOND, grown))
    cdc_plan.merge_mirrors(tables)
    wide = cdc_plan.evolve(tables, "cdc.silver_customers", CUSTOMERS, "phone", STRING)
    assert wide.mirror.names[-2:] == ["phone", "last_updated_ms"]
    assert rows(tables.read("cdc.silver_customers"), "id", "phone") == [(1, "+372"), (3, None)]


def test_streams_resume_and_match_the_batch(spark, tables):
    root = workspace(spark, "stream")

    def run():
        bronze_cdc_stream(
            stream_records(spark, f"{root}/in", max_files=1), f"{root}/bronze", f"{root}/b"
        )
        run_mirror_stream(
            spark, f"{root}/bronze", tables, "cdc.state", CUSTOMERS, f"{root}/m", max_files=1
        )

    # the newer events arrive first: the older ones must not bring anything back
    write_records(records(spark, *SECOND, FIRST[2]), f"{root}/in")
    run()
    write_records(records(spark, FIRST[0], FIRST[1], FIRST[3]), f"{root}/in")
    run()
    run()
    bronze = read_bronze(spark, f"{root}/bronze", BRONZE_CDC)
    assert bronze.count() == 5
    expected = rebuild_mirror(parse_envelope(read_records(spark, f"{root}/in")), CUSTOMERS)
    assert rows(read_mirror(tables, "cdc.state", CUSTOMERS)) == rows(expected)
    assert rows(expected, "id") == [(1,), (3,)]


def test_topic_filter_and_next_offsets(spark):
    path = workspace(spark, "records")
    write_records(records(spark, *FIRST, event("c", 9, 1, 50, topic="other")), path)
    assert read_records(spark, path).count() == 5
    assert read_records(spark, path, [CUSTOMERS.topic]).count() == 4
    bronze = parse_envelope(read_records(spark, path))
    offsets = next_offsets(bronze, {CUSTOMERS.topic: 2})
    assert offsets == '{"dbserver1.public.customers": {"0": 4, "1": -2}}'
