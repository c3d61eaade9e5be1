"""What the physical plans must show: one parse, early pruning, no Python, no single-task step."""

import os

import pytest
from trip_rows import raw, zones

from millrace import fixtures as fx
from millrace.operators import cdc, gold, trips
from millrace.plans import queries as registry
from millrace.plans import trips as trip_plan
from millrace.schemas import CUSTOMERS, GOLD_HOURLY
from millrace.session import durable

SMALL = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the generated tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bronze(spark):
    return durable(trips.add_trip_id(raw(spark, dict(), dict(fare_amount=2.0)).drop("tag")))


def test_silver_pushes_filters_and_ranks_before_the_shuffle(spark):
    text = plan(trip_plan.silver_from_bronze(bronze(spark), durable(zones(spark))))
    assert "GreaterThan(trip_distance,0.0)" in text
    assert "IsNotNull(PULocationID)" in text
    assert text.count("WindowGroupLimit") == 2
    assert text.count("BroadcastHashJoin") == 2
    assert text.count("Exchange hashpartitioning") == 1


def test_hourly_reads_only_its_columns(spark):
    silver = durable(trip_plan.silver_from_bronze(bronze(spark), zones(spark)))
    text = plan(gold.hourly(silver))
    schema = text[text.index("ReadSchema") :]
    assert "pickup_zone" in schema and "tolls_amount" not in schema
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_messages_are_parsed_once(spark):
    messages = trips.encode_records(bronze(spark).drop("trip_id")).selectExpr(
        "*", "0 AS partition", "0L AS offset", "timestamp '2024-01-01' AS kafka_timestamp"
    )
    text = plan(trip_plan.silver_from_messages(durable(messages), zones(spark)))
    assert text.count("from_json(") == 1


@needs_data
def test_mirror_filters_the_log_in_the_scan(spark):
    log = durable(cdc.parse_envelope(fx.cdc_records(spark, SMALL)))
    text = plan(cdc.rebuild_mirror(log, CUSTOMERS))
    assert "EqualTo(topic,dbserver1.public.customers)" in text and "IsNotNull(op)" in text
    assert text.count("from_json(") == 2  # one per image
    assert text.count("Exchange hashpartitioning") == 1 and text.count("WindowGroupLimit") == 2


@needs_data
def test_previous_values_never_bring_a_key_to_one_task(spark):
    log = durable(cdc.parse_envelope(fx.cdc_records(spark, SMALL)))
    text = plan(gold.field_changes(gold.customer_events(log)))
    sizes = [x for x in text.splitlines() if "Exchange hashpartitioning(entity_id" in x]
    # Rows are dealt by segment and key; only a key's last row of each segment meets by key alone.
    assert len(sizes) == 1 and "Exchange hashpartitioning(segment" in text


@needs_data
def test_small_changes_leave_the_target_unshuffled(spark):
    log = durable(cdc.parse_envelope(fx.cdc_records(spark, SMALL)))
    latest = durable(cdc.latest_changes(log, CUSTOMERS))
    target = durable(cdc.mirror_rows(latest, CUSTOMERS))
    text = plan(cdc.merge_changes(target, latest))
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


# Queries that write and read tables: their last plan is a plain scan.
STORED = ("pipeline", "table", "partition", "bronze", "mirror", "read_", "rollback", "rerun", "op")
STORED += ("incremental", "positions", "ingest_report", "ingest_manifest", "trips_of", "silver_stream")
STORED += ("hourly_stream",)
STORED += ("manifest", "new_files", "source_tagged", "schema_", "hourly_by", "silver_customers_m")


@needs_data
@pytest.mark.parametrize(
    "name", [n for n in registry.queries() if not n.startswith(STORED)]
)
def test_queries_stay_in_the_engine(spark, name):
    text = plan(registry.queries()[name](spark, SMALL))
    for word in ("Python", "CartesianProduct", "NestedLoop", "MapInPandas"):
        assert word not in text
    if "SinglePartition" in text:  # only sums of partial sums, never rows, meet in one task
        assert "Window [" not in text.split("SinglePartition")[0].splitlines()[-2]


def test_hourly_contract(spark):
    silver = trip_plan.silver_from_bronze(bronze(spark), zones(spark))
    found = gold.hourly(silver).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in GOLD_HOURLY]
