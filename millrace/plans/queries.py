"""Every operator and pipeline as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as fx
from ..functions.rules import EXAMPLE_RULES, INGEST_RULES, bad_samples, quality_report
from ..operators import cdc, checks, gold, trips
from ..operators.dedup import drop_replays
from ..operators.enrich import enrich, union_frames
from ..schemas import (
    BRONZE_CDC,
    CUSTOMERS,
    DRIVERS,
    GOLD_HOURLY,
    GOLD_PAYMENT,
    RAW_TRIP_NAMES,
    STRING,
)
from ..session import durable, no_rows, workspace
from ..sources.buckets import BucketedState
from ..sources.files import append_manifest, list_files, load_manifest, new_files, read_drops
from ..sources.ledger import held
from ..sources.records import read_records, stream_records, write_records
from ..sources.tables import VersionedTables, append_partitioned, overwrite_partitions
from ..streaming.bronze import bronze_cdc_stream, bronze_trip_table, read_bronze
from ..streaming.mirror import read_mirror, run_mirror_stream
from ..streaming.silver import write_hourly, write_silver
from . import cdc as cdc_plan
from . import trips as trip_plan
from .incremental import IncrementalCdc, state_schema
from .ingest import TripIngest

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name; times leave it without a zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = build(spark, sf_dir)
        return out.select(
            *[
                F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f.name)
                for f in out.schema
            ]
        )

    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _tables(spark: SparkSession) -> VersionedTables:
    return VersionedTables(spark, workspace(spark, "tables"))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.normalise(fx.trips_raw(spark, sf_dir))


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.publishable(_typed(spark, sf_dir), fx.zones(spark, sf_dir), fx.AS_OF)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_plan.silver_from_bronze(
        fx.bronze_trips(spark, sf_dir), fx.zones(spark, sf_dir)
    )


def _mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.payment_mix(_silver(spark, sf_dir))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hourly(_silver(spark, sf_dir))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.parse_envelope(fx.cdc_records(spark, sf_dir))


def _flagged(log: DataFrame) -> DataFrame:
    return gold.field_changes(gold.customer_events(log))


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return gold.customer_activity(_flagged(log), cdc.rebuild_mirror(log, CUSTOMERS), fx.AS_OF)


def _half(spark: SparkSession, sf_dir: str):
    """The event in the middle, as a scalar subquery."""
    events = fx.table(spark, sf_dir, "events")
    return events.agg(F.floor(F.max("event_id") / 2)).scalar()


def _halves(spark: SparkSession, sf_dir: str, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    half = _half(spark, sf_dir)
    return log.filter(F.col("lsn") <= half), log.filter(F.col("lsn") > half)


def _write_drops(trips_df: DataFrame, inbox: str) -> None:
    """Trip files as they would arrive; the second one has a column more than the first."""
    for name in ("file_a.parquet", "file_b.parquet"):
        rows = trips_df.filter(F.col("source_file") == name).drop("source_file")
        if name == "file_b.parquet":
            rows = rows.withColumn("note", F.col("store_and_fwd_flag"))
        rows.write.parquet(f"{inbox}/{name}")


# Trips: typing, cleaning, reports


@query
def trips_normalised(spark, sf_dir):
    return trips.derive(_typed(spark, sf_dir))


@query
def json_roundtrip(spark, sf_dir):
    raw = fx.trips_raw(spark, sf_dir).drop("source_file")
    return trips.parse_trips(trips.encode_records(raw, keep=("rec_id",)), keep=("rec_id",))


@query
def ingest_clean(spark, sf_dir):
    return trips.clean(_typed(spark, sf_dir))


@query
def quality_report_(spark, sf_dir):
    return quality_report(_typed(spark, sf_dir), INGEST_RULES + EXAMPLE_RULES)


@query
def bad_samples_(spark, sf_dir):
    samples = bad_samples(_typed(spark, sf_dir), EXAMPLE_RULES, ["rec_id"])
    return samples.select("rule", "sample_no", "rec_id")


@query
def ingest_funnel(spark, sf_dir):
    return trips.funnel(_typed(spark, sf_dir))


@query
def ingest_dedup_output(spark, sf_dir):
    return _published(spark, sf_dir).drop("is_suspicious")


@query
def suspicious_trips(spark, sf_dir):
    return _published(spark, sf_dir).filter("is_suspicious")


@query
def suspicious_share(spark, sf_dir):
    return trips.suspicious_share(_published(spark, sf_dir))


@query
def enriched_trips(spark, sf_dir):
    raw = fx.trips_raw(spark, sf_dir).select("rec_id", "PULocationID", "DOLocationID")
    lookup = fx.zones(spark, sf_dir)
    picked = enrich(raw, lookup, "PULocationID", {"Zone": "PU_Zone"})
    return enrich(picked, lookup, "DOLocationID", {"Zone": "DO_Zone"})


# Trips: silver and gold


@query
def silver_trips(spark, sf_dir):
    return _silver(spark, sf_dir)


@query
def gold_hourly_trips(spark, sf_dir):
    return _hourly(spark, sf_dir)


@query
def gold_hourly_events(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("pickup_zone"),
        F.col("ts").alias("pickup_datetime"),
        F.col("value").alias("fare_amount"),
        F.get_json_object("props", "$.k").try_cast("double").alias("trip_distance"),
    )
    return gold.hourly(events)


@query
def gold_payment_mix(spark, sf_dir):
    return _mix(spark, sf_dir)


@query
def top_payment_type(spark, sf_dir):
    return gold.most_common_payment(_mix(spark, sf_dir))


@query
def hourly_first10(spark, sf_dir):
    return _hourly(spark, sf_dir).orderBy("hour", "pickup_zone").limit(10)


@query
def hourly_last5(spark, sf_dir):
    return _hourly(spark, sf_dir).orderBy(F.desc("hour"), "pickup_zone").limit(5)


# Files and tables


@query
def source_tagged(spark, sf_dir):
    inbox = workspace(spark, "inbox")
    _write_drops(fx.trips_raw(spark, sf_dir), inbox)
    drops = read_drops(spark, [f"{inbox}/file_a.parquet", f"{inbox}/file_b.parquet"])
    return union_frames(drops).select(
        "rec_id", "source_file", "total_amount", "note", F.lit(fx.AS_OF).alias("ingested_at")
    )


@query
def union_by_name(spark, sf_dir):
    raw = fx.trips_raw(spark, sf_dir).select(
        "rec_id", "source_file", "total_amount", "store_and_fwd_flag"
    )
    first = raw.filter("source_file = 'file_a.parquet'").drop("store_and_fwd_flag")
    second = raw.filter("source_file = 'file_b.parquet'").withColumnRenamed(
        "store_and_fwd_flag", "note"
    )
    return union_frames([first, second]).withColumn("ingested_at", F.lit(fx.AS_OF))


@query
def new_files_(spark, sf_dir):
    root = workspace(spark, "new-files")
    inbox, manifest = f"{root}/inbox", f"{root}/manifest"
    _write_drops(fx.trips_raw(spark, sf_dir), inbox)
    files = list_files(spark, inbox)
    done = files.filter("filename = 'file_a.parquet'").select(
        "filename",
        "size_bytes",
        "modified_at",
        *[F.lit(None).cast("long").alias(n) for n in _COUNTS],
        F.lit(fx.AS_OF).cast("timestamp").alias("processed_at"),
        F.lit(1).cast("long").alias("batch"),
    )
    append_manifest(done, manifest)
    pending = new_files(files, load_manifest(spark, manifest)).select("filename")
    tagged = spark.read.parquet(f"{inbox}/*.parquet").select(
        F.regexp_extract("_metadata.file_path", r"/([^/]+\.parquet)/", 1).alias("filename")
    )
    rows = tagged.groupBy("filename").agg(F.count("*").alias("raw_rows"))
    return pending.join(rows, "filename")


_COUNTS = ["raw_row_count", "clean_row_count", "after_dedup_row_count"]


@query
def manifest_commit(spark, sf_dir):
    return _ingested(spark, sf_dir, runs=1).manifest().select(
        "filename", *_COUNTS, "batch", "processed_at"
    )


@query
def table_roundtrip(spark, sf_dir):
    tables = _tables(spark)
    tables.ensure_namespace("taxi")
    tables.ensure_table("taxi.hourly", GOLD_HOURLY)
    rows = durable(_hourly(spark, sf_dir), "hourly")
    tables.append("taxi.hourly", rows.filter("hour(hour) < 12"))
    tables.append("taxi.hourly", rows.filter("hour(hour) >= 12"))
    tables.replace("taxi.copy", tables.read("taxi.hourly"))
    return tables.read("taxi.copy")


@query
def table_history(spark, sf_dir):
    tables = _tables(spark)
    tables.ensure_table("taxi.gold", GOLD_HOURLY)
    tables.append("taxi.gold", _hourly(spark, sf_dir))
    tables.replace("taxi.gold", _mix(spark, sf_dir))
    counts = [
        tables.read("taxi.gold", version=n).agg(
            F.lit(n).alias("snapshot_id"), F.count("*").alias("row_count")
        )
        for n in (1, 2, 3)
    ]
    history = tables.history("taxi.gold").select("snapshot_id", "operation")
    return history.join(union_frames(counts), "snapshot_id")


@query
def partitioned_readback(spark, sf_dir):
    path = workspace(spark, "by-date")
    append_partitioned(_published(spark, sf_dir).drop("is_suspicious"), path, "pickup_date")
    return spark.read.parquet(path)


@query
def partitioned_publish(spark, sf_dir):
    """Dates of one source, then the dates of the other with their full content written over."""
    path = workspace(spark, "by-date")
    rows = durable(_published(spark, sf_dir), "published")
    append_partitioned(rows.filter("source_file = 'file_a.parquet'"), path, "pickup_date")
    dates = rows.filter("source_file = 'file_b.parquet'").select("pickup_date").distinct()
    overwrite_partitions(rows.join(dates, "pickup_date", "left_semi"), path, "pickup_date")
    return spark.read.parquet(path).drop("source_file")


@query
def hourly_by_day(spark, sf_dir):
    tables = _tables(spark)
    tables.replace("taxi.hourly", _hourly(spark, sf_dir), {"hour": "days"})
    return (
        tables.read("taxi.hourly", partitions=True)
        .groupBy("hour_day")
        .agg(F.count("*").alias("zone_hours"), F.sum("trip_count").alias("trips"))
    )


@query
def bronze_trips_append(spark, sf_dir):
    """Files appended twice under one batch number are in the table once, with dense ids."""
    tables = _tables(spark)
    raw = fx.trips_raw(spark, sf_dir).select(*RAW_TRIP_NAMES)
    as_text = [
        trips.iso_time(F.col(n)).alias(n) if n.endswith("datetime") else n for n in RAW_TRIP_NAMES
    ]
    for _ in range(2):
        trip_plan.files_to_bronze(tables, raw.select(*as_text), batch=1, dense=True)
    stored = tables.read(trip_plan.BRONZE)
    return trips.normalise(stored)


@query
def pipeline_taxi_files(spark, sf_dir):
    """Files, stored bronze with ids, silver and hourly, each read from the table before."""
    tables = _tables(spark)
    raw = fx.trips_raw(spark, sf_dir).select(*RAW_TRIP_NAMES)
    as_text = [
        trips.iso_time(F.col(n)).alias(n) if n.endswith("datetime") else n for n in RAW_TRIP_NAMES
    ]
    trip_plan.files_to_bronze(tables, raw.select(*as_text), batch=1)
    silver = trip_plan.silver_from_bronze(tables.read(trip_plan.BRONZE), fx.zones(spark, sf_dir))
    trip_plan.publish_silver(tables, silver)
    trip_plan.publish_hourly(tables)
    return tables.read(trip_plan.HOURLY).select(*GOLD_HOURLY.names)


# Change log


@query
def cdc_bronze(spark, sf_dir):
    return _log(spark, sf_dir)


@query
def cdc_flattened(spark, sf_dir):
    records = fx.cdc_records(spark, sf_dir).filter(F.col("topic") == CUSTOMERS.topic)
    return cdc.flatten_envelope(records, CUSTOMERS.columns.names)


@query
def cdc_op_counts(spark, sf_dir):
    return gold.op_counts(_log(spark, sf_dir), CUSTOMERS)


@query
def cdc_latest(spark, sf_dir):
    return cdc.latest_events(_log(spark, sf_dir), CUSTOMERS)


@query
def cdc_replayed(spark, sf_dir):
    """A log in which every delete was read twice, without the second readings."""
    log = _log(spark, sf_dir)
    return drop_replays(log.unionByName(log.filter("op = 'd'")))


@query
def silver_customers(spark, sf_dir):
    return cdc.rebuild_mirror(_log(spark, sf_dir), CUSTOMERS)


@query
def silver_customers_merged(spark, sf_dir):
    """The first half of the log merged into an empty mirror, then the second half."""
    mirror = no_rows(spark, CUSTOMERS.mirror)
    for part in _halves(spark, sf_dir, _log(spark, sf_dir)):
        latest = durable(cdc.latest_changes(part, CUSTOMERS), "changes")
        mirror = durable(cdc.merge_changes(mirror, latest), "mirror")
    return mirror


@query
def silver_customers_folded(spark, sf_dir):
    """The newer half of the log folded in before the older one."""
    state = None
    for part in reversed(_halves(spark, sf_dir, _log(spark, sf_dir))):
        state = cdc.fold_state(state, cdc.latest_changes(part, CUSTOMERS))
    return cdc.mirror_rows(state, CUSTOMERS)


@query
def silver_drivers(spark, sf_dir):
    return cdc.rebuild_mirror(_log(spark, sf_dir), DRIVERS)


@query
def silver_preview(spark, sf_dir):
    return cdc.rebuild_mirror(_log(spark, sf_dir), CUSTOMERS).orderBy("id").limit(5)


@query
def customer_by_id(spark, sf_dir):
    return cdc.rebuild_mirror(_log(spark, sf_dir), CUSTOMERS).filter("id = 1")


@query
def cdc_batch_view(spark, sf_dir):
    """The newest changes as a view, the form in which SQL merges take them."""
    cdc.latest_changes(_log(spark, sf_dir), CUSTOMERS).createOrReplaceTempView("cdc_batch")
    return spark.sql(
        "SELECT op, count(*) AS n, max(last_updated_ms) AS newest_ms FROM cdc_batch GROUP BY op"
    )


@query
def customer_events(spark, sf_dir):
    return gold.customer_events(_log(spark, sf_dir)).drop("before_email", "before_country")


@query
def customer_field_changes(spark, sf_dir):
    return _flagged(_log(spark, sf_dir)).select(
        "entity_id",
        "kafka_offset",
        "email",
        "country",
        "prev_email",
        "prev_country",
        "email_changed",
        "country_changed",
    )


@query
def customer_activity(spark, sf_dir):
    return _activity(spark, sf_dir)


@query
def activity_listing(spark, sf_dir):
    return gold.activity_listing(_activity(spark, sf_dir))


@query
def customer_churn(spark, sf_dir):
    return gold.customer_churn(_activity(spark, sf_dir), fx.AS_OF)


@query
def customer_churn_reference(spark, sf_dir):
    return gold.customer_churn(_activity(spark, sf_dir), fx.AS_OF, mode="reference")


@query
def churn_listing(spark, sf_dir):
    return gold.churn_listing(gold.customer_churn(_activity(spark, sf_dir), fx.AS_OF))


@query
def status_rollup(spark, sf_dir):
    return gold.status_rollup(_activity(spark, sf_dir))


@query
def deleted_duration(spark, sf_dir):
    return gold.deleted_duration(_activity(spark, sf_dir))


@query
def top_changed_customers(spark, sf_dir):
    return gold.top_changed(_activity(spark, sf_dir))


@query
def entity_timeline(spark, sf_dir):
    return gold.entity_timeline(_log(spark, sf_dir), 1)


@query
def latest_records(spark, sf_dir):
    return gold.latest_records(_log(spark, sf_dir))


@query
def duplicate_keys(spark, sf_dir):
    return checks.duplicate_keys(gold.customer_events(_log(spark, sf_dir)), ["entity_id"])


# Pipelines and streams


def _ingested(spark: SparkSession, sf_dir: str, runs: int) -> TripIngest:
    """Both trip files, taken in one run or in two; the second has the dates of the first again."""
    root = workspace(spark, "ingest")
    ingest = TripIngest(spark, f"{root}/inbox", f"{root}/out")
    raw, lookup = fx.trips_raw(spark, sf_dir), fx.zones(spark, sf_dir)
    for name in ("file_a.parquet", "file_b.parquet"):
        rows = raw.filter(F.col("source_file") == name).select(*RAW_TRIP_NAMES)
        rows.write.parquet(f"{root}/inbox/{name}")
        if runs == 2 or name == "file_b.parquet":
            ingest.run(lookup, fx.AS_OF)
    return ingest


@query
def pipeline_ingest(spark, sf_dir):
    return _ingested(spark, sf_dir, runs=2).trips()


@query
def ingest_report(spark, sf_dir):
    """Bad rows of each rule over both runs, as observed while the trips were written."""
    found = _ingested(spark, sf_dir, runs=2).report()
    return found.groupBy("rule").agg(F.sum("bad_rows").alias("bad_rows"))


@query
def ingest_manifest(spark, sf_dir):
    """Raw, clean and kept rows of each file, as recorded by the runs."""
    names = ("raw_row_count", "clean_row_count", "after_dedup_row_count")
    return _ingested(spark, sf_dir, runs=2).manifest().select(
        F.col("filename").alias("source_file"), *names
    )


@query
def trips_of_a_week(spark, sf_dir):
    """Published trips of seven days, by the clustered layout."""
    ingest = _ingested(spark, sf_dir, runs=1)
    return ingest.trips(fx.WEEK, fx.WEEK + timedelta(days=6))


@query
def pipeline_suspicious(spark, sf_dir):
    return _ingested(spark, sf_dir, runs=1).suspicious()


def _streamed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages streamed to bronze in two runs of one checkpoint."""
    root = workspace(spark, "trip-stream")
    for run in (0, 1):
        write_records(fx.trip_records(spark, sf_dir, copy=run), f"{root}/records")
        trip_plan.stream_to_bronze(
            stream_records(spark, f"{root}/records", ["taxi-trips"]),
            f"{root}/bronze",
            f"{root}/checkpoint",
        )
    return spark.read.parquet(f"{root}/bronze")


@query
def bronze_stream_availablenow(spark, sf_dir):
    return _streamed_bronze(spark, sf_dir).drop("value")


@query
def bronze_stream_table(spark, sf_dir):
    """Messages streamed into a catalog table in two runs, and in a third that finds none; opened."""
    root = workspace(spark, "table-stream")
    table = f"bronze_trips_{root[-12:]}"
    for run in (0, 1, None):
        if run is not None:
            write_records(fx.trip_records(spark, sf_dir, copy=run), f"{root}/records")
        messages = stream_records(spark, f"{root}/records", ["taxi-trips"])
        bronze_trip_table(messages, table, f"{root}/bronze", f"{root}/checkpoint")
    position = ("key", "topic", "partition", "offset", "kafka_timestamp")
    return trips.parse_trips(spark.table(table), keep=position)


@query
def silver_stream(spark, sf_dir):
    """Messages streamed to silver in two runs of one checkpoint; the second brings the copies."""
    root = workspace(spark, "silver-stream")
    lookup = fx.zones(spark, sf_dir)
    for run in (0, 1):
        write_records(fx.trip_records(spark, sf_dir, copy=run), f"{root}/records")
        messages = stream_records(spark, f"{root}/records", ["taxi-trips"])
        bronze = messages.select(*trips.record_columns())
        write_silver(bronze, lookup, f"{root}/silver", f"{root}/state")
    return spark.read.parquet(f"{root}/silver").drop("kafka_timestamp")


@query
def hourly_stream(spark, sf_dir):
    """Closed hours of silver trips that come in two runs, in the order of their dates."""
    root = workspace(spark, "hourly-stream")
    silver = durable(_silver(spark, sf_dir), "silver")
    for run in (True, False):
        part = silver.filter((F.col("pickup_datetime") < F.lit(fx.WEEK)) == run)
        part.write.mode("append").parquet(f"{root}/silver")
        arriving = spark.readStream.schema(silver.schema).parquet(f"{root}/silver")
        write_hourly(arriving, f"{root}/hourly", f"{root}/state")
    return spark.read.parquet(f"{root}/hourly")


def _trip_gold(spark: SparkSession, sf_dir: str) -> VersionedTables:
    tables = _tables(spark)
    bronze = _streamed_bronze(spark, sf_dir)
    lookup = fx.zones(spark, sf_dir)
    trip_plan.publish_silver(tables, trip_plan.silver_from_messages(bronze, lookup))
    return tables


@query
def pipeline_trips(spark, sf_dir):
    tables = _trip_gold(spark, sf_dir)
    trip_plan.publish_hourly(tables)
    return tables.read(trip_plan.HOURLY).select(*GOLD_HOURLY.names)


@query
def pipeline_payment(spark, sf_dir):
    tables = _trip_gold(spark, sf_dir)
    trip_plan.publish_payment_mix(tables)
    return tables.read(trip_plan.PAYMENT).select(*GOLD_PAYMENT.names)


def _recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "records")
    write_records(fx.cdc_records(spark, sf_dir), path)
    return read_records(spark, path, [CUSTOMERS.topic, DRIVERS.topic])


@query
def pipeline_cdc(spark, sf_dir):
    tables = _tables(spark)
    cdc_plan.run(tables, _recorded(spark, sf_dir), fx.AS_OF)
    return tables.read(cdc_plan.ACTIVITY)


@query
def pipeline_churn(spark, sf_dir):
    tables = _tables(spark)
    cdc_plan.run(tables, _recorded(spark, sf_dir), fx.AS_OF)
    return tables.read(cdc_plan.CHURN)


@query
def rerun_stable(spark, sf_dir):
    tables = _tables(spark)
    records = _recorded(spark, sf_dir)
    cdc_plan.run(tables, records, fx.AS_OF)
    first = tables.read(cdc_plan.ACTIVITY)
    cdc_plan.run(tables, records, fx.AS_OF)
    return checks.rerun_stable(first, tables.read(cdc_plan.ACTIVITY))


def _source_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the captured table, taken from the events without any JSON."""
    user, event = F.col("user_id"), F.col("event_id")
    clock = F.struct(
        F.unix_date(F.to_date("ts")).alias("day"), event.alias("event"), F.col("event_type")
    )
    last = (
        fx.table(spark, sf_dir, "events")
        .filter((user % 5 != 0) & (event % 97 != 0) & (event % 89 != 0))
        .groupBy("user_id")
        .agg(F.max(clock).alias("last"))
        .filter(~((F.col("last.event_type") == "error") & (user % 3 == 0)))
    )
    steady = user % 7 == 3
    number = F.col("last.event")
    return last.select(
        user.cast("int").alias("id"),
        F.concat(F.lit("n"), user).alias("name"),
        F.concat(
            F.lit("e"), user, F.lit("_"), F.when(steady, 0).otherwise(number % 3), F.lit("@x")
        ).alias("email"),
        F.concat(F.lit("C"), F.when(steady, 0).otherwise(number % 4)).alias("country"),
        ((F.col("last.day") - F.floor(user / 3) % 4 * 4) * fx.DAY_MS).alias("last_updated_ms"),
    )


@query
def mirror_parity(spark, sf_dir):
    """The merged mirror against the source rows."""
    tables = _tables(spark)
    cdc_plan.append_bronze(tables, _recorded(spark, sf_dir))
    cdc_plan.merge_mirrors(tables)
    source = _source_customers(spark, sf_dir)
    return cdc_plan.validate(tables, "cdc.silver_customers", source)


@query
def pipeline_cdc_validated(spark, sf_dir):
    """The whole run with validation as its last step, by fingerprints."""
    source = {"cdc.silver_customers": _source_customers(spark, sf_dir)}
    return cdc_plan.run(_tables(spark), _recorded(spark, sf_dir), fx.AS_OF, source)


@query
def mirror_differences(spark, sf_dir):
    """A source that has lost some rows and changed others: the rows that differ, on either side."""
    mirror = cdc.rebuild_mirror(_log(spark, sf_dir), CUSTOMERS)
    part = F.col("id") % 50
    country = F.when(part == 11, "XX").otherwise(F.col("country"))
    source = _source_customers(spark, sf_dir).filter(part != 7).withColumn("country", country)
    return checks.differences(durable(mirror, "mirror"), durable(source, "source"), ["id"])



@query
def mirror_stream(spark, sf_dir):
    """Bronze streamed and folded in two runs, several micro-batches each."""
    root = workspace(spark, "mirror-stream")
    state = BucketedState(spark, f"{root}/state", state_schema(spark, CUSTOMERS), "id", 8)
    records = fx.cdc_records(spark, sf_dir)
    for run in (0, 1):
        write_records(
            records.filter(F.floor(F.col("offset") / 2) % 2 == run).repartition(6), f"{root}/records"
        )
        bronze_cdc_stream(
            stream_records(spark, f"{root}/records"), f"{root}/bronze", f"{root}/bronze-state"
        )
        run_mirror_stream(
            spark,
            f"{root}/bronze",
            state,
            CUSTOMERS,
            f"{root}/mirror-state",
            max_files=2,
        )
    assert read_bronze(spark, f"{root}/bronze", BRONZE_CDC).schema == BRONZE_CDC
    return read_mirror(state, CUSTOMERS)


def _incremental(spark: SparkSession, sf_dir: str) -> IncrementalCdc:
    """The log in three batches: most of the older half, some that came late with most of the newer
    half, then all records again with those that were missing."""
    job = IncrementalCdc(spark, workspace(spark, "incremental"), buckets=8)
    records = _recorded(spark, sf_dir)
    half = _half(spark, sf_dir)
    event = F.floor(F.col("offset") / 2)
    older, late = event <= half, event % 10 == 0
    job.run(records.filter(older & ~late))
    job.run(records.filter(older & (event % 20 == 0) | ~older & ~late))
    job.run(records)
    return job


@query
def incremental_log(spark, sf_dir):
    return _incremental(spark, sf_dir).log()


@query
def incremental_mirror(spark, sf_dir):
    return _incremental(spark, sf_dir).mirror("customers")


@query
def incremental_activity(spark, sf_dir):
    return _incremental(spark, sf_dir).activity(fx.AS_OF)


@query
def incremental_churn(spark, sf_dir):
    return _incremental(spark, sf_dir).churn(fx.AS_OF)


@query
def positions_held(spark, sf_dir):
    """Records and last offset of each topic partition, by the ledger's bitmaps alone."""
    return held(_incremental(spark, sf_dir).ledger())


def _merged_halves(spark: SparkSession, sf_dir: str) -> VersionedTables:
    """Version 1 is empty, 2 holds the first half of the log, 3 all of it."""
    tables = _tables(spark)
    tables.ensure_table("cdc.mirror", CUSTOMERS.mirror)
    for part in _halves(spark, sf_dir, _log(spark, sf_dir)):
        tables.merge("cdc.mirror", cdc.latest_changes(part, CUSTOMERS))
    return tables


@query
def read_version(spark, sf_dir):
    return _merged_halves(spark, sf_dir).read("cdc.mirror", version=2)


@query
def rollback_version(spark, sf_dir):
    tables = _merged_halves(spark, sf_dir)
    tables.rollback("cdc.mirror", 2)
    return tables.read("cdc.mirror")


@query
def schema_evolution(spark, sf_dir):
    """In the second half of the log the source table has gained a column.

    The mirror gains it between two runs, and the run after that goes on with it.
    """
    tables = _tables(spark)
    half = _half(spark, sf_dir)
    records = fx.cdc_records(spark, sf_dir, phone_from=half + 1)
    cdc_plan.append_bronze(tables, records.filter(F.col("offset") < 2 * half + 2))
    cdc_plan.merge_mirrors(tables)
    cdc_plan.evolve(tables, "cdc.silver_customers", CUSTOMERS, "phone", STRING)
    cdc_plan.append_bronze(tables, records)
    cdc_plan.merge_mirrors(tables)
    return tables.read("cdc.silver_customers")


def _drifting(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customer records of both halves: in the second one column is new, one has fractions, one text."""
    half = _half(spark, sf_dir)
    event = F.floor(F.col("offset") / 2)
    newer = event > half
    text = [
        F.expr("left(image, length(image) - 1)"),
        F.lit(',"visits":'),
        F.concat((event % 10).cast("string"), F.when(newer, ".5").otherwise("")),
        F.lit(',"tier":'),
        F.when(newer, '"gold"').otherwise((event % 3).cast("string")),
        F.when(newer, F.concat(F.lit(',"phone":"+'), event.cast("string"), F.lit('"'))).otherwise(""),
        F.lit("}"),
    ]
    payload = "payload struct<op: string, ts_ms: string, source: struct<lsn: string>, before: string, after: string>"
    opened = (
        fx.cdc_records(spark, sf_dir)
        .filter((F.col("topic") == CUSTOMERS.topic) & F.col("value").isNotNull())
        .select("*", F.from_json("value", payload).alias("envelope"))
        .withColumn("image", F.col("envelope.payload.after"))
        .withColumn("wider", F.when(F.col("image").isNotNull(), F.concat(*text)))
    )
    sent = F.col("envelope.payload").withField("after", F.col("wider"))
    found = opened.select(
        "key",
        F.to_json(F.struct(sent.alias("payload"))).alias("value"),
        *["topic", "partition", "offset", "timestamp"],
    )
    found = durable(found, "drifting")
    return found.filter(event <= half), found.filter(newer)


def _drifted(spark: SparkSession, sf_dir: str) -> tuple[VersionedTables, DataFrame]:
    tables = _tables(spark)
    entity = CUSTOMERS.with_column("visits", T.LongType()).with_column("tier", T.LongType())
    older, newer = _drifting(spark, sf_dir)
    cdc_plan.append_bronze(tables, older)
    tables.replace("cdc.wide_customers", cdc.rebuild_mirror(tables.read(cdc_plan.BRONZE), entity))
    _, found = cdc_plan.apply_drift(tables, "cdc.wide_customers", entity, newer)
    return tables, found


@query
def schema_drift(spark, sf_dir):
    """What the second half of the log does to the columns of the first."""
    return _drifted(spark, sf_dir)[1]


@query
def schema_drift_mirror(spark, sf_dir):
    """The mirror that has followed: a new column, one with fractions, one that became text."""
    return _drifted(spark, sf_dir)[0].read("cdc.wide_customers")


for _name in [n for n in _QUERIES if n.endswith("_")]:
    _QUERIES[_name.rstrip("_")] = _QUERIES.pop(_name)
