"""Incremental file ingestion: discover, clean, publish clustered by date, report, record.

The drops are scanned once: rule counts and examples are observed on the rows as they go to the
write, clean and kept rows of each file are counted in what was written, and raw rows are what the
file footers say.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import (
    EXAMPLE_RULES,
    INGEST_RULES,
    marked,
    metric_rows,
    observed,
    rule_metrics,
)
from ..operators.enrich import union_frames
from ..operators.trips import normalise, published, zeroed
from ..schemas import LONG, PUBLISH_KEY, PUBLISHED_TRIPS, RAW_TRIP_NAMES, STRING, T, struct
from ..session import no_rows
from ..sources.files import (
    append_manifest,
    list_files,
    load_manifest,
    new_files,
    raw_counts,
    read_drops,
    visible,
)
from ..sources.tables import path_exists, write_clustered

YEAR = "pickup_year"
CLUSTER = ["pickup_date", "PULocationID", "tpep_pickup_datetime"]
REPORTED = INGEST_RULES + EXAMPLE_RULES
REPORT = struct(batch=LONG, rule=STRING, bad_rows=LONG, example=STRING)
_WRITTEN = T.StructType([*PUBLISHED_TRIPS.fields, T.StructField("copies", LONG)])
_STORED = T.StructType(
    [
        *PUBLISHED_TRIPS.fields,
        T.StructField(YEAR, STRING),
        T.StructField("ingest_batch", LONG),
    ]
)


def _observed(watch: Observation) -> dict:
    try:
        return watch.get
    except Py4JJavaError:  # there are no metrics
        return {}


class TripIngest:
    """Files of an inbox to a trip dataset clustered by date, with a report and a manifest.

    Each run writes one batch folder and records its files last. A run that dies in between leaves
    a folder that readers do not see and that the next run replaces. Below a batch there is a folder
    for each year; dates and zones are found by the statistics of row groups.
    """

    def __init__(self, spark: SparkSession, inbox: str, out: str):
        self.spark = spark
        self.inbox = inbox
        self.trips_path = f"{out}/trips_enriched"
        self.suspicious_path = f"{out}/suspicious_trips"
        self.manifest_path = f"{out}/manifest"
        self.report_path = f"{out}/reports"

    def manifest(self) -> DataFrame:
        return load_manifest(self.spark, self.manifest_path)

    def pending(self) -> DataFrame:
        return new_files(list_files(self.spark, self.inbox), self.manifest())

    def run(self, zones: DataFrame, ingested_at: datetime | None = None) -> int:
        """Ingest all pending files; the number of files taken.

        The listing comes to the driver because a scan is declared by its paths; rows never do.
        """
        at = ingested_at or datetime.now(timezone.utc)
        files = self.pending().collect()
        if not files:
            return 0
        batch = (self.manifest().agg(F.max("batch")).first()[0] or 0) + 1
        paths = [f.path for f in files]
        drops = read_drops(self.spark, paths)
        typed = union_frames([normalise(drop) for drop in drops])
        watch = Observation()
        shown = [name for name in [*RAW_TRIP_NAMES, "source_file"] if name in typed.columns]
        passed = observed(
            typed, watch, REPORTED, EXAMPLE_RULES, shown, passing=INGEST_RULES, keep=PUBLISH_KEY
        )

        self._write(published(zeroed(passed), zones, at, counted=True), self.trips_path, batch)
        folder = f"{self.trips_path}/ingest_batch={batch}"
        written = self.spark.read.schema(_WRITTEN).parquet(folder)
        self._write(written.filter("is_suspicious").drop("copies"), self.suspicious_path, batch)
        counts = self._counts(paths, written)
        found = _observed(watch)
        if found.get("rows") != sum(c.raw_row_count for c in counts):
            # Tasks of the observed stage have run twice, as an executor was lost; or nothing was
            # left to write, and the plan that ran in the end has lost its metrics.
            rows = marked(typed, REPORTED, shown, EXAMPLE_RULES)
            found = rows.agg(*rule_metrics(REPORTED, EXAMPLE_RULES)).first().asDict()
        self._report(metric_rows(found, REPORTED), batch)
        self._record(files, counts, batch, at)
        return len(files)

    def trips(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """Published trips of recorded files, with the suspicious flag, of all dates or from
        ``since`` to ``until``."""
        return self._read(self.trips_path, since, until)

    def suspicious(self, since: date | None = None, until: date | None = None) -> DataFrame:
        return self._read(self.suspicious_path, since, until)

    def report(self) -> DataFrame:
        """Bad rows of each rule for each recorded batch, and an example of the shown faults."""
        if not path_exists(self.spark, self.report_path):
            return no_rows(self.spark, REPORT)
        found = self.spark.read.schema(REPORT).json(self.report_path)
        return found.join(self.manifest().select("batch").distinct(), "batch", "left_semi")

    def _write(self, df: DataFrame, path: str, batch: int) -> None:
        year = {YEAR: F.date_format("pickup_date", "yyyy")}
        write_clustered(df, f"{path}/ingest_batch={batch}", year, CLUSTER)

    def _read(self, path: str, since: date | None, until: date | None) -> DataFrame:
        if not path_exists(self.spark, path):
            return no_rows(self.spark, PUBLISHED_TRIPS)
        stored = self.spark.read.schema(_STORED).parquet(path)
        if since is not None:
            stored = stored.filter(
                (F.col(YEAR) >= f"{since:%Y}") & (F.col("pickup_date") >= F.lit(since))
            )
        if until is not None:
            stored = stored.filter(
                (F.col(YEAR) <= f"{until:%Y}") & (F.col("pickup_date") <= F.lit(until))
            )
        return visible(stored, self.manifest()).select(*PUBLISHED_TRIPS.names)

    def _counts(self, paths: list[str], written: DataFrame) -> list:
        """Raw, clean and kept rows of each file."""
        raw = raw_counts(self.spark, paths)
        kept = written.groupBy("source_file").agg(
            F.sum("copies").alias("clean_row_count"),
            F.count("*").alias("after_dedup_row_count"),
        )
        return raw.join(kept, "source_file", "left").collect()

    def _report(self, rows: list, batch: int) -> None:
        """A batch's own folder, written over where a run before has left one."""
        made = self.spark.createDataFrame([(batch, *row) for row in rows], REPORT).coalesce(1)
        made.write.mode("overwrite").option("ignoreNullFields", "false").json(
            f"{self.report_path}/run={batch}"
        )

    def _record(self, files: list, counts: list, batch: int, at: datetime) -> None:
        facts = self.spark.createDataFrame(
            [(f.filename, f.size_bytes, f.modified_at) for f in files],
            "filename string, size_bytes long, modified_at timestamp",
        )
        named = self.spark.createDataFrame(
            [tuple(c) for c in counts],
            "filename string, raw_row_count long, clean_row_count long, after_dedup_row_count long",
        )
        zero = F.lit(0).cast("long")
        append_manifest(
            facts.join(named, "filename", "left").select(
                "filename",
                "size_bytes",
                "modified_at",
                *[
                    F.coalesce(name, zero).alias(name)
                    for name in ("raw_row_count", "clean_row_count", "after_dedup_row_count")
                ],
                F.lit(at).cast("timestamp").alias("processed_at"),
                F.lit(batch).cast("long").alias("batch"),
            ),
            self.manifest_path,
        )
