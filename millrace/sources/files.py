"""File drops: discovery against the manifest, and the manifest itself."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key
from ..schemas import MANIFEST
from ..session import no_rows
from .tables import path_exists

FILE_ID = ["filename", "size_bytes", "modified_at"]
# Fixed value: files whose name holds this are lookups, not trips.
LOOKUP_MARK = "zone_lookup"


def drop_name(path: Column) -> Column:
    """The dropped ``*.parquet`` file a path belongs to; a directory of parts counts as one."""
    return F.regexp_extract(path, r"/([^/]+\.parquet)(?:/|$)", 1)


def scanned_drop(path: Column) -> Column:
    """The same for the path of a scan, which is percent-encoded; a plus sign stands for itself there."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return drop_name(F.when(path.contains("%"), decoded).otherwise(path))


def list_files(spark: SparkSession, inbox: str) -> DataFrame:
    """``filename, path, size_bytes, modified_at`` of each drop, without reading any content."""
    entries = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(inbox)
        .select("path", "length", "modificationTime")
    )
    return (
        entries.withColumn("filename", drop_name(F.col("path")))
        .filter(~F.col("filename").contains(LOOKUP_MARK))
        .groupBy("filename")
        .agg(
            F.min(F.regexp_extract("path", r"^(.*?/[^/]+\.parquet)(?:/.*)?$", 1)).alias("path"),
            F.sum("length").alias("size_bytes"),
            F.max("modificationTime").alias("modified_at"),
        )
    )


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Recorded files; none when there is no manifest yet. Damaged lines are passed over."""
    if not path_exists(spark, path):
        return no_rows(spark, MANIFEST)
    lines = spark.read.schema(MANIFEST).option("mode", "DROPMALFORMED").json(path)
    return lines.filter(F.col("filename").isNotNull())


def append_manifest(rows: DataFrame, path: str) -> None:
    """Record finished files. Call it after their data is written."""
    rows.select(*MANIFEST.names).write.mode("append").option("ignoreNullFields", "false").json(
        path
    )


def last_run(manifest: DataFrame) -> DataFrame:
    """One row: when files were last recorded, and how many the manifest tracks."""
    return manifest.agg(
        F.max("processed_at").alias("last_run"), F.count("*").alias("tracked_files")
    )


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that the manifest does not hold in this size and age, by name."""
    return files.join(manifest.select(*FILE_ID), FILE_ID, "left_anti").orderBy("filename")


def read_drops(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """The rows of all given drops, each tagged with the name of its file.

    One frame reads them all in one scan; columns that some files lack are null there. Only when
    files disagree on a column's type is there a frame for each schema.
    """

    def tagged(some: list[str]) -> DataFrame:
        rows = spark.read.option("mergeSchema", "true").parquet(*some)
        return rows.select("*", scanned_drop(F.col("_metadata.file_path")).alias("source_file"))

    try:
        return [tagged(paths)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_" not in str(error):
            raise
    groups: dict[str, list[str]] = {}
    for path in paths:
        groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    return [tagged(some) for some in groups.values()]


def raw_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``source_file, raw_row_count`` of drops by a scan of no column; the names are made once a part."""
    parts = spark.read.parquet(*paths).groupBy(F.col("_metadata.file_path").alias("part"))
    return (
        parts.agg(F.count("*").alias("rows"))
        .groupBy(scanned_drop(F.col("part")).alias("source_file"))
        .agg(F.sum("rows").alias("raw_row_count"))
    )


def visible(trips: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of finished files only, in the newest recorded form of each file.

    Rows left behind by a run that died before it was recorded, and rows of a file that was
    dropped again in another size, are hidden.
    """
    newest = latest_per_key(manifest, ["filename"], ["batch"]).select(
        F.col("filename").alias("source_file"), F.col("batch").alias("ingest_batch")
    )
    return trips.join(newest, ["source_file", "ingest_batch"], "left_semi")
