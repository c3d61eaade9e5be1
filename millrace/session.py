"""Session defaults and the durable folder that jobs share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(50 * 1024 * 1024),
    "spark.ui.enabled": "false",
}

_local_root: str | None = None


def build_session(
    name: str = "millrace",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with our defaults; ``conf`` (catalogs, credentials, memory) wins over them.

    Shuffle partitions are left to the cluster unless given: AQE coalesces them downwards, so a
    large value costs little and a small one cannot be repaired.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may go without the setting; it gets a
    temporary folder.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="millrace-")
    return _local_root


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Cut the lineage with a written table, so that a lost executor cannot change the rows."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._durable_path = path
    return found


def discard(*stages: DataFrame) -> None:
    """Delete what ``durable`` has written, once all that follows from it is written itself."""
    for stage in stages:
        path = getattr(stage, "_durable_path", None)
        if path:
            hadoop = stage.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            files = hadoop.getFileSystem(stage.sparkSession._jsc.hadoopConfiguration())
            files.delete(hadoop, True)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that needs no Python worker."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(0).select(*columns)
