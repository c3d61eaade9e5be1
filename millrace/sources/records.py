"""Message sources and sinks: Kafka where its connector is there, record files where not."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RECORD


def read_records(
    spark: SparkSession, path: str, topics: list[str] | None = None, kind: str = "parquet"
) -> DataFrame:
    """Record files in the Kafka layout, all topics or the given ones; ``kind`` is parquet or json."""
    records = spark.read.schema(RECORD).format(kind).load(path)
    return records.filter(F.col("topic").isin(topics)) if topics else records


def stream_records(
    spark: SparkSession,
    path: str,
    topics: list[str] | None = None,
    max_files: int | None = None,
    kind: str = "parquet",
) -> DataFrame:
    """The same files as a stream, from the earliest on."""
    reader = spark.readStream.schema(RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    records = reader.format(kind).load(path)
    return records.filter(F.col("topic").isin(topics)) if topics else records


def write_records(records: DataFrame, path: str, kind: str = "parquet") -> None:
    """Messages repeat their field names, so they are compressed: by zstd, in json by gzip.

    Times keep their microseconds, which the json writer's own format would cut.
    """
    typed = records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD])
    writer = typed.write.mode("append").format(kind)
    if kind == "json":
        writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    writer.option("compression", "gzip" if kind == "json" else "zstd").save(path)


def read_kafka(
    spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest"
) -> DataFrame:
    return _kafka(spark.read, servers, topics, starting)


def stream_kafka(spark: SparkSession, servers: str, topics: list[str]) -> DataFrame:
    return _kafka(spark.readStream, servers, topics)


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish keyed messages; equal keys go to one partition and keep their order."""
    messages.select("key", "value").write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).option("topic", topic).save()


def next_offsets(bronze: DataFrame, topics: dict[str, int]) -> str:
    """Where the next batch read has to start, so that a topic is not read from earliest again.

    ``topics`` gives the partition count of each topic; a partition without rows starts at its
    earliest offset (-2). One entry per topic partition comes back.
    """
    starts = {topic: {str(n): -2 for n in range(count)} for topic, count in topics.items()}
    seen = bronze.groupBy("topic", "kafka_partition").agg(F.max("kafka_offset").alias("last"))
    for row in seen.filter(F.col("topic").isin(list(topics))).collect():
        starts[row.topic][str(row.kafka_partition)] = row.last + 1
    return json.dumps(starts)


def _kafka(reader, servers: str, topics: list[str], starting: str = "earliest") -> DataFrame:
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .load()
    )
