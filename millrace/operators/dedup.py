"""Keep one row per key, with a stated order instead of whichever row comes first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RECORD_ID = ["topic", "kafka_partition", "kafka_offset"]
# Newest change first: the source clock, then the log position, then where it sits in the topic.
NEWEST = ["ts_ms", "lsn", "kafka_offset", "kafka_partition"]


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Written as a rank filter because Spark turns it into a window group limit: each task keeps
    one row per key before the shuffle, so a key with a third of all rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def newest_first(columns: list[str]) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in columns]


def latest_per_key(df: DataFrame, keys: list[str], order: list[str] = NEWEST) -> DataFrame:
    return keep_first(df, keys, newest_first(order))


def drop_replays(log: DataFrame) -> DataFrame:
    """One copy of each record: a record that was read twice has the same topic position."""
    return log.dropDuplicates(RECORD_ID)


def unseen_records(records: DataFrame, bronze: DataFrame) -> DataFrame:
    """Records whose topic position the bronze log does not hold yet, one copy of each.

    The join comes first: its shuffle and sort serve the dedup, and known records do not reach it.
    """
    return drop_replays(records.join(bronze.select(*RECORD_ID), RECORD_ID, "left_anti"))
