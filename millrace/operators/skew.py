"""Previous-value lookups that survive keys holding a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .dedup import keep_first, newest_first


def range_segments(
    df: DataFrame,
    key: str,
    order: list[str],
    partitions: int | None = None,
    place: str | None = None,
) -> DataFrame:
    """Add ``segment`` by an even range split over key and full order, whatever the skew or ties.

    No segment is much larger than another, even where one key or one time holds most rows. The
    bounds come from a sample, so the split rows are written before they are used twice. ``place`` names a
    column for a row's place in its segment, from 0: rows are then sorted where the split has brought them.
    """
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, key, *order)
    if place:
        # A generated id holds the task's number above its lower 33 bits, which count the task's rows.
        at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ranged = ranged.sortWithinPartitions(key, *order).select("*", at.alias(place))
    return durable(ranged.withColumn("segment", F.spark_partition_id().cast("long")), "segments")


def previous_values(
    df: DataFrame,
    key: str,
    order: list[str],
    names: list[str],
    prefix: str = "prev_",
    partitions: int | None = None,
) -> DataFrame:
    """``lag`` of each name within ``key``, a null key being a key like any other.

    Rows are always split by range over key and order, so no key has to fit one task. Within a
    segment a plain window does it. The first row that a segment has of a key takes its values
    from the last row of that key in the segments before; those last rows are one per key and
    segment, and only keys that go over a border have more than one.
    """
    spread = range_segments(df, key, order, partitions)
    window = Window.partitionBy("segment", key).orderBy(*order)
    inside = spread.select(
        "*",
        *[F.lag(name).over(window).alias(prefix + name) for name in names],
        (F.row_number().over(window) == 1).alias("_first"),
    )
    lasts = keep_first(
        spread.select("segment", key, *dict.fromkeys([*order, *names])),
        ["segment", key],
        newest_first(order),
    )
    along = Window.partitionBy(key).orderBy("segment")
    carried = lasts.select(
        F.col("segment").alias("_segment"),
        F.col(key).alias("_key"),
        F.struct(*[F.lag(n).over(along).alias(n) for n in names]).alias("_carry"),
    )
    met = inside.join(
        carried,
        (inside["segment"] == carried["_segment"]) & inside[key].eqNullSafe(carried["_key"]),
        "left",
    )
    fixed = {
        prefix + n: F.when(F.col("_first"), F.col(f"_carry.{n}")).otherwise(F.col(prefix + n))
        for n in names
    }
    return met.select(*df.columns, *[value.alias(name) for name, value in fixed.items()])
