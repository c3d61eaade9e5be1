"""Numbers for rows that have no key of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import range_segments


def dense_ids(
    df: DataFrame,
    name: str = "trip_id",
    order: list[str] | None = None,
    start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Number rows without gaps in the order of all columns, or of ``order`` first.

    Equal rows are numbered one after another, so the numbered rows are the same however the input
    is split. Rows are split by range over the full order and an occurrence, so no number of equal rows
    has to fit one task; each segment is sorted and numbered where the split has brought it, behind the rows of those before it.
    """
    first = order or []
    full = [*first, *[c for c in df.columns if c not in first], "_occurrence"]
    numbered = df.withColumn("_occurrence", F.monotonically_increasing_id())
    spread = range_segments(numbered, full[0], full[1:], partitions, "_place")
    # One row for each segment.
    sizes = spread.groupBy("segment").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "segment", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    return spread.join(F.broadcast(before), "segment").select(
        *df.columns, (F.col("_before") + F.col("_place") + F.lit(start)).alias(name)
    )
