"""Validation: parity with a source, by rows or by fingerprints, duplicate keys, stable reruns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable, no_rows

FANOUT = 256
LEVELS = 2


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def parity(mirror: DataFrame, source: DataFrame) -> DataFrame:
    """One row: both counts and the rows found on one side only (as multisets).

    Both sides are counted per distinct row in one grouping, instead of a set difference each way.
    """
    names = mirror.columns
    left = mirror.select(*names, F.lit(1).alias("_m"), F.lit(0).alias("_s"))
    right = source.select(*names, F.lit(0).alias("_m"), F.lit(1).alias("_s"))
    per_row = (
        left.unionByName(right)
        .groupBy(*names)
        .agg(F.sum("_m").alias("m"), F.sum("_s").alias("s"))
    )
    zero = F.lit(0).cast("long")
    return per_row.agg(
        F.coalesce(F.sum("m"), zero).alias("mirror_rows"),
        F.coalesce(F.sum("s"), zero).alias("source_rows"),
        F.coalesce(F.sum(F.greatest(F.col("m") - F.col("s"), zero)), zero).alias("only_mirror"),
        F.coalesce(F.sum(F.greatest(F.col("s") - F.col("m"), zero)), zero).alias("only_source"),
    )


def _row_hashes(names: list[str]) -> list[Column]:
    """Two hashes of a row. Hashes pass over nulls, so where they stand is hashed with the values."""
    marked = [part for name in names for part in (F.col(name), F.col(name).isNull())]
    return [F.xxhash64(F.lit(seed), *marked).cast("decimal(38,0)") for seed in (1, 2)]


def _fingerprints(both: DataFrame, names: list[str], node: Column) -> DataFrame:
    """For each node the rows of both sides and the hash sums of one less those of the other."""
    sign = F.col("_sign")
    first, second = _row_hashes(names)
    return both.groupBy(node.alias("node")).agg(
        F.count(F.when(sign > 0, 1)).alias("mirror_rows"),
        F.count(F.when(sign < 0, 1)).alias("source_rows"),
        F.sum(first * sign).alias("first"),
        F.sum(second * sign).alias("second"),
    )


def _descend(
    mirror: DataFrame, source: DataFrame, keys: list[str], fanout: int, levels: int
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Fingerprints of the first and of the last level, and the rows below the last unequal nodes.

    A node is a hash of the key modulo a power of ``fanout``, so each lies in one node of the level above.
    A level shuffles one row for each node and task. Nodes that are equal as multisets are left
    there: only rows of unequal ones are hashed at the next level, and only rows below unequal
    leaves are compared themselves. At most ``fanout ** levels`` numbers are broadcast.
    """
    names = mirror.columns
    both = mirror.select(*names, F.lit(1).alias("_sign")).unionByName(
        source.select(*names, F.lit(-1).alias("_sign"))
    )
    left = both.withColumn("_place", F.xxhash64(*keys))
    top = None
    for level in range(1, levels + 1):
        node = F.pmod("_place", F.lit(fanout**level))
        sums = durable(_fingerprints(left, names, node), "fingerprints")
        top = top or sums
        same = (F.col("first") == 0) & (F.col("second") == 0)
        unequal = sums.filter(~same | (F.col("mirror_rows") != F.col("source_rows")))
        if unequal.isEmpty():
            return top, unequal, None
        numbers = F.broadcast(unequal.select("node"))
        left = left.join(numbers, node == F.col("node"), "left_semi")
    return top, unequal, left.drop("_place")


def differences(
    mirror: DataFrame,
    source: DataFrame,
    keys: list[str],
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """Rows that one side holds more often than the other: the row, ``side`` and ``n``, how often.

    Found down a tree of multiset fingerprints (two sums of 64-bit hashes and a count for each node),
    so rows of equal parts are read but never shuffled. Nulls are equal to nulls.
    """
    names = mirror.columns
    _, _, left = _descend(mirror, source, keys, fanout, levels)
    if left is None:
        fields = [*mirror.schema.fields, T.StructField("side", T.StringType())]
        return no_rows(
            mirror.sparkSession, T.StructType([*fields, T.StructField("n", T.LongType())])
        )
    more = left.groupBy(*names).agg(F.sum("_sign").alias("_more")).filter("_more != 0")
    return more.select(
        *names,
        F.when(F.col("_more") > 0, "mirror").otherwise("source").alias("side"),
        F.abs("_more").alias("n"),
    )


def fingerprint_parity(
    mirror: DataFrame,
    source: DataFrame,
    keys: list[str],
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """What ``parity`` returns, and the unequal leaves, without shuffling rows of equal parts."""
    names = mirror.columns
    top, unequal, left = _descend(mirror, source, keys, fanout, levels)
    zero = F.lit(0).cast("long")
    counts = top.agg(
        F.coalesce(F.sum("mirror_rows"), zero).alias("mirror_rows"),
        F.coalesce(F.sum("source_rows"), zero).alias("source_rows"),
    ).withColumn("unequal_nodes", unequal.agg(F.count("*")).scalar())
    if left is None:
        return counts.select("*", zero.alias("only_mirror"), zero.alias("only_source"))
    more = left.groupBy(*names).agg(F.sum("_sign").alias("more"))
    found = more.agg(
        F.coalesce(F.sum(F.greatest("more", zero)), zero).alias("only_mirror"),
        F.coalesce(F.sum(F.greatest(-F.col("more"), zero)), zero).alias("only_source"),
    )
    only = durable(found, "differences")
    return counts.withColumns(
        {name: only.select(name).scalar() for name in ("only_mirror", "only_source")}
    )


def content_hash(df: DataFrame) -> DataFrame:
    """One row: row count and an order-free hash of all rows."""
    row_hash = F.xxhash64(*[F.col(name) for name in df.columns]).cast("decimal(38,0)")
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(row_hash), F.lit(0).cast("decimal(38,0)")).alias("content"),
    )


def rerun_stable(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: counts before and after a rerun and whether the content is equal."""
    tagged = content_hash(before).withColumn("run", F.lit(1)).unionByName(
        content_hash(after.select(*before.columns)).withColumn("run", F.lit(2))
    )
    return tagged.agg(
        F.max(F.when(F.col("run") == 1, F.col("row_count"))).alias("count_before"),
        F.max(F.when(F.col("run") == 2, F.col("row_count"))).alias("count_after"),
        (F.min("content") == F.max("content")).alias("same_content"),
    )


def assert_stable(before: DataFrame, after: DataFrame) -> None:
    """Raise when a rerun changed a table."""
    row = rerun_stable(before, after).first()
    if row.count_before != row.count_after or not row.same_content:
        raise AssertionError(f"rerun changed the table: {row.asDict()}")
