"""Lookup joins and unions of differing frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    names: dict[str, str],
    key: str = "LocationID",
) -> DataFrame:
    """Left join of lookup attributes under new names; rows without a match keep nulls.

    Whether the lookup is broadcast is left to the session's threshold and, once its true size is
    known, to AQE: a file's size says little about the size of its rows.
    """
    role = lookup.select(
        F.col(key).alias(on), *[F.col(source).alias(name) for source, name in names.items()]
    )
    joined = df.join(role, on, "left")
    return joined.select(*df.columns, *names.values())


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column that one frame lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
