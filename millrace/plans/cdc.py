"""Change-log pipelines: bronze log, mirrors, customer gold tables, validation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import latest_changes, parse_envelope, rebuild_mirror
from ..operators.checks import duplicate_keys, fingerprint_parity, parity
from ..operators.dedup import unseen_records
from ..operators.drift import drift, evolved, image_types
from ..operators.enrich import union_frames
from ..operators.gold import (
    customer_activity,
    customer_churn,
    customer_events,
    field_changes,
)
from ..schemas import BRONZE_CDC, CUSTOMER_ACTIVITY, CUSTOMERS, DRIVERS, Entity
from ..session import durable

BRONZE = "cdc.bronze_cdc"
ACTIVITY, CHURN = "cdc.gold_customer_activity", "cdc.gold_customer_churn"
MIRRORS = {"cdc.silver_customers": CUSTOMERS, "cdc.silver_drivers": DRIVERS}


def append_bronze(tables, records: DataFrame) -> None:
    """Append the records that the log does not hold yet; reading a topic twice adds nothing."""
    tables.ensure_namespace("cdc")
    tables.ensure_table(BRONZE, BRONZE_CDC)
    tables.append(BRONZE, unseen_records(parse_envelope(records), tables.read(BRONZE)))


def as_stored(tables, name: str, entity: Entity) -> Entity:
    """The entity with the columns that its mirror has gained."""
    for field in tables.read(name).schema:
        if field.name not in entity.mirror.names:
            entity = entity.with_column(field.name, field.dataType)
    return entity


def merge_mirrors(tables) -> None:
    """Bring every mirror up to the log, with whatever columns it has by now."""
    log = tables.read(BRONZE)
    for name, entity in MIRRORS.items():
        tables.ensure_table(name, entity.mirror)
        tables.merge(name, latest_changes(log, as_stored(tables, name, entity)))


def rebuild_mirrors(tables) -> None:
    """The same tables from the whole log, for stores without a merge."""
    log = tables.read(BRONZE)
    for name, entity in MIRRORS.items():
        tables.replace(name, rebuild_mirror(log, entity))


def publish_activity(tables, as_of: datetime | None = None) -> None:
    log = tables.read(BRONZE)
    flagged = field_changes(customer_events(log))
    tables.ensure_table(ACTIVITY, CUSTOMER_ACTIVITY)
    tables.replace(
        ACTIVITY, customer_activity(flagged, tables.read("cdc.silver_customers"), as_of)
    )


def publish_churn(tables, as_of: datetime | None = None, mode: str = "intended") -> None:
    tables.replace(CHURN, customer_churn(tables.read(ACTIVITY), as_of, mode))


def run(
    tables,
    records: DataFrame,
    as_of: datetime | None = None,
    sources: dict[str, DataFrame] | None = None,
) -> DataFrame | None:
    """Log, mirrors, activity, churn, in this order, then each mirror against its source.

    ``sources`` are rows of the captured tables by the names of their mirrors. What is returned has a row
    for each, as ``validated`` gives it; none without sources.
    """
    append_bronze(tables, records)
    merge_mirrors(tables)
    publish_activity(tables, as_of)
    publish_churn(tables, as_of)
    if not sources:
        return None
    return union_frames(
        [
            validated(name, tables.read(name).select(*source.columns), source)
            for name, source in sources.items()
        ]
    )


def validated(name: str, mirror: DataFrame, source: DataFrame) -> DataFrame:
    """One row: the mirror's name, parity by fingerprints, and keys that the mirror holds twice."""
    doubled = duplicate_keys(mirror, ["id"]).agg(F.count("*").alias("n")).scalar()
    found = fingerprint_parity(mirror, source, ["id"]).withColumn("duplicate_keys", doubled)
    return found.select(F.lit(name).alias("mirror"), "*")


def validate(tables, name: str, source: DataFrame) -> DataFrame:
    """One row: parity with the source and the number of keys the mirror holds twice."""
    mirror = tables.read(name)
    doubled = duplicate_keys(mirror, ["id"]).agg(F.count("*").alias("n")).scalar()
    return parity(mirror, source).withColumn("duplicate_keys", doubled)


def evolve(tables, name: str, entity: Entity, column: str, kind: T.DataType) -> Entity:
    """A source table gained a column: the mirror gains it too, older rows read as null.

    Bronze needs no change, since it keeps the images as JSON. The mirror is then brought up from
    the log, which fills the column wherever an image holds it.
    """
    tables.add_column(name, column, kind)
    wider = as_stored(tables, name, entity)
    tables.merge(name, latest_changes(tables.read(BRONZE), wider))
    return wider


def apply_drift(tables, name: str, entity: Entity, records: DataFrame) -> tuple[Entity, DataFrame]:
    """Append records and let the mirror follow what their images hold; the entity and the drift.

    A mirror without news is merged as ever. One with new columns or wider types is built anew from the
    log, which keeps images as text, so values from before a type was widened stay as they were sent.
    """
    stored = durable(image_types(tables.read(BRONZE)), "types")
    fresh = durable(unseen_records(parse_envelope(records), tables.read(BRONZE)), "fresh")
    found = durable(drift(stored, durable(image_types(fresh), "types")), "drift")
    tables.append(BRONZE, fresh)
    log = tables.read(BRONZE)
    wider = evolved(entity, found)
    if wider == entity:
        tables.merge(name, latest_changes(log, entity))
    else:
        tables.replace(name, rebuild_mirror(log, wider))
    return wider, found
