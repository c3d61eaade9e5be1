"""Change logs: envelope parsing, latest state per entity, merges and mirrors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import generated, safe_cast
from ..schemas import Entity
from .dedup import latest_per_key

# Everything is read as text first, so one odd value cannot void the rest of the envelope;
# before and after stay JSON text because their shape differs per table and changes over time.
_ENVELOPE = (
    "payload struct<op: string, ts_ms: string, source: struct<lsn: string>,"
    " before: string, after: string>"
)


def _record_position() -> list[Column]:
    return [
        F.col("topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ]


def without_tombstones(records: DataFrame) -> DataFrame:
    return records.filter(F.col("value").isNotNull())


def parse_envelope(records: DataFrame) -> DataFrame:
    """Change records to the bronze log; tombstones are left out. Each value is parsed once."""
    opened = without_tombstones(records).select(
        *_record_position(),
        generated(F.from_json(F.col("value").cast("string"), _ENVELOPE)),
    )
    return opened.select(
        "topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        F.col("payload.op").alias("op"),
        F.col("payload.ts_ms").try_cast("long").alias("ts_ms"),
        F.col("payload.source.lsn").try_cast("long").alias("lsn"),
        F.col("payload.before").alias("before"),
        F.col("payload.after").alias("after"),
    )


def flatten_envelope(records: DataFrame, names: list[str]) -> DataFrame:
    """The bronze variant with the after image opened into ``after_*`` columns."""
    log = parse_envelope(records)
    text = ", ".join(f"`{name}` string" for name in dict.fromkeys(["id", *names]))
    opened = log.select(
        "topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "op",
        "ts_ms",
        F.from_json("after", text).alias("a"),
        F.from_json("before", "id string").alias("b"),
    )
    return opened.select(
        "topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "op",
        "ts_ms",
        F.col("a.id").try_cast("int").alias("after_id"),
        *[F.col(f"a.{name}").alias(f"after_{name}") for name in names],
        F.col("b.id").try_cast("int").alias("before_id"),
    )


def route(log: DataFrame, entity: Entity) -> DataFrame:
    return log.filter(F.col("topic") == entity.topic)


def open_images(log: DataFrame, after: T.StructType, before: tuple[str, ...] = ()) -> DataFrame:
    """Add ``entity_id`` and the parsed images ``a`` and ``b``; one JSON parse per image."""
    after_text = ", ".join(f"`{name}` string" for name in dict.fromkeys(["id", *after.names]))
    before_text = ", ".join(f"`{name}` string" for name in dict.fromkeys(["id", *before]))
    images = log.select(
        "*",
        generated(
            F.struct(
                F.from_json("after", after_text).alias("a"),
                F.from_json("before", before_text).alias("b"),
            )
        ),
    )
    entity_id = F.coalesce(F.col("a.id"), F.col("b.id")).try_cast("int")
    return images.withColumn("entity_id", entity_id)


def changes(log: DataFrame, entity: Entity) -> DataFrame:
    """One row per event of the entity: its mirror columns, the op and the log position.

    Events without a usable id are no entity's. They go before anything is ranked, or all of them
    would count as one.
    """
    events = known_events(log, entity, entity.columns)
    return events.select(
        F.col("entity_id").alias("id"),
        *[
            safe_cast(F.col(f"a.{f.name}"), f.dataType, T.StringType()).alias(f.name)
            for f in entity.columns
        ],
        F.col("ts_ms").alias("last_updated_ms"),
        "op",
        "ts_ms",
        "lsn",
        "kafka_offset",
        "kafka_partition",
    )


def known_events(log: DataFrame, entity: Entity, columns: T.StructType) -> DataFrame:
    events = open_images(route(log, entity), columns)
    return events.filter(F.col("op").isNotNull() & F.col("entity_id").isNotNull())


def latest_events(log: DataFrame, entity: Entity) -> DataFrame:
    """The newest log row of each entity, deletes included."""
    events = known_events(log, entity, T.StructType())
    return latest_per_key(events.drop("a", "b"), ["entity_id"])


def latest_changes(log: DataFrame, entity: Entity) -> DataFrame:
    """The newest change of each entity; what is shuffled are the parsed columns, not the JSON."""
    return latest_per_key(changes(log, entity), ["id"])


def mirror_rows(state: DataFrame, entity: Entity) -> DataFrame:
    """Current rows of an entity out of its newest changes."""
    return state.filter("op != 'd'").select(*entity.mirror.names)


def rebuild_mirror(log: DataFrame, entity: Entity) -> DataFrame:
    """The mirror from the whole log: what merging every change into an empty table gives."""
    return mirror_rows(latest_changes(log, entity), entity)


def merge_changes(
    target: DataFrame, latest: DataFrame, key: str = "id", guard: bool = True
) -> DataFrame:
    """The target after a merge of one change per key.

    Matched: ``d`` deletes, ``c``/``u``/``r`` update, other ops leave the row. Not matched: all but
    ``d`` insert. With ``guard`` a change older than the row it meets is ignored.

    Only the touched rows are compared. They are no more than the changes, so with a small batch
    both joins on the target are broadcast and the target is never shuffled.
    """
    columns = target.columns
    keys = latest.select(F.col(key).alias("_key"))
    meets = target[key].eqNullSafe(keys["_key"])
    untouched = target.join(keys, meets, "left_anti")
    touched = target.join(keys, meets, "left_semi").select(
        F.lit(True).alias("_matched"), F.struct(*columns).alias("_old")
    )
    s = latest.select(F.struct(*columns).alias("_new"), "op")
    both = s.join(touched, F.col(f"_new.{key}").eqNullSafe(F.col(f"_old.{key}")), "left")

    matched = F.coalesce(F.col("_matched"), F.lit(False))
    current = F.lit(True)
    if guard:
        older = F.col("_new.last_updated_ms") < F.col("_old.last_updated_ms")
        current = ~F.coalesce(older, F.lit(False))
    deletes = current & (F.col("op") == "d")
    updates = current & F.col("op").isin("c", "u", "r")
    kept = both.filter(
        F.when(matched, ~deletes).otherwise(F.col("op") != "d")
    ).select(F.when(matched & ~updates, F.col("_old")).otherwise(F.col("_new")).alias("row"))
    return untouched.unionByName(kept.select("row.*"))


def fold_state(state: DataFrame | None, latest: DataFrame) -> DataFrame:
    """Newest change per key over an earlier state and a batch, deletes kept as rows.

    Taking the newest is the same in any order and any number of times, so late batches, replays
    and older events that arrive after a delete all end in the state of the whole log.
    """
    if state is None:
        return latest_per_key(latest, ["id"])
    merged = state.unionByName(latest, allowMissingColumns=True)
    return latest_per_key(merged, ["id"])


def encode_envelope(events: DataFrame) -> Column:
    """Envelope JSON from columns ``op, ts_ms, lsn, before, after`` (the images as structs)."""
    payload = F.struct(
        F.col("op"),
        F.col("ts_ms"),
        F.struct(F.col("lsn")).alias("source"),
        F.col("before"),
        F.col("after"),
    )
    return F.to_json(F.struct(payload.alias("payload")))
