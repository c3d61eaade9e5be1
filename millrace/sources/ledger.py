"""Which record positions a log holds, as bitmaps of 32,768 offsets each.

An offset is one bit of the block that it falls in, so a replay, a gap and a record that comes late
are told apart exactly, also where tombstones, compaction and transaction marks leave a gap
after almost every record and intervals would be as many as records. A new batch is joined
with the few blocks that it falls in, never with the log. Blocks of one topic partition lie in many
rows, so a busy partition is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import drop_replays

BLOCK_KEY = ["topic", "kafka_partition", "block"]
LEDGER = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("block", T.LongType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def positions(records: DataFrame) -> DataFrame:
    """One row per block that the records fall in, with a bit for each of them."""
    return (
        records.filter(F.col("kafka_offset").isNotNull())
        .select("topic", "kafka_partition", _block().alias("block"), _place().alias("place"))
        .groupBy(*BLOCK_KEY)
        .agg(F.bitmap_construct_agg("place").alias("bits"))
    )


def merged(ledger: DataFrame) -> DataFrame:
    """One row per block, of rows that several batches have added."""
    return ledger.groupBy(*BLOCK_KEY).agg(F.bitmap_or_agg("bits").alias("bits"))


def unseen(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """Records, one copy of each, whose position the ledger does not have.

    Only blocks that the records fall in are looked at. A record without a position is new.
    """
    once = drop_replays(records).withColumn("block", _block())
    mine = once.select(*[F.col(name).alias(f"_{name}") for name in BLOCK_KEY]).distinct()
    meets = [ledger[name].eqNullSafe(mine[f"_{name}"]) for name in BLOCK_KEY]
    known = merged(ledger.join(mine, _all(meets), "left_semi"))
    known = known.select(*[F.col(name).alias(f"_{name}") for name in BLOCK_KEY], "bits")
    meets = [once[name].eqNullSafe(known[f"_{name}"]) for name in BLOCK_KEY]
    return (
        once.join(known, _all(meets), "left")
        .filter(~F.coalesce(_has(F.col("bits"), _place()), F.lit(False)))
        .select(*records.columns)
    )


def held(ledger: DataFrame) -> DataFrame:
    """Records per topic partition, and its last offset, by the bitmaps alone."""
    last = F.expr("transform(sequence(0, length(bits) - 1), i -> hex(substring(bits, i + 1, 1)))")
    at = F.size(last) - F.array_position(F.transform(F.reverse(last), lambda h: h != "00"), True)
    byte = F.conv(F.element_at(last, (at + 1).cast("int")), 16, 10).cast("int")
    place = at * 8 + F.floor(F.log2(byte.cast("double"))).cast("long")
    offset = (F.col("block") - 1) * 32768 + 1 + place
    return (
        merged(ledger)
        .select(
            "topic",
            "kafka_partition",
            F.bitmap_count("bits").alias("n"),
            F.when(F.col("block") > 0, offset).otherwise(0).alias("last"),
        )
        .groupBy("topic", "kafka_partition")
        .agg(F.sum("n").alias("records"), F.max("last").alias("last_offset"))
    )


def _block() -> Column:
    return F.bitmap_bucket_number("kafka_offset")


def _place() -> Column:
    return F.bitmap_bit_position("kafka_offset")


def _has(bits: Column, place: Column) -> Column:
    """Whether the bit is set: the lowest bit of a byte is its first place."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (place % 8).cast("int")) == 1


def _all(conditions: list[Column]) -> Column:
    every = conditions[0]
    for condition in conditions[1:]:
        every = every & condition
    return every
