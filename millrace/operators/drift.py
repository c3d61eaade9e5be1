"""Schema drift: which columns the images of a change log hold, of which type, and what became of it.

Types are joined in a lattice: ``VOID`` (only nulls) below all, ``BIGINT`` below ``DECIMAL`` below
``DOUBLE``, every other type beside those, and ``VARIANT`` above all that clash. Joining is the same in
any order, so the types of a batch fold into stored ones without a look at older images.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DOUBLE, LONG, STRING, Entity, struct

TYPES = struct(topic=STRING, column=STRING, kind=STRING, images=LONG)

# Numeric kinds from narrow to wide, and what a mirror stores a kind as. Images are
# opened as text, so text is what holds nested values and clashes.
NUMERIC = ["BIGINT", "DECIMAL", "FLOAT", "DOUBLE"]
STORED_AS = {
    "BIGINT": LONG,
    "DECIMAL": DOUBLE,
    "FLOAT": DOUBLE,
    "DOUBLE": DOUBLE,
    "BOOLEAN": T.BooleanType(),
}


def image_types(log: DataFrame) -> DataFrame:
    """One row per topic and column of the ``after`` images: the join of its types, and how many hold it.

    Images are parsed as variants; what is no JSON object has no columns. Types are joined in the
    tasks first, so one row for each column and task is shuffled, whatever the share of one topic.
    """
    images = log.select("topic", F.try_parse_json("after").alias("image"))
    opened = images.lateralJoin(
        log.sparkSession.tvf.variant_explode(F.col("image").outer())
    ).filter(F.col("key").isNotNull())
    return opened.groupBy("topic", F.col("key").alias("column")).agg(
        F.regexp_extract(F.schema_of_variant_agg("value"), "^[A-Z_]+", 0).alias("kind"),
        F.count("*").alias("images"),
    )


def joined(a: Column, b: Column) -> Column:
    """The least kind above both; null is no kind."""
    order = F.array(*[F.lit(kind) for kind in NUMERIC])
    at, bt = F.array_position(order, a), F.array_position(order, b)
    return (
        F.when(a.isNull() | (a == "VOID"), F.coalesce(b, a))
        .when(b.isNull() | (b == "VOID") | (a == b), a)
        .when((at > 0) & (bt > 0), F.when(at > bt, a).otherwise(b))
        .otherwise("VARIANT")
    )


def _beside(stored: DataFrame, batch: DataFrame) -> DataFrame:
    old = stored.select("topic", "column", F.col("kind").alias("before"), F.col("images").alias("_old"))
    new = batch.select("topic", "column", F.col("kind").alias("_kind"), F.col("images").alias("_new"))
    return old.join(new, ["topic", "column"], "full").withColumn(
        "now", joined(F.col("before"), F.col("_kind"))
    )


def fold_types(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored types with those of a batch joined in."""
    zero = F.lit(0).cast("long")
    images = F.coalesce("_old", zero) + F.coalesce("_new", zero)
    return _beside(stored, batch).select(
        "topic", "column", F.col("now").alias("kind"), images.alias("images")
    )


def drift(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """What a batch does to each column: ``before``, ``now``, ``status`` and its images that hold it.

    ``came`` was not known, ``absent`` is not in the batch, ``widened`` needs a wider type (or has its
    first value), ``clashed`` has types that only text can hold, ``same`` is all else.
    """
    status = (
        F.when(F.col("_kind").isNull(), "absent")
        .when((F.col("now") == "VARIANT") & ~F.col("before").eqNullSafe("VARIANT"), "clashed")
        .when(F.col("before").isNull(), "came")
        .when(F.col("before") != F.col("now"), "widened")
        .otherwise("same")
    )
    images = F.coalesce("_new", F.lit(0).cast("long"))
    return _beside(stored, batch).select(
        "topic", "column", "before", "now", status.alias("status"), images.alias("images")
    )


def evolved(entity: Entity, found: DataFrame) -> Entity:
    """The entity with new columns, and with wider types of those it mirrors. Reads one row per column.

    A column of only nulls has no type yet and does not come. One that the mirror holds as text
    stays text, and a declared type is never narrowed.
    """
    news = found.filter(F.col("topic") == entity.topic).filter(
        F.col("status").isin("came", "widened", "clashed") & (F.col("now") != "VOID")
    )
    fields = {f.name: f.dataType for f in entity.columns}
    for row in sorted(news.collect(), key=lambda r: r.column):
        kind = STORED_AS.get(row.now, STRING)
        if row.column in entity.mirror.names:
            widens = kind == STRING or (kind == DOUBLE and fields.get(row.column) == LONG)
            if row.column in fields and widens:
                fields[row.column] = kind
        elif row.before is None:
            fields[row.column] = kind
    return Entity(entity.topic, struct(**fields))
