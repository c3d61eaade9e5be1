"""Column expressions shared by the operators. All of them stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Payment codes and their labels; every other code, null included, is OTHER_PAYMENT.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
}
OTHER_PAYMENT = "Voided trip"


def safe_cast(column: Column, kind: T.DataType, source: T.DataType | None = None) -> Column:
    """Cast untrusted input: what does not fit becomes null, and so does NaN."""
    if isinstance(source, (T.DoubleType, T.FloatType)):
        column = F.nanvl(column, F.lit(None).cast(source))
    if source == kind:
        return column
    cast = column.try_cast(kind)
    if source is None and isinstance(kind, T.DoubleType):
        cast = F.nanvl(cast, F.lit(None).cast(kind))
    return cast


def generated(*structs: Column) -> Column:
    """The fields of structs that are costly to compute, such as parsed JSON, as own columns.

    A filter on a field of a plain parsed struct is pushed below the projection, and each pushed
    predicate parses the text again; generated columns are computed once and filtered afterwards.
    """
    return F.inline(F.array(*structs))


def trip_minutes(pickup: str, dropoff: str) -> Column:
    return (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)) / 60.0


def iso_time(column: Column) -> Column:
    """ISO-8601 text; the fraction is written only where there is one."""
    return F.when(
        F.date_trunc("second", column) == column, F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def payment_label(code: Column) -> Column:
    pairs = list(PAYMENT_LABELS.items())
    label = F.when(code == pairs[0][0], pairs[0][1])
    for value, text in pairs[1:]:
        label = label.when(code == value, text)
    return label.otherwise(OTHER_PAYMENT)


def rounded_mean(name: str) -> Column:
    """Mean to two decimals, half away from zero, from sums in decimals.

    Sums of decimals do not depend on the order in which tasks finish, so a value that lies on a
    rounding tie gives the same result on every run. Values keep six decimals; one that is beyond
    26 digits before the point counts as missing.
    """
    exact = F.col(name).try_cast("decimal(32,6)")
    return F.round(F.sum(exact).cast("decimal(32,6)") / F.count(exact), 2).cast("double")


def rounded_share(part: Column, whole: Column) -> Column:
    """Share in percent to two decimals, half up, by whole numbers."""
    return F.round((part * 100).cast("decimal(22,0)") / whole, 2).cast("double")


def changed(current: Column, previous: Column) -> Column:
    """1 when both values are known and differ."""
    return F.coalesce(current != previous, F.lit(False)).cast("int")


def suspicious(minutes: Column, distance: Column, fare: Column) -> Column:
    """Longer than two hours, farther than fifty miles, or refunded."""
    hit = (minutes > 120) | (distance > 50) | (fare < 0)
    return F.coalesce(hit, F.lit(False))
