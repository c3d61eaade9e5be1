"""Named quality rules, and the filters and reports built from one list of them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schemas import MONEY_COLUMNS


@dataclass(frozen=True)
class Rule:
    """A row is good when ``predicate`` is true; an unknown (null) answer counts as bad."""

    name: str
    predicate: str

    @property
    def good(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    @property
    def bad(self) -> Column:
        return ~self.good


# The two rule sets disagree on purpose (passengers, equal times, fares).
INGEST_RULES = (
    Rule("pickup_present", "tpep_pickup_datetime IS NOT NULL"),
    Rule("dropoff_present", "tpep_dropoff_datetime IS NOT NULL"),
    Rule("time_ordered", "tpep_dropoff_datetime >= tpep_pickup_datetime"),
    Rule("distance_positive", "trip_distance > 0"),
    Rule("passengers_0_to_8", "passenger_count BETWEEN 0 AND 8"),
    Rule("pickup_zone_present", "PULocationID IS NOT NULL"),
    Rule("dropoff_zone_present", "DOLocationID IS NOT NULL"),
    *(Rule(f"{name}_not_negative", f"coalesce({name}, 0D) >= 0") for name in MONEY_COLUMNS),
    Rule("total_not_negative", "total_amount >= 0"),
)
SILVER_RULES = (
    Rule("vendor_present", "vendor_id IS NOT NULL"),
    Rule("pickup_present", "pickup_datetime IS NOT NULL"),
    Rule("dropoff_present", "dropoff_datetime IS NOT NULL"),
    Rule("pickup_zone_present", "pu_location_id IS NOT NULL"),
    Rule("dropoff_zone_present", "do_location_id IS NOT NULL"),
    Rule("passengers_1_to_6", "passenger_count BETWEEN 1 AND 6"),
    Rule("distance_positive", "trip_distance > 0"),
    Rule("fare_positive", "fare_amount > 0"),
    Rule("total_positive", "total_amount > 0"),
    Rule("time_ordered", "dropoff_datetime > pickup_datetime"),
)
# The three faults whose rows are shown to the user; unlike the rules above, a missing time or
# passenger count is not one of them.
EXAMPLE_RULES = (
    Rule("bad_distance", "trip_distance > 0"),
    Rule(
        "bad_time",
        "tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL"
        " OR tpep_dropoff_datetime >= tpep_pickup_datetime",
    ),
    Rule("bad_passengers", "passenger_count IS NULL OR passenger_count BETWEEN 0 AND 8"),
)


def all_good(rules: tuple[Rule, ...]) -> Column:
    return reduce(lambda a, b: a & b, (F.expr(rule.predicate) for rule in rules))


def apply_rules(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One conjunction of plain comparisons, so that the parts a scan can use reach the scan."""
    return df.filter(all_good(rules))


def quality_report(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(rule, bad_rows)`` for every rule, counted in one pass over the rows."""
    counts = df.agg(*[F.count_if(rule.bad).alias(rule.name) for rule in rules])
    entries = [
        F.struct(F.lit(rule.name).alias("rule"), F.col(rule.name).alias("bad_rows"))
        for rule in rules
    ]
    return counts.select(F.inline(F.array(*entries)))


def rule_metrics(rules: tuple[Rule, ...], examples: tuple[Rule, ...] = ()) -> list[Column]:
    """Aggregates over ``marked`` rows: how many there are, of each rule the bad ones, and one bad
    row of each of ``examples``, which are copied for every row and so should be few.

    They need no grouping, so ``observe`` can collect them while the rows are on their way elsewhere.
    Which bad row is the example is not fixed; ``bad_samples`` has an order.
    """
    found = [F.count(F.lit(1)).alias("rows")]
    for place, rule in enumerate(rules):
        bad = F.getbit("_bad", F.lit(place)) == 1
        found.append(F.count_if(bad).alias(f"{rule.name}.bad"))
        if rule in examples:
            example = F.first(F.when(bad, F.col("_row")), ignorenulls=True)
            found.append(F.to_json(example).alias(f"{rule.name}.example"))
    return found


def _bits(rules: tuple[Rule, ...], of: tuple[Rule, ...]) -> int:
    return sum(1 << n for n, rule in enumerate(rules) if rule in of)


def marked(
    df: DataFrame,
    rules: tuple[Rule, ...],
    shown: list[str],
    examples: tuple[Rule, ...],
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows with a bit for each rule that they break (63 at most), and what an example shows.

    Only rows that break one of ``examples`` carry the latter: every other would copy all of itself.
    """
    bits = [F.when(r.bad, F.lit(1 << n)).otherwise(F.lit(0)) for n, r in enumerate(rules)]
    broken = reduce(lambda a, b: a.bitwiseOR(b), [b.cast("long") for b in bits])
    found = df.select("*", broken.alias("_bad"))
    bad = F.col("_bad").bitwiseAND(F.lit(_bits(rules, examples))) != 0
    row = F.when(bad, F.struct(*shown)).alias("_row")
    return found.select(*(keep or df.columns), "_bad", row)


def observed(
    df: DataFrame,
    watch: Observation,
    rules: tuple[Rule, ...],
    examples: tuple[Rule, ...],
    shown: list[str],
    passing: tuple[Rule, ...] = (),
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows that break none of ``passing``, with the columns in ``keep``; all of both by default.

    ``watch`` has the ``rule_metrics`` of every row once the rows have been written. No expression is
    fused with what observes, so each column that has to pass it is copied for every row: name few.
    """
    metrics = rule_metrics(rules, examples)
    found = marked(df, rules, shown, examples, keep).observe(watch, *metrics)
    if passing:
        found = found.filter(F.col("_bad").bitwiseAND(F.lit(_bits(rules, passing))) == 0)
    return found.drop("_bad", "_row")


def metric_rows(metrics: dict, rules: tuple[Rule, ...]) -> list[tuple[str, int, str | None]]:
    """``(rule, bad_rows, example)`` out of what ``rule_metrics`` has found."""
    return [(r.name, metrics[f"{r.name}.bad"], metrics.get(f"{r.name}.example")) for r in rules]


def bad_samples(
    df: DataFrame, rules: tuple[Rule, ...], order: list[str], per_rule: int = 3
) -> DataFrame:
    """The first ``per_rule`` offending rows of each rule, from one scan.

    Each task keeps its own first rows per rule before the shuffle (the rank filter becomes a
    window group limit), so a rule that most rows break moves no more than any other.
    """
    names = F.array_compact(F.array(*[F.when(rule.bad, F.lit(rule.name)) for rule in rules]))
    window = Window.partitionBy("rule").orderBy(*order)
    return (
        df.select(F.explode(names).alias("rule"), "*")
        .withColumn("sample_no", F.row_number().over(window))
        .filter(F.col("sample_no") <= per_rule)
    )
