import random

from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.dedup import drop_replays, keep_first, latest_per_key, unseen_records
from millrace.operators.skew import previous_values, range_segments

ORDER = ["ts_ms", "lsn"]


def skewed(spark, n=3000):
    """Two thirds of the rows on one key, most of them at one time; some values missing."""
    pick = random.Random(3)
    data = [
        (
            1 if pick.random() < 0.66 else pick.randrange(2, 40),
            1000 if pick.random() < 0.7 else pick.randrange(900, 1100),
            i,
            pick.choice(["a", "b", None]),
            pick.choice(["x", "y"]),
        )
        for i in range(n)
    ]
    pick.shuffle(data)
    return spark.createDataFrame(data, "k int, ts_ms long, lsn long, email string, country string")


def brute(data):
    last, out = {}, []
    for r in sorted(data, key=lambda r: (r.k, r.ts_ms, r.lsn)):
        out.append((r.lsn, *last.get(r.k, (None, None))))
        last[r.k] = (r.email, r.country)
    return sorted(out, key=repr)


def test_previous_values_equal_brute_force(spark):
    df = skewed(spark)
    expected = brute(df.collect())
    for partitions in (1, 7, 40):
        found = previous_values(df, "k", ORDER, ["email", "country"], partitions=partitions)
        assert rows(found, "lsn", "prev_email", "prev_country") == expected
        assert found.columns == [*df.columns, "prev_email", "prev_country"]


def test_a_null_key_loses_no_row(spark):
    df = skewed(spark).withColumn("k", F.when(F.col("k") > 1, F.col("k")))
    found = previous_values(df, "k", ORDER, ["email"], partitions=9)
    assert found.count() == df.count()
    known = df.withColumn("k", F.coalesce("k", F.lit(-1)))
    expected = [r[:2] for r in brute(known.collect())]
    assert rows(found, "lsn", "prev_email") == sorted(expected, key=repr)


def test_segments_cut_the_hot_key_evenly(spark):
    df = range_segments(skewed(spark), "k", ORDER, partitions=12)
    sizes = df.filter("k = 1").groupBy("segment").count().collect()
    assert len(sizes) >= 6
    assert max(r["count"] for r in sizes) < 600


def test_keep_first_follows_the_order(spark):
    df = skewed(spark)
    best = {}
    for r in df.collect():
        best[r.k] = max(best.get(r.k, (0, 0)), (r.ts_ms, r.lsn))
    assert rows(latest_per_key(df, ["k"], ORDER), "k", "ts_ms", "lsn") == sorted(
        ((k, *v) for k, v in best.items()), key=repr
    )
    first = keep_first(df, ["k"], ["ts_ms", "lsn"])
    assert first.count() == len(best)


def test_replayed_records(spark):
    layout = "topic string, kafka_partition int, kafka_offset long, op string"
    log = spark.createDataFrame([("t", 0, 1, "c"), ("t", 0, 2, "u"), ("t", 1, 1, "c")], layout)
    doubled = log.unionByName(log)
    assert rows(drop_replays(doubled)) == rows(log)
    stored = log.filter("kafka_partition = 0 AND kafka_offset = 1")
    assert rows(unseen_records(doubled, stored)) == [("t", 0, 2, "u"), ("t", 1, 1, "c")]
    assert unseen_records(doubled, log).count() == 0


def test_unseen_records_are_shuffled_and_sorted_once(spark):
    kinds = "topic string, kafka_partition int, kafka_offset long, after string"
    log = spark.createDataFrame([("t", 0, 1, "a"), ("t", None, 2, "b")], kinds)
    read = [("t", 0, 1, "a"), ("t", 0, 2, "c"), ("t", 0, 2, "c"), (None, 0, 3, "d"), (None, 0, 3, "d")]
    found = unseen_records(spark.createDataFrame(read, kinds).hint("merge"), log)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Sort [") == 2
    assert rows(found) == sorted([("t", 0, 2, "c"), (None, 0, 3, "d")], key=repr)
