import random

from conftest import rows

from millrace.operators.ids import dense_ids


def test_dense_ids_do_not_depend_on_the_split(spark):
    pick = random.Random(4)
    # A third of the rows are equal, and nulls are values like any other.
    data = [("hot", 1, None)] * 300
    data += [(pick.choice(["a", "b", None]), pick.randrange(9), pick.random()) for _ in range(600)]
    pick.shuffle(data)
    df = spark.createDataFrame(data, "k string, n int, x double")
    order = sorted(data, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
    expected = sorted(((*r, i) for i, r in enumerate(order, 1)), key=repr)
    for given, partitions in ((1, 1), (3, 8), (17, 40)):
        assert rows(dense_ids(df.repartition(given), partitions=partitions)) == expected


def test_dense_ids_start_behind_others_and_take_empty_tables(spark):
    df = spark.createDataFrame([(2, "b"), (1, "c"), (1, "a")], "n int, k string")
    assert rows(dense_ids(df, "id", ["k"], start=11)) == [(1, "a", 11), (1, "c", 13), (2, "b", 12)]
    assert dense_ids(df.limit(0)).count() == 0


def test_equal_rows_are_spread_over_segments(spark, monkeypatch):
    from millrace.operators import ids

    kept = []
    split = ids.range_segments
    monkeypatch.setattr(ids, "range_segments", lambda *a: kept.append(split(*a)) or kept[-1])
    dense_ids(spark.range(4000).selectExpr("1 AS n"), partitions=8).count()
    sizes = [r["count"] for r in kept[0].groupBy("segment").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


def test_rows_are_numbered_where_the_range_split_has_sorted_them(spark):
    rows = spark.range(0, 1000, 1, 7).selectExpr("id % 10 AS a", "id % 3 AS b")
    found = dense_ids(rows, "n", partitions=5)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan
    made = sorted((r.n, r.a, r.b) for r in found.collect())
    assert [m[0] for m in made] == list(range(1, 1001))
    assert [m[1:] for m in made] == sorted((r.a, r.b) for r in rows.collect())
