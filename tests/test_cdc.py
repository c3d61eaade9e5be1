import itertools
import json
import random

from cdc_rows import event, image, log, records, tombstone
from conftest import rows

from millrace.operators import cdc
from millrace.operators.checks import assert_stable, content_hash, duplicate_keys, parity
from millrace.schemas import BRONZE_CDC, CUSTOMERS, DRIVERS, STRING

import pytest


def test_envelope_and_tombstones(spark):
    broken = ("9", '{"payload":{"op":"c",', CUSTOMERS.topic, 0, 7)
    odd = ("8", '{"payload":{"op":"u","ts_ms":"soon","after":{"id":8}}}', CUSTOMERS.topic, 0, 8)
    out = cdc.parse_envelope(
        records(spark, event("c", 1, 1000, 5), event("d", 1, 2000, 6), tombstone(1, 9), broken, odd)
    )
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in BRONZE_CDC
    ]
    found = rows(out, "kafka_offset", "op", "ts_ms", "lsn", "before")
    assert found[0] == (5, "c", 1000, 5, None)
    assert found[1] == (6, "d", 2000, 6, '{"id":1}')
    assert found[2][:3] in ((7, "c", None), (7, None, None))
    assert found[3] == (8, "u", None, None, None)
    after = out.filter("kafka_offset = 5").first().after
    assert json.loads(after) == image(1)


def test_flattened(spark):
    out = cdc.flatten_envelope(
        records(spark, event("c", 1, 1000, 5), event("d", 1, 2000, 6)), ["name", "email"]
    )
    assert rows(out, "op", "after_id", "after_name", "after_email", "before_id") == [
        ("c", 1, "n1", "a@x", None),
        ("d", None, None, None, 1),
    ]


def test_ties_follow_the_log_position(spark):
    df = log(
        spark,
        event("u", 1, 1000, 3, image(1, "late@x"), lsn=20),
        event("u", 1, 1000, 9, image(1, "early@x"), lsn=10),
    )
    assert rows(cdc.rebuild_mirror(df, CUSTOMERS), "id", "email") == [(1, "late@x")]


def test_mirror_after_delete_and_return(spark):
    df = log(
        spark,
        event("c", 1, 1000, 1),
        event("d", 1, 2000, 2),
        tombstone(1, 3),
        event("c", 1, 3000, 4, image(1, "new@x")),
        event("d", 2, 500, 5),
        event("r", 3, 100, 6),
        event("c", 4, 100, 7, topic=DRIVERS.topic),
    )
    assert rows(cdc.rebuild_mirror(df, CUSTOMERS)) == [
        (1, "n1", "new@x", "EE", 3000),
        (3, "n3", "a@x", "EE", 100),
    ]


def test_driver_columns_are_cast_safely(spark):
    good = {"id": 1, "name": "d", "rating": 4.5, "active": True, "city": "T", "created_at": 5}
    bad = {"id": 2, "rating": "bad", "active": "zz"}
    df = log(
        spark,
        event("c", 1, 1, 1, good, topic=DRIVERS.topic),
        event("c", 2, 1, 2, bad, topic=DRIVERS.topic),
    )
    assert rows(cdc.rebuild_mirror(df, DRIVERS), "id", "rating", "active", "created_at") == [
        (1, 4.5, True, "5"),
        (2, None, None, None),
    ]


def merged(spark, target, *changes):
    """Apply (id, email, ms, op) changes to (id, email, ms) rows."""
    columns = "id int, name string, email string, country string, last_updated_ms long"
    table = spark.createDataFrame([(i, None, e, None, t) for i, e, t in target], columns)
    latest = spark.createDataFrame(
        [(i, None, e, None, t, op) for i, e, t, op in changes], columns + ", op string"
    )
    return rows(cdc.merge_changes(table, latest), "id", "email", "last_updated_ms")


def test_merge_actions(spark):
    start = [(1, "a", 10), (2, "b", 10), (3, "c", 10), (4, "d", 10)]
    out = merged(
        spark,
        start,
        (1, None, 20, "d"),
        (2, "b2", 20, "u"),
        (3, "c2", 20, "x"),
        (5, "e", 20, "r"),
        (6, None, 20, "d"),
        (7, "g", 20, "x"),
    )
    assert out == [(2, "b2", 20), (3, "c", 10), (4, "d", 10), (5, "e", 20), (7, "g", 20)]


def test_merge_ignores_older_changes_and_repeats(spark):
    start = [(1, "a", 10), (2, "b", 10)]
    assert merged(spark, start, (1, "old", 5, "u"), (2, None, 9, "d")) == start
    once = merged(spark, start, (1, "same", 10, "u"))
    assert merged(spark, once, (1, "same", 10, "u")) == once == [(1, "same", 10), (2, "b", 10)]


def random_log(spark, seed):
    pick = random.Random(seed)
    made = []
    for offset in range(120):
        key, op = pick.randrange(8), pick.choice("ccuurd")
        made.append(event(op, key, offset // 3, offset, image(key, f"{offset}@x")))
    return log(spark, *made)


def test_merges_in_order_equal_a_rebuild(spark):
    df = random_log(spark, 1)
    expected = rows(cdc.rebuild_mirror(df, CUSTOMERS))
    target = spark.createDataFrame([], CUSTOMERS.mirror)
    for low, high in ((0, 50), (50, 90), (50, 90), (90, 120)):
        part = df.filter(f"kafka_offset >= {low} AND kafka_offset < {high}")
        target = cdc.merge_changes(target, cdc.latest_changes(part, CUSTOMERS))
        target = spark.createDataFrame(target.collect(), CUSTOMERS.mirror)
    assert rows(target) == expected


def test_folds_in_any_order_equal_a_rebuild(spark):
    df = random_log(spark, 2)
    expected = rows(cdc.rebuild_mirror(df, CUSTOMERS))
    parts = [df.filter(f"kafka_offset % 3 = {n}") for n in range(3)]
    for order in list(itertools.permutations(parts))[::2]:
        state = None
        for part in [*order, order[0]]:
            state = cdc.fold_state(state, cdc.latest_changes(part, CUSTOMERS))
        assert rows(cdc.mirror_rows(state, CUSTOMERS)) == expected


def test_wider_entity_reads_new_column(spark):
    wide = CUSTOMERS.with_column("phone", STRING)
    df = log(spark, event("c", 1, 1, 1), event("c", 2, 1, 2, image(2, phone="+372")))
    assert rows(cdc.rebuild_mirror(df, wide), "id", "phone") == [(1, None), (2, "+372")]


def test_parity_and_duplicates(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "id int, v string")
    two = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    assert tuple(parity(one, two).first()) == (4, 3, 2, 1)
    assert tuple(parity(one, one).first()) == (4, 4, 0, 0)
    assert tuple(parity(one.limit(0), one.limit(0)).first()) == (0, 0, 0, 0)
    assert rows(duplicate_keys(one, ["id"])) == [(2, 2)]


def test_stable_content(spark):
    one = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    assert_stable(one, one.orderBy("v").select("v", "id"))
    with pytest.raises(AssertionError):
        assert_stable(one, one.unionByName(one))
    with pytest.raises(AssertionError):
        assert_stable(one, one.fillna("x"))
    assert content_hash(one.limit(0)).first().row_count == 0
