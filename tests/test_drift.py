"""Schema drift over the log: columns that come, widen and clash, and mirrors that follow."""

import json

import pytest
from cdc_rows import event, image, log, records
from pyspark.sql import functions as F

from millrace.operators import drift
from millrace.plans import cdc as plan
from millrace.schemas import CUSTOMERS, DOUBLE, LONG, STRING
from millrace.sources.tables import VersionedTables


def of(spark, *extras):
    """Types of images with these columns beside the usual ones."""
    return drift.image_types(log(spark, *[event("c", i, 1, i, image(i, **e)) for i, e in enumerate(extras)]))


def kinds(frame, *names):
    found = {r.column: r.kind for r in frame.collect()}
    return tuple(found.get(n) for n in names)


def statuses(spark, old, new):
    found = drift.drift(of(spark, *old), of(spark, *new))
    usual = {"id", "name", "email", "country", "created_at"}
    return {r.column: (r.before, r.now, r.status, r.images) for r in found.collect() if r.column not in usual}


def test_each_status(spark):
    old = [dict(a=1, b=1, c="x", d=None, e=True, gone=1)]
    new = [dict(a=2, b=1.5, c=3, d="y", e=False, f=[1]), dict(a=3, b=2, c="z", f=[2])]
    assert statuses(spark, old, new) == {
        "a": ("BIGINT", "BIGINT", "same", 2),
        "b": ("BIGINT", "DECIMAL", "widened", 2),
        "c": ("STRING", "VARIANT", "clashed", 2),
        "d": ("VOID", "STRING", "widened", 1),
        "e": ("BOOLEAN", "BOOLEAN", "same", 1),
        "f": (None, "ARRAY", "came", 2),
        "gone": ("BIGINT", "BIGINT", "absent", 0),
    }


def test_folding_is_the_same_in_any_order(spark):
    parts = [[dict(a=1)], [dict(a=1.5, b="x")], [dict(b=2), dict(a=None)], [dict(a=1e300)]]
    whole = of(spark, *[e for part in parts for e in part])
    for order in ((0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1)):
        stored = of(spark, *parts[order[0]])
        for n in order[1:]:
            stored = drift.fold_types(stored, of(spark, *parts[n]))
        assert kinds(stored, "a", "b", "id") == kinds(whole, "a", "b", "id")
        held = {r.column: r.images for r in stored.collect()}
        assert held == {r.column: r.images for r in whole.collect()}


def test_images_that_are_no_objects_have_no_columns(spark):
    odd = [event("c", 1, 1, 1)[:1] + (json.dumps({"payload": {"op": "c", "after": a}}), CUSTOMERS.topic, 0, i)
           for i, a in enumerate(["text", 3, [1], None, {}])]
    assert drift.image_types(log(spark, *odd)).count() == 0
    assert drift.drift(of(spark, {}).limit(0), of(spark, {}).limit(0)).count() == 0


def test_types_are_never_narrowed(spark):
    entity = CUSTOMERS.with_column("n", LONG).with_column("t", STRING)
    found = drift.drift(of(spark, dict(n=1, t=1)), of(spark, dict(n=1.5, t=2.5, z=None)))
    wider = drift.evolved(entity, found)
    assert dict(zip(wider.columns.names, [f.dataType for f in wider.columns])) == {
        "name": STRING, "email": STRING, "country": STRING, "n": DOUBLE, "t": STRING,
    }


@pytest.mark.parametrize("news", [{}, dict(n=2.5, phone="+1")])
def test_mirror_follows(spark, tmp_path, news):
    tables = VersionedTables(spark, str(tmp_path))
    entity = CUSTOMERS.with_column("n", LONG)
    first = records(spark, *[event("c", i, 1, i, image(i, n=i)) for i in range(3)])
    plan.append_bronze(tables, first)
    tables.ensure_table("cdc.wide", entity.mirror)
    plan.apply_drift(tables, "cdc.wide", entity, first.limit(0))
    second = records(spark, event("u", 1, 2, 9, image(1, **{"n": 7, **news})))
    wider, found = plan.apply_drift(tables, "cdc.wide", entity, second.unionByName(first))
    assert found.filter(F.col("column") == "name").first().images == 1  # replays are no news
    got = {r.id: (r.n, r.asDict().get("phone")) for r in tables.read("cdc.wide").collect()}
    assert got == {0: (0, None), 1: (news.get("n", 7), news.get("phone")), 2: (2, None)}
    assert (wider == entity) == (not news)
