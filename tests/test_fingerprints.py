"""Parity by fingerprints: differences are found, equal parts are never compared row by row."""

import pytest
from cdc_rows import AS_OF, event, image, records
from conftest import rows

from millrace.operators import checks
from millrace.plans import cdc as plan
from millrace.plans.incremental import IncrementalCdc
from millrace.sources.tables import VersionedTables

SHAPE = "id int, a string, b string"


def frame(spark, made):
    return spark.createDataFrame(made, SHAPE)


def found(spark, mirror, source, **how):
    apart = checks.differences(frame(spark, mirror), frame(spark, source), ["id"], **how)
    return sorted((tuple(r) for r in apart.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_planted_differences_are_found(spark, levels):
    mirror = [(i, f"a{i}", None) for i in range(500)]
    source = [(i, "z" if i == 77 else f"a{i}", None) for i in range(500) if i != 13]
    expected = [(13, "a13", None, "mirror", 1), (77, "a77", None, "mirror", 1), (77, "z", None, "source", 1)]
    assert found(spark, mirror, source, fanout=4, levels=levels) == expected
    row = checks.fingerprint_parity(frame(spark, mirror), frame(spark, source), ["id"], 4, levels).first()
    assert tuple(row)[:2] == (500, 499) and (row.only_mirror, row.only_source) == (2, 1)
    assert 1 <= row.unequal_nodes <= 2


def test_it_equals_parity_by_rows(spark):
    mirror = [(i % 9, "x" if i % 4 else None, None if i % 3 else "y") for i in range(60)]
    source = [(i % 9, "x" if i % 5 else None, None if i % 3 else "y") for i in range(50)] + [(None, None, None)]
    a, b = frame(spark, mirror), frame(spark, source)
    plain, by_print = checks.parity(a, b).first(), checks.fingerprint_parity(a, b, ["id"], 3, 2).first()
    for name in plain.asDict():
        assert plain[name] == by_print[name]


def test_nulls_swapped_between_columns_and_repeats_count(spark):
    assert found(spark, [(1, "a", None)], [(1, None, "a")]) == [
        (1, "a", None, "mirror", 1),
        (1, None, "a", "source", 1),
    ]
    assert found(spark, [(1, "a", "b")] * 3, [(1, "a", "b")]) == [(1, "a", "b", "mirror", 2)]
    assert found(spark, [(None, "a", "b")], []) == [(None, "a", "b", "mirror", 1)]


def test_equal_tables_shuffle_no_rows(spark):
    same = [(i % 50, f"a{i}", None) for i in range(400)]
    a, b = frame(spark, same), frame(spark, same[::-1])
    assert found(spark, same, same[::-1]) == found(spark, [], []) == []
    result = checks.fingerprint_parity(a, b, ["id"])
    assert tuple(result.first()) == (400, 400, 0, 0, 0)
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "fingerprints" in text and "ExistingRDD" not in text  # only sums of nodes are read


def test_one_key_with_all_rows(spark):
    same = [(1, f"a{i}", "b") for i in range(300)]
    assert found(spark, same + [(1, "new", "b")], same) == [(1, "new", "b", "mirror", 1)]


def test_validation_is_the_last_step_of_a_run(spark, tmp_path):
    made = records(spark, *[event("c", i, 1000, i, image(i, f"e{i}@x")) for i in range(20)])
    tables = VersionedTables(spark, str(tmp_path))
    assert plan.run(tables, made, AS_OF) is None
    mirror = tables.read("cdc.silver_customers")
    source = mirror.filter("id != 4")
    report = plan.run(tables, made, AS_OF, {"cdc.silver_customers": source})
    assert rows(report) == [("cdc.silver_customers", 20, 19, 1, 1, 0, 0)]


def test_incremental_differences(spark, tmp_path):
    job = IncrementalCdc(spark, str(tmp_path), buckets=2)
    job.run(records(spark, *[event("c", i, 1000, i, image(i, f"e{i}@x")) for i in range(20)]))
    source = job.mirror("customers").filter("id != 4")
    assert [(r.id, r.side) for r in job.differences("customers", source).collect()] == [(4, "mirror")]
