"""Incremental change log: bucketed state, the ledger of positions, histories that are extended."""

import itertools
import os
import random

from cdc_rows import AS_OF, event, image, log, records, tombstone
from conftest import rows

from millrace.operators import cdc, gold
from millrace.plans.incremental import IncrementalCdc, state_schema
from millrace.schemas import CUSTOMERS, RECORD
from millrace.sources import ledger
from millrace.sources.buckets import BucketedState

import pytest


def files(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path)
        for name in names
        if name.startswith("part-")
    }


def events_of(seed, n, ids):
    rng = random.Random(seed)
    made = []
    for offset in range(n):
        op = rng.choice("ccuuurd")
        after = None if op == "d" else image(0, rng.choice("ab") + "@x", rng.choice(["EE", "FI"]))
        id = rng.randrange(ids)
        if after:
            after |= {"id": id, "name": f"n{id}"}
        made.append(event(op, id, 1000 * rng.randrange(n // 2), offset * 3, after, lsn=rng.randrange(5)))
    return made


def whole(spark, events):
    full = log(spark, *events)
    mirror = cdc.rebuild_mirror(full, CUSTOMERS)
    flagged = gold.field_changes(gold.customer_events(full))
    return rows(mirror), rows(gold.customer_activity(flagged, mirror, AS_OF)), full


@pytest.mark.parametrize("split", ["interleaved", "backwards", "replayed"])
def test_any_split_gives_the_whole(spark, tmp_path, split):
    events = events_of(len(split), 80, 7)
    mirror, activity, full = whole(spark, events)
    in_order = sorted(events, key=lambda e: e[4])
    parts = {
        "interleaved": [events[0::3], events[1::3], events[2::3]],
        "backwards": [in_order[50:], in_order[:30], in_order[30:50]],
        "replayed": [events[:40], events[20:60] + events[:5], events, events],
    }[split]
    job = IncrementalCdc(spark, str(tmp_path), 4, {"customers": CUSTOMERS})
    for part in parts:
        job.run(records(spark, *part))
    assert rows(job.log()) == rows(full.dropDuplicates(["kafka_offset"]))
    assert rows(job.mirror("customers")) == mirror
    assert rows(job.activity(AS_OF)) == activity
    assert job.validate("customers", cdc.rebuild_mirror(full, CUSTOMERS)).first()[2:] == (0, 0, 0)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    job = IncrementalCdc(spark, str(tmp_path), buckets=16)
    job.run(records(spark, *[event("c", i, 1000, i) for i in range(200)]))
    before = files(f"{tmp_path}/customers/data")
    job.run(records(spark, event("u", 5, 2000, 900, image(5, "z@x")), event("d", 6, 2000, 901)))
    after = files(f"{tmp_path}/customers/data")
    kept = set(before.items()) & set(after.items())
    assert len(before) == 16 and 14 <= len(kept) < 16
    assert job.mirror("customers").count() == 199


def test_a_batch_reads_touched_buckets_only(spark, tmp_path):
    schema = state_schema(spark, CUSTOMERS)
    state = BucketedState(spark, f"{tmp_path}/s", schema, "id", 8)
    first = cdc.latest_changes(log(spark, *[event("c", i, 1, i) for i in range(64)]), CUSTOMERS)
    assert state.fold(first, 1, cdc.fold_state) == list(range(8))
    text = state.read([3])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in text or "PartitionFilters: [bucket" in text
    assert len({os.path.dirname(f) for f in state.read([3]).inputFiles()}) <= 8


def test_a_fold_that_died_is_finished_once(spark, tmp_path, monkeypatch):
    from millrace.sources import buckets

    schema = state_schema(spark, CUSTOMERS)
    state = BucketedState(spark, f"{tmp_path}/s", schema, "id", 4)
    changes = [
        cdc.latest_changes(log(spark, event("c", i, 1, i), event("c", i + 1, 1, i + 50)), CUSTOMERS)
        for i in range(3)
    ]
    state.fold(changes[0], 1, cdc.fold_state)
    real = buckets.write_by

    def dies(df, path, *args, **kwargs):
        if path == state.data:
            raise RuntimeError("lost")
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(buckets, "write_by", dies)
    with pytest.raises(RuntimeError):
        state.fold(changes[1], 2, cdc.fold_state)
    monkeypatch.setattr(buckets, "write_by", real)
    calls = []

    def merge(old, new):
        calls.append(1)
        return cdc.fold_state(old, new)

    state.fold(changes[1], 2, merge)  # from what was staged
    state.fold(changes[1], 2, merge)  # not again
    assert not calls and rows(state.read(), "id") == [(0,), (1,), (2,)]


def test_a_run_that_died_is_finished_as_it_was_written(spark, tmp_path, monkeypatch):
    events = events_of(9, 40, 5)
    mirror, activity, _ = whole(spark, events)
    job = IncrementalCdc(spark, str(tmp_path), buckets=4)
    job.run(records(spark, *events[:10]))
    real, calls = BucketedState.fold, itertools.count()

    def dies(self, *args):
        if next(calls) == 2:  # log, ledger and both mirrors are written, the history is not
            raise RuntimeError("lost")
        return real(self, *args)

    monkeypatch.setattr(BucketedState, "fold", dies)
    with pytest.raises(RuntimeError):
        job.run(records(spark, *events[10:20]))
    assert job.last_batch() == 1 and job.log().count() == 10
    monkeypatch.setattr(BucketedState, "fold", real)
    assert job.run(records(spark, *events)) == 3
    assert rows(job.mirror("customers")) == mirror and rows(job.activity(AS_OF)) == activity


def test_ledger_tells_replays_gaps_and_late_records(spark):
    def at(*offsets, topic="t", partition=0):
        made = [("k", "{}", topic, partition, o) for o in offsets]
        frame = spark.createDataFrame(made, "key string, value string, topic string, partition int, offset long")
        return cdc.parse_envelope(frame.selectExpr("*", "timestamp'2024-01-01' AS timestamp").select(*RECORD.names))

    stored = at(0, 1, 2, 3, 7, 8, 32768, 32769, 65536, 65537, 10**12)
    book = ledger.positions(stored).unionByName(ledger.positions(at(5, topic="u")))
    book = book.unionByName(ledger.positions(at(20)))
    asked = at(0, 1, 4, 5, 6, 7, 9, 20, 32767, 32768, 32770, 65536, 10**12, 10**12 + 1, 4, 4)
    found = sorted(r.kafka_offset for r in ledger.unseen(asked, book).collect())
    assert found == [4, 5, 6, 9, 32767, 32770, 10**12 + 1]
    assert rows(ledger.unseen(at(0, 5, partition=1), book), "kafka_offset") == [(0,), (5,)]
    found = {(r.topic, r.kafka_partition): (r.records, r.last_offset) for r in ledger.held(book).collect()}
    assert found == {("t", 0): (12, 10**12), ("u", 0): (1, 5)}
    assert rows(ledger.held(ledger.positions(at(0)))) == [("t", 0, 1, 0)]


def test_no_join_with_the_log(spark, tmp_path):
    job = IncrementalCdc(spark, str(tmp_path), buckets=2)
    job.run(records(spark, event("c", 1, 1000, 1), tombstone(1, 2)))
    found = ledger.unseen(cdc.parse_envelope(records(spark, event("c", 1, 1000, 1))), job.ledger())
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "ledger" in text and "/log" not in text and found.count() == 0


def test_nothing_and_other_topics(spark, tmp_path):
    job = IncrementalCdc(spark, str(tmp_path), buckets=2)
    none = records(spark, event("c", 1, 1000, 1)).limit(0)
    assert job.run(none) == 1 and job.log().count() == 0
    job.run(records(spark, event("c", 1, 1000, 1, topic="another")))
    assert job.log().count() == 1 and job.activity(AS_OF).count() == 0
    assert job.churn(AS_OF).count() == 0 and job.mirror("drivers").count() == 0
