"""Vertical scans against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bond

ROWS = "vec_id long, label long, v array<long>, score string, rank string, shard string, slot string"


def plain(rows, positives, negatives, least, most):
    found = []
    for a, label, v in rows:
        if a % 3:
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(v, w)), i, other)
            for i, other, w in rows
            if i != a and len(w) == len(v)
        )
        best = [(i, -s) for s, i, other in scored if other == label][:positives]
        for i, p in best:
            fit = [
                (j, -s)
                for s, j, other in scored
                if other != label and least * p <= -100 * s <= most * p
            ]
            found += [(a, i, n, j, p, s) for n, (j, s) in enumerate(fit[:negatives], 1)]
    return sorted(found)


def some_rows(seed, n, dim, size):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(3), [rng.randint(-size, size) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, rows[i][1] if i % 2 else 1, rows[i][2]) for i in range(10)]  # ties
    return rows


@pytest.mark.parametrize(
    "seed, dim, size, shard, block",
    [(1, 10, 9, 16, 7), (2, 3, 2, 1000, 1000), (3, 20, 50, 5, 3), (4, 9, 2**30, 30, 1000)],
)
def test_equals_all_pairs(spark, seed, dim, size, shard, block):
    rows = some_rows(seed, 60, dim, size)
    frame = spark.createDataFrame([(*r, "s", "r", "h", "l") for r in rows], ROWS)
    repeated = frame.unionByName(frame.filter("vec_id < 5"))
    found = bond.hard_negatives(repeated, F.col("vec_id") % 3 == 0, 4, 3, 30, 90, shard, block)
    fits = [r for r in plain(rows, 4, 3, 30, 90)]
    assert sorted(map(tuple, found.collect())) == fits and fits


def test_scan_drops_rows_early_and_loses_none():
    rng = np.random.default_rng(0)
    columns = rng.integers(-50, 50, (24, 400))
    anchor = rng.integers(-50, 50, 24)
    scores = anchor @ columns
    low, high = columns.min(axis=1), columns.max(axis=1)
    for least, most in ((bond.LOWEST, bond.HIGHEST), (0, 500), (2000, 9000), (10**6, 10**7)):
        [(rows, found)] = bond.scan(
            columns, low, high, anchor, np.arange(400), [(least, most)], [bond.LOWEST], 6, step=4
        )
        inside = np.sort(scores[(scores >= least) & (scores <= most)])[::-1][:6]
        assert found[:6].tolist() == inside.tolist() and (scores[rows] == found).all()


def test_fewer_rows_than_wanted_and_empty(spark):
    rows = [(0, 1, [2, 2]), (1, 1, [3, 3]), (2, 2, [1, 1]), (3, 2, [-5, 0]), (6, 1, []), (9, 5, [1, 0, 0])]
    frame = spark.createDataFrame([(*r, "s", "r", "h", "l") for r in rows], ROWS)
    found = bond.hard_negatives(frame, F.col("vec_id") % 3 == 0).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 1, 2, 12, 4)]
    assert bond.hard_negatives(frame.limit(0), F.lit(True)).count() == 0
    assert bond.hard_negatives(frame, F.lit(False)).count() == 0


def test_query_keeps_to_valid_rows(spark, tmp_path):
    good = [(i, [i // 10 % 7 + 1.0, 1.0], i // 10 % 2) for i in range(0, 300, 10)]
    bad = [
        (401, [None, 1.0], 1),
        (402, None, 1),
        (403, [float("nan"), 0.0], 0),
        (404, [float("-inf"), 0.0], 0),
        (405, [9.0, 9.0], None),
        (None, [9.0, 9.0], 1),
    ]
    path = f"{tmp_path}/embeddings.parquet"
    kind = "vec_id long, embedding array<float>, label int"
    spark.createDataFrame(good + bad, kind).write.parquet(path)
    found = bond.op13_hard_negatives(spark, str(tmp_path)).collect()
    ids = {i for r in found for i in (r.anchor_id, r.positive_id, r.negative_id)}
    assert found and ids <= {i for i, _, _ in good}
