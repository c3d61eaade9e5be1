"""Record numbers of generated trips: unique at any size of the keys, the same on every read."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace import fixtures as fx

SMALL = "/root/testdata/sf0.001"
FAR = 10_000_000


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the generated tables")
def test_keys_of_any_size(spark, tmp_path):
    for name, moved in (
        ("lineitem", ["l_partkey", "l_suppkey", "l_orderkey"]),
        ("supplier", ["s_suppkey"]),
        ("orders", ["o_orderkey"]),
        ("customer", []),
    ):
        table = fx.table(spark, SMALL, name)
        for key in moved:
            table = table.withColumn(key, F.col(key) + FAR)
        table.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    far, near = (fx.trips_raw(spark, root).select("rec_id") for root in (str(tmp_path), SMALL))
    shift = FAR * fx.LINES * 2
    assert far.distinct().count() == far.count() == near.count()
    assert rows(far.select(F.col("rec_id") - shift)) == rows(near)
