"""The plan of the trips that the given tables stand for."""

from millrace import fixtures as fx

SMALL = "/root/testdata/sf0.001"


def test_lines_are_joined_to_orders_that_know_their_customer(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        lines = fx.trips_raw(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    finally:
        spark.conf.set(threshold, before)

    def depth(line):
        return next(i for i, c in enumerate(line) if c.isalpha())

    at = next(i for i, line in enumerate(lines) if "Join Inner" in line and "o_custkey" in line)
    below = []
    for line in lines[at + 1 :]:
        if not line.strip() or depth(line) <= depth(lines[at]):
            break
        below.append(line)
    # Were lines below this join, each of them would be shuffled a second time, by customer.
    assert below and not any("Window" in line or "l_orderkey" in line for line in below)
