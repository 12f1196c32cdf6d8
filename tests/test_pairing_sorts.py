"""The windows of the pairing share their sorts."""

from settlekit.operators import pairing


def test_numbering_sorts_the_rows_twice(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1.0, feed, n, 8 * n + feed, 0) for n in range(2) for feed in range(2)],
        "trade_id string, q long, p double, feed int, leg0 int, mid long, slice int")
    plan = pairing._numbered(rows, pairing._cut_groups(rows, 2), 2)._jdf.queryExecution().executedPlan().toString()
    assert sum(" Sort [" in line and "mid#" in line for line in plan.splitlines()) == 2
