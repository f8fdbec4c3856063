"""Global positions without a single-partition window."""

import random

import pytest
from pyspark.sql import functions as F

from abtest_spark.operators.ordering import with_position


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_positions_are_the_sorted_order(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, *range(9)]), i, "x") for i in range(n)]
    df = spark.createDataFrame(rows, "a int, b int, position_note string").repartition(5)
    got = with_position(df, [F.desc_nulls_last("a"), "b"]).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(1, n + 1))


def test_no_single_partition_window(spark):
    df = with_position(spark.range(1000), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
