"""Skew-aware attach: proven bounds and equality with a plain join."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from abtest_spark.operators.joins import attach_per_key, with_splits

P = 8


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    weights=st.lists(st.integers(min_value=1, max_value=400), min_size=1, max_size=12),
    null_key_rows=st.integers(min_value=0, max_value=300),
)
def test_attach_bounds_and_result(spark, weights, null_key_rows):
    rows = [(k, i) for k, w in enumerate(weights) for i in range(w)] + [(None, i) for i in range(null_key_rows)]
    big = spark.createDataFrame(rows, "k long, i long")
    per_key = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), (F.sum("i") + F.lit(7)).alias("payload"))

    splits = with_splits(per_key, "n", P).collect()
    hot = [r for r in splits if r["_splits"] > 1]
    assert len(hot) < P  # broadcast side bound
    from abtest_spark.operators.joins import OVERSPLIT

    assert sum(r["_splits"] for r in hot) < (OVERSPLIT + 1) * P  # replication bound
    total = sum(r["n"] for r in splits)
    for r in hot:
        assert r["n"] * P > total

    got = attach_per_key(big, per_key, "k", "n", ["i"], P)
    assert got.count() == len(rows)
    pk = per_key.withColumnRenamed("k", "pk")
    want = big.join(pk, big["k"].eqNullSafe(pk["pk"]), "left").select("k", "i", "n", "payload")
    assert got.select("k", "i", "n", "payload").exceptAll(want).count() == 0
