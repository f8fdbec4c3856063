"""Mergeable distinct-user sketches against exact counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from abtest_spark import schema as S
from abtest_spark.operators import sketches as K

SILVER = (
    "user_id long, timestamp timestamp_ntz, event_name string, item_id long, site string, "
    "experiment_name string, variant_id string, flag_purchase boolean"
)


def silver_of(spark, rows):
    full = [(u, d and dt.datetime(2024, 1, d, 5), "VIEW", 1, "s", e, v, f) for u, d, e, v, f in rows]
    return spark.createDataFrame(full, SILVER)


def test_rollup_counts_a_returning_user_once(spark):
    rows = [
        (1, 1, "e", "a", True), (1, 2, "e", "a", False), (1, 9, "e", "a", True), (2, 2, "e", "a", False),
        (None, 2, "e", "a", True), (3, None, "e", "a", True), (3, 1, "e", None, False), (4, 1, None, "a", False),
    ]
    sketches = K.gold_sketches(silver_of(spark, rows))
    assert {(r.experiment_name, r.variant_id, r.users, r.purchases) for r in K.rollup_users(sketches).collect()} == {
        ("e", "a", 3, 2), ("e", None, 1, 0), (None, "a", 1, 0)
    }
    weeks = {(r.week, r.experiment_name, r.variant_id): (r.users, r.purchases) for r in K.rollup_weeks(sketches).collect()}
    assert weeks[dt.date(2024, 1, 1), "e", "a"] == (2, 1)
    assert weeks[dt.date(2024, 1, 8), "e", "a"] == (1, 1)
    assert weeks[None, "e", "a"] == (1, 1)


def test_daily_estimates_are_gold(spark):
    from abtest_spark.operators.gold import gold_aggregated
    from abtest_spark.plans.catalog import QUERIES

    silver = QUERIES["silver"](spark, "/root/testdata/sf0.001")
    daily = K.estimates(K.gold_sketches(silver)).select(*S.GOLD_KEY, "users", "purchases")
    gold = gold_aggregated(silver)
    assert daily.exceptAll(gold).isEmpty() and gold.exceptAll(daily).isEmpty()


@pytest.mark.parametrize("log_size", [10, 14])
def test_error_above_the_exact_range(spark, log_size):
    """200,000 users over 20 days, each on several of them: within four standard errors."""
    n = 200_000
    silver = (
        spark.range(n * 3)
        .select(
            (F.col("id") % n).alias("user_id"),
            F.timestamp_add("DAY", (F.xxhash64("id") % 10 + 10).cast("int"), F.lit("2024-01-01").cast("timestamp")).cast("timestamp_ntz").alias("timestamp"),
            F.lit("e").alias("experiment_name"),
            F.lit("a").alias("variant_id"),
            (F.col("id") % n % 4 == 0).alias("flag_purchase"),
        )
        .repartition(7)
    )
    r = K.rollup_users(K.gold_sketches(silver, log_size=log_size), log_size=log_size).first()
    error = 4 * K.relative_error(log_size)
    assert abs(r.users / n - 1) < error and abs(r.purchases / (n / 4) - 1) < error


def test_merging_in_steps_and_empty_input(spark):
    rows = [(u, 1 + u % 20, "e", "ab"[u % 2], u % 3 == 0) for u in range(500)]
    sketches = K.gold_sketches(silver_of(spark, rows))
    weekly = K.merge_sketches(
        sketches.withColumn("week", F.date_trunc("week", "day")), ["week", "experiment_name", "variant_id"]
    )
    assert K.rollup_users(weekly).exceptAll(K.rollup_users(sketches)).isEmpty()
    assert K.rollup_users(sketches.where("false")).collect() == []


def test_rollup_reads_the_sketches_alone(spark):
    """The plan of a roll-up has one shuffle of one sketch per group and task, and no users."""
    sketches = K.gold_sketches(silver_of(spark, [(1, 1, "e", "a", True)])).checkpoint()
    plan = K.rollup_users(sketches)._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in plan and plan.count("Exchange") == 1
