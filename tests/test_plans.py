"""Plan-shape regressions: the scale properties the design relies on."""

import contextlib
import io

import pytest

from abtest_spark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["gold_aggregated", "gold_tunnel"])
def test_gold_has_no_window_and_reads_buys_alone_for_statistics(spark, name):
    plan = _final_plan(QUERIES[name](spark, SF))
    assert "Window" not in plan
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange hashpartitioning") <= 5


def test_quality_report_one_scan(spark):
    plan = _final_plan(QUERIES["quality_report"](spark, SF))
    assert plan.count("FileScan parquet") == 1
    assert "ReusedExchange" in plan


def test_attach_broadcasts_bounded_hot_table_and_joins_on_salt(spark):
    plan = _final_plan(QUERIES["flag_purchase"](spark, SF))
    assert "BroadcastExchange" in plan
    assert "_salt" in plan and "_pk_salt" in plan


def test_window_twin_has_no_hash_shuffle_of_events_by_user(spark):
    """Event rows are laid out by a range shuffle on (piece, user); the only
    hash shuffles on user_id carry the per-(piece, user) aggregate."""
    plan = _final_plan(QUERIES["event_rank"](spark, SF))
    assert "rangepartitioning(_pid" in plan
    lines = plan.splitlines()
    hashed = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(user_id" in line]
    assert hashed
    for i in hashed:
        child = next(line for line in lines[i + 1 :] if line.strip())
        assert "HashAggregate" in child, child


@pytest.mark.parametrize(
    "name",
    [
        "silver",
        "gold_tunnel",
        "funnel",
        "chi2_test",
        "bayes_summary",
        "bayes_comparison",
        "daily_rate_comparison",
        "experiment_result_lookup",
        "buy_group",
    ],
)
def test_no_cross_joins(spark, name):
    plan = _final_plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_bucketed_attribution_shuffles_no_event(spark, tmp_path):
    """Events of a bucketed table meet their users' statistics without an exchange of the events."""
    from pyspark.sql import functions as F

    from abtest_spark.operators import silver as SV
    from abtest_spark.sources import layers as L

    bronze = QUERIES["bronze"](spark, SF)
    hot = bronze.limit(1).select(F.lit(3).cast("long").alias("user_id"), *bronze.columns[1:])
    many = spark.range(900).select(F.lit(3).cast("long").alias("user_id"), F.concat(F.lit("2024-01-01 00:00:"), F.col("id") % 60).alias("timestamp"),
        F.lit("VIEW").alias("event_name"), F.col("id").alias("item_id"), F.lit("s").alias("site"), F.lit("{e=1}").alias("experiments"))
    nobody = many.limit(50).withColumn("user_id", F.lit(None).cast("long"))
    rows = bronze.unionByName(hot).unionByName(many).unionByName(nobody).distinct()
    table = L.write_bucketed(rows, str(tmp_path), "bronze", "bronze_plan_test", 8, sort_by=["user_id", "timestamp"])
    found = SV.flag_purchases_bucketed(table, L.read_layer(spark, str(tmp_path), "bronze"), 8)
    plan = _final_plan(found)
    above_events = [line for line in plan.splitlines() if "Exchange" in line and "item_id" in line]
    assert not above_events
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    # every exchange carries statistics: nothing that reads the events is below one
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange" in line and "Broadcast" not in line:
            depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
            below = []
            for other in lines[i + 1 :]:
                if len(other) - len(other.lstrip(" :+-*()0123456789")) <= depth:
                    break
                below.append(other)
            assert not any("FileScan" in b for b in below), line
    want = SV.flag_purchases(rows)
    assert found.select(*want.columns).exceptAll(want).isEmpty() and want.exceptAll(found.select(*want.columns)).isEmpty()
    spark.sql("DROP TABLE bronze_plan_test")


@pytest.mark.parametrize("name", ["chi2_test", "variant_totals", "multi_variant_experiments", "conversion_ranking"])
def test_analyses_read_gold_once(spark, name):
    """Analyses that need gold several times read the materialised table, never the events again."""
    plan = _final_plan(QUERIES[name](spark, SF))
    assert "Scan ExistingRDD" in plan and "FileScan" not in plan


def test_posterior_runs_without_python_and_single_partition_windows(spark):
    for name in ("bayes_hdi", "bayes_draws", "posterior_histogram", "bayes_comparison"):
        plan = _final_plan(QUERIES[name](spark, SF))
        assert "Python" not in plan and "Pandas" not in plan and "SinglePartition" not in plan, name
