
import pytest
from pyspark.sql import functions as F

from abtest_spark.operators.bayes import bayes_summary
from abtest_spark.plans.catalog import QUERIES as Q

EXPECTED = {
    # sf: duplicate groups, bronze, BUY rows, silver rows, flagged share, gold rows, null-day gold rows,
    #     sum users, sum purchases, tunnel rows, tunnel sum users, chi-square tests
    "sf0.001": (20, 1000, 43, 2921, 0.6967, 209, 6, 1238, 844, 955, 2390, 60),
    "sf0.01": (200, 10000, 367, 29230, 0.6356, 248, 8, 12342, 7997, 1294, 24154, 60),
    "sf0.1": (2000, 100000, 4013, 292325, 0.6707, 248, 8, 124037, 83805, 1471, 242648, 60),
}


@pytest.mark.parametrize("sf", list(EXPECTED))
def test_chain_figures(spark, sf):
    d = f"/root/testdata/{sf}"
    dup, bronze_n, buys, silver_n, share, gold_n, null_days, users, purchases, tun_n, tun_users, tests = EXPECTED[sf]
    assert Q["duplicate_groups"](spark, d).count() == dup
    bronze = Q["bronze"](spark, d)
    assert bronze.count() == bronze_n
    assert bronze.where(F.col("event_name") == "BUY").count() == buys
    silver = Q["silver"](spark, d)
    assert silver.count() == silver_n
    assert round(silver.agg(F.avg(F.col("flag_purchase").cast("double"))).first()[0], 4) == share
    gold = Q["gold_aggregated"](spark, d)
    assert gold.count() == gold_n and gold.where(F.col("day").isNull()).count() == null_days
    assert tuple(gold.agg(F.sum("users"), F.sum("purchases")).first()) == (users, purchases)
    tunnel = Q["gold_tunnel"](spark, d)
    assert tunnel.count() == tun_n and tunnel.agg(F.sum("users")).first()[0] == tun_users
    assert Q["chi2_test"](spark, d).count() == tests


def test_pooled_totals_and_posterior_sf001(spark):
    d = "/root/testdata/sf0.01"
    totals = {(r["experiment_name"], r["variant_id"]): (r["purchases"], r["users"]) for r in Q["variant_totals"](spark, d).collect()}
    assert totals == {
        ("checkout/button", "1"): (1337, 2011),
        ("checkout/button", "2"): (1282, 2027),
        ("search/ranking", "1"): (946, 1343),
        ("search/ranking", "2"): (883, 1349),
        ("search/ranking", "3"): (790, 1346),
    }
    gold = Q["gold_aggregated"](spark, d)  # the operator: the registered query rounds
    summ = {(r["experiment_name"], r["variant_id"]): (r["mean"], r["sd"]) for r in bayes_summary(gold).collect()}
    want = {
        ("checkout/button", "1"): (0.6646768693, 0.01051305),
        ("checkout/button", "2"): (0.6324244383, 0.01069391),
        ("search/ranking", "1"): (0.7038872290, 0.01242603),
        ("search/ranking", "2"): (0.6543898571, 0.01291242),
        ("search/ranking", "3"): (0.5872099092, 0.01338352),
    }
    for k, (m, sd) in want.items():
        assert summ[k][0] == pytest.approx(m, abs=1e-10)
        assert summ[k][1] == pytest.approx(sd, abs=1e-8)


@pytest.mark.parametrize("sf,tested,skipped", [("sf0.001", 14, 46), ("sf0.01", 22, 38)])
def test_uncut_marker_skips_groups(spark, sf, tested, skipped):
    """Every purchase a BUY: most users convert, so many experiment-days have
    no non-converting user and cannot be tested (SURVEY 7.3)."""
    d = f"/root/testdata/{sf}"
    assert Q["chi2_test_uncut"](spark, d).count() == tested
    sk = Q["chi2_skipped_uncut"](spark, d)
    assert sk.count() == skipped
    assert {r["reason"] for r in sk.collect()} == {"zero column total"}
