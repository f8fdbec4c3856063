"""Bayesian comparison (FIXTURES F-5, semantics 10-11)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from abtest_spark.operators import bayes as B

D1 = dt.date(2024, 1, 1)


def _gold(gold_df, pairs, exp="e"):
    return gold_df([(D1, exp, str(i + 1), n, s) for i, (s, n) in enumerate(pairs)])


def _means(gold):
    out = B.bayes_summary(gold).orderBy("variant_id").collect()
    return [r["mean"] for r in out], [r["sd"] for r in out]


def direct(pairs, points=240, u_end=14.0, sums=(1e-5, 2000.0)):
    """(mean, sd) of each variant by one fine grid, written without Spark."""
    import math

    import numpy as np

    u = np.linspace(-u_end, u_end, points)
    v = np.linspace(*np.log(sums), points)
    total, odds = np.exp(v)[None], np.exp(u)[:, None]
    a, b = total * odds / (odds + 1), total / (odds + 1)
    lg = np.vectorize(math.lgamma)
    lw = -(a + b) / 3 + np.log(a) + np.log(b)
    base = lg(a) + lg(b) - lg(a + b)
    seen = {}
    for s, n in set(pairs):
        seen[s, n] = lg(a + s) + lg(b + n - s) - lg(a + b + n) - base
    for p in pairs:
        lw = lw + seen[p]
    w = np.exp(lw - lw.max())
    w /= w.sum()
    out = []
    for s, n in pairs:
        m1 = (a + s) / (a + b + n)
        m2 = m1 * (a + s + 1) / (a + b + n + 1)
        e1, e2 = (w * m1).sum(), (w * m2).sum()
        out.append((e1, math.sqrt(e2 - e1 * e1)))
    return out


@pytest.mark.parametrize(
    "pairs,means",
    [
        ([(30, 100), (20, 100)], [0.2996340213, 0.2065763926]),
        ([(3, 1000), (9, 1000), (0, 50)], [0.0032780713, 0.0092427855, 0.0052591410]),
        ([(5000, 10000), (5050, 10000), (4990, 10000)], [0.5000011067, 0.5049963236, 0.4990020633]),
    ],
)
def test_posterior_means_and_sds(gold_df, pairs, means):
    got, sds = _means(_gold(gold_df, pairs))
    want = direct(pairs)
    assert got == pytest.approx([m for m, _ in want], abs=1e-8)
    assert sds == pytest.approx([s for _, s in want], abs=1e-7)
    assert got == pytest.approx(means, abs=2e-6)  # a coarser grid's values


@pytest.mark.parametrize("share", [0.1, 0.5])
def test_many_variants_are_not_cut_off(gold_df, share):
    import random

    r = random.Random(1)
    pairs = [(sum(r.random() < share for _ in range(50)), 50) for _ in range(100)]
    gold = _gold(gold_df, pairs)
    got = {r["variant_id"]: r["mean"] for r in B.bayes_summary(gold).collect()}
    want = direct(pairs, points=160, u_end=3.0, sums=(0.5, 4000.0))
    assert [got[str(i + 1)] for i in range(100)] == pytest.approx([m for m, _ in want], abs=1e-5)
    edge = B.posterior_weights(B.variant_totals(gold)).where("on_edge").agg(F.sum("weight")).first()[0]
    assert edge < 1e-9


def test_days_pool(gold_df):
    one = gold_df([(D1, "e", "1", 100, 30), (D1, "e", "2", 100, 20)])
    split = gold_df(
        [
            (D1, "e", "1", 60, 20),
            (D1 + dt.timedelta(days=1), "e", "1", 40, 10),
            (None, "e", "2", 100, 20),
        ]
    )
    for a, b in zip(_means(one), _means(split), strict=True):
        assert a == pytest.approx(b, abs=1e-12)


def test_weights_sum_to_one(gold_df):
    w = B.posterior_weights(B.variant_totals(_gold(gold_df, [(30, 100), (20, 100)])))
    total = w.groupBy("experiment_name").agg(F.sum("weight").alias("s")).first()["s"]
    assert total == pytest.approx(1.0, abs=1e-12)
    assert w.count() == B.GRID_POINTS**2


def direct_interval(pairs, k, prob=0.95):
    """Shortest interval of variant k by a fine table of its density over theta, without Spark."""
    import math

    import numpy as np

    u, v = np.linspace(-12, 12, 160), np.linspace(math.log(1e-4), math.log(800), 160)
    total, odds = np.exp(v)[None], np.exp(u)[:, None]
    a, b = (total * odds / (odds + 1)).ravel(), (total / (odds + 1)).ravel()
    lg = np.vectorize(math.lgamma)
    lw = -(a + b) / 3 + np.log(a) + np.log(b)
    for s, n in pairs:
        lw = lw + lg(a + s) + lg(b + n - s) - lg(a + b + n) - lg(a) - lg(b) + lg(a + b)
    keep = lw > lw.max() - 27
    a, b, lw = a[keep], b[keep], lw[keep]
    s, n = pairs[k]
    c = lw - lw.max() - (lg(a + s) + lg(b + n - s) - lg(a + b + n))
    x = np.linspace(-34, 24, 20001)
    lt, lr = -np.logaddexp(0, -x), -np.logaddexp(0, x)
    f, below, above = np.zeros(len(x)), 0.0, 0.0
    for ci, ai, bi in zip(c, a, b, strict=True):
        mine = np.exp(ci + (ai + s) * lt + (bi + n - s) * lr)
        f += mine
        below += mine[0] / (ai + s) / (x[1] - x[0])  # there it goes like exp((a + s) x)
        above += mine[-1] / (bi + n - s) / (x[1] - x[0])
    p = np.concatenate(([below], below + np.cumsum((f[1:] + f[:-1]) / 2)))
    p /= p[-1] + above
    theta = 1 / (1 + np.exp(-x))

    def at(q):
        return np.interp(q, p, theta)

    found = [(at(prob), 0.0, at(prob)), (1 - at(1 - prob), at(1 - prob), 1.0)]
    inner = (p > p[0]) & (p + prob < p[-1])
    found += [(at(q + prob) - t, t, at(q + prob)) for q, t in zip(p[inner], theta[inner], strict=True)]
    return min(found)[1:]


@pytest.mark.parametrize(
    "pairs",
    [[(30, 100), (20, 100)], [(3, 1000), (9, 1000), (0, 50)], [(40, 40), (39, 40)], [(1, 3), (2, 3)], [(0, 5), (0, 9)]],
)
def test_exact_intervals_against_a_fine_table(gold_df, pairs):
    gold = _gold(gold_df, pairs)
    found = {r["variant_id"]: r for r in B.bayes_hdi(gold).collect()}
    mass = {r["variant_id"]: r["mass"] for r in B.interval_mass(gold, B.bayes_hdi(gold)).collect()}
    for k in range(len(pairs)):
        low, high = direct_interval(pairs, k)
        r = found[str(k + 1)]
        assert r["hdi_high"] - r["hdi_low"] == pytest.approx(high - low, abs=1e-5)  # the least width; the table's own grid ends at e^-12
        assert (r["hdi_low"], r["hdi_high"]) == (pytest.approx(low, abs=1e-3), pytest.approx(high, abs=1e-3))
        assert mass[str(k + 1)] == pytest.approx(0.95, abs=1e-6)
        if pairs[k][0] == 0:
            assert r["hdi_low"] == 0.0
        if pairs[k][0] == pairs[k][1]:
            assert r["hdi_high"] == 1.0


def test_ends_of_an_interval_are_equally_dense(gold_df):
    """At the ends of the shortest interval the exact density is the same."""
    import math

    gold = _gold(gold_df, [(300, 1000), (250, 1000), (41, 100)])
    fit = B._fit(B.variant_totals(gold), 1 / 3)
    ends = {r["variant_id"]: r for r in B._intervals(B._curves(*fit), 0.95).collect()}
    for v, r in ends.items():
        density = [0.0, 0.0]
        for c in B._cells(*fit).where(F.col("variant_id") == v).collect():
            for i, t in enumerate((r["hdi_low"], r["hdi_high"])):
                lnb = math.lgamma(c["_a"]) + math.lgamma(c["_b"]) - math.lgamma(c["_a"] + c["_b"])
                density[i] += c["weight"] * math.exp((c["_a"] - 1) * math.log(t) + (c["_b"] - 1) * math.log1p(-t) - lnb)
        assert density[0] == pytest.approx(density[1], rel=1e-3)


def test_curve_is_a_distribution(gold_df):
    gold = _gold(gold_df, [(300, 1000), (0, 50), (50, 50), (1, 2)])
    for r in B._curves(*B._fit(B.variant_totals(gold), 1 / 3)).collect():
        assert len(r["p"]) == B.CURVE + 1 and r["p"] == sorted(r["p"])
        if r["variant_id"] == "3":  # nothing but conversions: some of it lies above the last node
            assert 0.9 < r["p"][-1] < 1.0
        else:
            assert r["p"][-1] == pytest.approx(1.0, abs=1e-7)


def test_beta_cdf(spark):
    import math

    def binomial_tail(x, a, b):  # integer a, b: I_x(a, b) = P(Bin(a + b - 1, x) >= a)
        n = a + b - 1
        return math.fsum(
            math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(x) + (n - j) * math.log1p(-x))
            for j in range(a, n + 1)
        )

    cases = [(x, a, b) for a, b in [(1, 1), (3, 7), (40, 2), (500, 700), (9000, 1000)] for x in (0.01, 0.3, 0.41, 0.6, 0.9, 0.95)]
    from abtest_spark.functions.mathfn import beta_cdf

    df = spark.createDataFrame([(x, float(a), float(b)) for x, a, b in cases], "x double, a double, b double")
    got = df.select("x", "a", "b", beta_cdf(F.col("x"), F.col("a"), F.col("b")).alias("p")).collect()
    for r in got:
        assert r["p"] == pytest.approx(binomial_tail(r["x"], int(r["a"]), int(r["b"])), abs=1e-11)
    half = spark.createDataFrame([(0.5, 0.01, 0.01), (0.0, 2.0, 3.0), (1.0, 2.0, 3.0)], "x double, a double, b double")
    assert [r["p"] for r in half.select(beta_cdf(F.col("x"), F.col("a"), F.col("b")).alias("p")).collect()] == [pytest.approx(0.5), 0.0, 1.0]


def test_draws_are_seeded_quantiles(gold_df):
    gold = _gold(gold_df, [(30, 100), (20, 100)])
    d1 = B.posterior_draws(gold, n=2000, seed=5).cache()
    assert d1.exceptAll(B.posterior_draws(gold.repartition(3), n=2000, seed=5)).count() == 0
    assert d1.count() == 4000
    more = B.posterior_draws(gold, n=2500, seed=5)
    assert d1.exceptAll(more).count() == 0
    assert d1.select("theta").intersect(B.posterior_draws(gold, n=2000, seed=6).select("theta")).count() == 0
    exact = {r["variant_id"]: r for r in B.bayes_report(gold).collect()}
    for r in d1.groupBy("variant_id").agg(F.avg("theta").alias("m"), F.stddev("theta").alias("s")).collect():
        e = exact[r["variant_id"]]
        assert abs(r["m"] - e["mean"]) < 4 * e["sd"] / 2000**0.5 and abs(r["s"] - e["sd"]) < 4 * e["sd"] / 2000**0.5
        inside = d1.where((F.col("variant_id") == r["variant_id"]) & F.col("theta").between(e["hdi_low"], e["hdi_high"])).count()
        assert abs(inside / 2000 - 0.95) < 0.02


def test_bins_hold_the_posterior(gold_df):
    gold = _gold(gold_df, [(30, 100), (0, 100)])
    bins = B.posterior_bins(gold, bins=20).collect()
    assert len(bins) == 40
    draws = B.posterior_draws(gold, n=20000).collect()
    for v in ("1", "2"):
        mine = sorted((r for r in bins if r["variant_id"] == v), key=lambda r: r["bin"])
        theta = [d["theta"] for d in draws if d["variant_id"] == v]
        assert sum(r["mass"] for r in mine) == pytest.approx(1.0, abs=1e-12)
        for r in mine[1:-1]:
            n = sum(r["bin_low"] <= t < r["bin_high"] for t in theta)
            assert n / 20000 == pytest.approx(r["mass"], abs=0.01)


def test_hdi_matches_direct_computation(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.beta(3, 7, size=1000)
    df = spark.createDataFrame(
        [("e", "1", i, float(v)) for i, v in enumerate(x)], "experiment_name string, variant_id string, draw long, theta double"
    )
    r = B.hdi(df).first()
    s = np.sort(x)
    k = int(np.floor(0.95 * len(s)))
    widths = s[k:] - s[: len(s) - k]
    i = int(np.argmin(widths))
    assert (r["hdi_low"], r["hdi_high"]) == (s[i], s[i + k])


def test_comparison_interval_rule(spark):
    summary = spark.createDataFrame(
        [
            ("e", "1", 0.15, 0.1, 0.2),
            ("e", "2", 0.25, 0.2, 0.3),
            ("e", "3", 0.25, 0.21, 0.3),
        ],
        "experiment_name string, variant_id string, mean double, hdi_low double, hdi_high double",
    )
    res = {r["variant"]: r["significant"] for r in B.bayes_comparison(summary).collect()}
    assert res == {"2": False, "3": True}
    res = {r["variant"]: r["significant"] for r in B.bayes_comparison(summary, control={"e": "3"}).collect()}
    assert res == {"1": True, "2": False}


def test_variant_code(gold_df):
    gold = gold_df([(D1, "e", "b", 1, 0), (D1, "e", "a", 1, 0), (D1, "e", None, 1, 0)])
    codes = {r["variant_id"]: r["variant_code"] for r in B.variant_code(gold).collect()}
    assert codes == {"a": 0, "b": 1}


def test_histogram_counts(gold_df):
    gold = _gold(gold_df, [(30, 100), (20, 100)])
    draws = B.posterior_draws(gold, n=1000)
    hist = B.posterior_histogram(draws, bins=20)
    tot = {r["variant_id"]: r["n"] for r in hist.groupBy("variant_id").agg(F.sum("draws").alias("n")).collect()}
    assert tot == {"1": 1000, "2": 1000}
    assert hist.agg(F.max("bin")).first()[0] <= 20


def test_null_variant_rows_own_theta(gold_df):
    rows = [(D1, "e", "1", 100, 30), (D1, "e", "2", 100, 20), (D1, "e", None, 100, 90)]
    gold = gold_df(rows)
    dropped = {r["variant_id"]: r["mean"] for r in B.bayes_summary(gold).collect()}
    kept = {r["variant_id"]: r["mean"] for r in B.bayes_summary(gold, null_variants=True).collect()}
    assert set(dropped) == {"1", "2"} and set(kept) == {"1", "2", None}
    # the extra group shifts the shared (alpha, beta) posterior, hence the others' means
    assert kept["1"] != pytest.approx(dropped["1"], abs=1e-6)
    assert dropped == pytest.approx({"1": 0.2996340213, "2": 0.2065763926}, abs=2e-10)
    report = B.bayes_report(gold, null_variants=True).collect()
    assert {r["variant_id"] for r in report} == {"1", "2", None}
    assert all(r["hdi_low"] < r["mean"] < r["hdi_high"] for r in report)
    assert B.posterior_draws(gold, n=10, null_variants=True).where("variant_id is null").count() == 10
    comparison = B.bayes_comparison(B.bayes_report(gold, null_variants=True)).collect()
    assert {r["variant"] for r in comparison} == {"2"}


def test_partial_and_wrong_control_maps_keep_every_experiment(spark):
    rows = [(e, v, 0.1, 0.05 * int(v), 0.05 * int(v) + 0.04) for e in ("a", "b") for v in ("1", "2", "10")]
    summary = spark.createDataFrame(rows, "experiment_name string, variant_id string, mean double, hdi_low double, hdi_high double")

    def controls(given):
        got = B.bayes_comparison(summary, given).collect()
        assert len(got) == 4
        return {(r["experiment_name"], r["control"], r["control_found"]) for r in got}

    assert controls(None) == {("a", "1", True), ("b", "1", True)}
    assert controls({"a": "10"}) == {("a", "10", True), ("b", "1", True)}
    assert controls({"a": "9", "b": "2"}) == {("a", "1", False), ("b", "2", True)}


def test_smallest_id_is_numeric_for_whole_numbers(spark):
    rows = [("n", "10", 0.1, 0.0, 0.2), ("n", "2", 0.1, 0.0, 0.2), ("t", "10", 0.1, 0.0, 0.2), ("t", "b", 0.1, 0.0, 0.2)]
    summary = spark.createDataFrame(rows, "experiment_name string, variant_id string, mean double, hdi_low double, hdi_high double")
    assert {(r["experiment_name"], r["control"]) for r in B.bayes_comparison(summary).collect()} == {("n", "2"), ("t", "10")}
