"""Chi-square (FIXTURES F-4, semantics 9) and variant counts (semantics 8)."""

import datetime as dt
import itertools
import math

import pytest

from abtest_spark.functions.mathfn import chi2_sf_numpy
from abtest_spark.operators import chi2 as C
from abtest_spark.operators import conversion as CV

D1 = dt.date(2024, 1, 1)


def _test(gold_df, rows, yates=True):
    return C.chi2_test(gold_df(rows), yates=yates).collect()


def test_worked_table_with_yates(gold_df):
    rows = [(D1, "e", "A", 100, 30), (D1, "e", "B", 100, 20)]
    (r,) = _test(gold_df, rows)
    assert r["chi2_statistic"] == pytest.approx(2.16, abs=1e-9)
    assert r["dof"] == 1
    assert r["p_value"] == pytest.approx(0.1416446902951367, abs=1e-9)
    assert not r["reject_h0"]
    assert r["conclusion"].startswith("Se acepta")


def test_worked_table_without_yates(gold_df):
    rows = [(D1, "e", "A", 100, 30), (D1, "e", "B", 100, 20)]
    (r,) = _test(gold_df, rows, yates=False)
    assert r["chi2_statistic"] == pytest.approx(2.6666666667, abs=1e-9)
    assert r["p_value"] == pytest.approx(0.10247043485974947, abs=1e-9)


def test_single_variant_day_dof0(gold_df):
    rows = [
        (D1, "e", "A", 100, 30),
        (D1 + dt.timedelta(days=1), "e", "A", 100, 30),
        (D1 + dt.timedelta(days=1), "e", "B", 100, 20),
    ]
    res = {r["day"]: r for r in _test(gold_df, rows)}
    assert res[D1]["chi2_statistic"] == 0 and res[D1]["dof"] == 0 and res[D1]["p_value"] == 1.0


@pytest.mark.parametrize(
    "rows,reason",
    [
        ([(D1, "e", "A", 100, 0), (D1, "e", "B", 100, 0)], "zero column total"),
        ([(D1, "e", "A", 100, 100), (D1, "e", "B", 100, 100)], "zero column total"),
        ([(D1, "e", "A", 100, 30), (D1, "e", "B", 100, 20), (D1, "e", None, 5, 1)], "null variant"),
    ],
)
def test_skipped_groups(gold_df, rows, reason):
    assert _test(gold_df, rows) == []
    (s,) = C.chi2_skipped(gold_df(rows)).collect()
    assert s["reason"] == reason


def test_null_day_excluded(gold_df):
    rows = [(None, "e", "A", 100, 30), (None, "e", "B", 100, 20)]
    assert _test(gold_df, rows) == []
    assert C.chi2_skipped(gold_df(rows)).count() == 0


def test_three_variants_permutation_invariant(gold_df):
    base = [("A", 120, 31), ("B", 90, 40), ("C", 200, 52)]
    stats = set()
    for perm in itertools.permutations(base):
        rows = [(D1, "e", v, u, p) for v, u, p in perm]
        (r,) = _test(gold_df, rows)
        assert r["dof"] == 2
        stats.add((round(r["chi2_statistic"], 9), round(r["p_value"], 9)))
    assert len(stats) == 1
    (stat, p), = stats
    assert p == pytest.approx(math.exp(-stat / 2), abs=1e-9)  # dof 2 closed form


def test_chi2_sf_against_series():
    # upper tail via the incomplete-gamma series, as in the oracle SQL
    def series(stat, k):
        x, a = stat / 2, k / 2
        return 1 - sum(math.exp((a + n) * math.log(x) - x - math.lgamma(a + n + 1)) for n in range(400))

    for k in (1, 2, 3, 4, 5, 7):
        for stat in (0.3, 1.0, 2.16, 5.5, 12.0, 40.0):
            assert chi2_sf_numpy([stat], [k])[0] == pytest.approx(series(stat, k), abs=1e-12)


def test_variant_count_rules(gold_df):
    rows = [
        (D1, "multi", "1", 10, 1),
        (D1, "multi", "2", 10, 1),
        (D1, "solo", "1", 10, 1),
        (D1, "nulls", None, 10, 1),
    ]
    vc = {r["experiment_name"]: r["variant_count"] for r in CV.variant_count(gold_df(rows)).collect()}
    assert vc == {"multi": 2, "solo": 1, "nulls": 0}
    assert [r["experiment_name"] for r in CV.single_variant_experiments(gold_df(rows)).collect()] == ["solo"]
    assert {r["experiment_name"] for r in CV.multi_variant(gold_df(rows)).collect()} == {"multi"}


def test_conversion_rate_zero_users(gold_df):
    rows = [(D1, "e", "1", 0, 0), (D1, "e", "2", 4, 1)]
    rates = {r["variant_id"]: r["conversion_rate"] for r in CV.with_conversion_rate(gold_df(rows)).collect()}
    assert rates == {"1": None, "2": 0.25}
    ranked = [r["variant_id"] for r in CV.conversion_ranking(gold_df(rows)).collect()]
    assert ranked == ["2", "1"]


def test_chi2_sf_column_matches_closed_form(spark):
    from pyspark.sql import functions as F

    from abtest_spark.functions.mathfn import chi2_sf

    cases = [(s, k) for k in (1, 2, 3, 4, 5, 8, 11, 40) for s in (0.0, 1e-6, 0.3, 1.0, 2.16, 5.5, 12.0, 40.0, 120.0)]
    df = spark.createDataFrame(cases, "stat double, dof int")
    got = df.select("stat", "dof", chi2_sf(F.col("stat"), F.col("dof")).alias("p")).collect()
    for r in got:
        want = chi2_sf_numpy([r["stat"]], [r["dof"]])[0]
        assert r["p"] == pytest.approx(want, rel=1e-9, abs=1e-13), (r["stat"], r["dof"])


def _numpy_chi2(table, yates=True):
    import numpy as np

    obs = np.asarray(table, dtype=float)
    expected = obs.sum(axis=1, keepdims=True) * obs.sum(axis=0, keepdims=True) / obs.sum()
    dof = obs.shape[0] - 1
    if dof == 0:
        return 0.0, 0, 1.0
    if dof == 1 and yates:
        diff = expected - obs
        obs = obs + np.minimum(0.5, np.abs(diff)) * np.sign(diff)
    stat = float(((obs - expected) ** 2 / expected).sum())
    return stat, dof, float(chi2_sf_numpy([stat], [dof])[0])


def test_random_tables_against_numpy(gold_df):
    import random

    rng = random.Random(23)
    rows, tables = [], {}
    for g in range(40):
        day = D1 + dt.timedelta(days=g)
        k = rng.randint(1, 5)
        t = []
        for v in range(k):
            users = rng.randint(20, 3000)
            purchases = rng.randint(1, users - 1)
            rows.append((day, "e", str(v), users, purchases))
            t.append([purchases, users - purchases])
        tables[day] = t
    rows.append((D1, "other", "1", 5, 1))  # makes "e" and "other" both present; "other" is single-variant overall
    got = {r["day"]: r for r in C.chi2_test(gold_df(rows)).collect() if r["experiment_name"] == "e"}
    assert len(got) == 40
    for day, t in tables.items():
        stat, dof, p = _numpy_chi2(t)
        assert got[day]["dof"] == dof
        assert got[day]["chi2_statistic"] == pytest.approx(stat, abs=1e-8)
        assert got[day]["p_value"] == pytest.approx(p, abs=1e-8)


def test_skip_rules_random(gold_df):
    import random

    rng = random.Random(37)
    rows, expect_tested, expect_skipped = [], set(), {}
    for g in range(60):
        day = D1 + dt.timedelta(days=g)
        kind = rng.choice(["ok", "zero_col_all_buy", "zero_col_none", "zero_row", "null_variant", "undated"])
        day_key = None if kind == "undated" else day
        table = []
        for v in range(rng.randint(2, 4)):
            users = rng.randint(5, 50)
            purchases = rng.randint(1, users - 1)
            if kind == "zero_col_all_buy":
                purchases = users
            if kind == "zero_col_none":
                purchases = 0
            if kind == "zero_row" and v == 0:
                users, purchases = 0, 0
            table.append((str(v), users, purchases))
        if kind == "null_variant":
            table.append((None, 3, 1))
        for vid, users, purchases in table:
            rows.append((day_key, "e", vid, users, purchases))
        if kind == "undated":
            continue
        if kind == "ok":
            expect_tested.add(day)
        else:
            expect_skipped[day] = {
                "zero_col_all_buy": "zero column total",
                "zero_col_none": "zero column total",
                "zero_row": "zero row total",
                "null_variant": "null variant",
            }[kind]
    gold = gold_df(rows)
    assert {r["day"] for r in C.chi2_test(gold).collect()} == expect_tested
    assert {r["day"]: r["reason"] for r in C.chi2_skipped(gold).collect()} == expect_skipped


def test_conversion_family_random(gold_df):
    import random

    rng = random.Random(47)
    rows = []
    for e in range(6):
        variants = rng.sample(["a", "b", "c", None], rng.randint(1, 3))
        for d in range(3):
            for v in variants:
                users = rng.randint(0, 20)
                rows.append((D1 + dt.timedelta(days=d), f"x{e}", v, users, rng.randint(0, users)))
    gold = gold_df(rows)
    counts = {}
    for _, e, v, _, _ in rows:
        counts.setdefault(e, set())
        if v is not None:
            counts[e].add(v)
    want_vc = {e: len(vs) for e, vs in counts.items()}
    assert {r["experiment_name"]: r["variant_count"] for r in CV.variant_count(gold).collect()} == want_vc
    ordered = [r["variant_count"] for r in CV.variant_count(gold, ordered=True).collect()]
    assert ordered == sorted(ordered, reverse=True)
    assert {r["experiment_name"] for r in CV.single_variant_experiments(gold).collect()} == {
        e for e, n in want_vc.items() if n == 1
    }
    multi = {e for e, n in want_vc.items() if n > 1}
    assert {r["experiment_name"] for r in CV.multi_variant(gold).collect()} == multi
    ranked = CV.conversion_ranking(gold).collect()
    assert len(ranked) == sum(1 for r in rows if r[1] in multi)
    rates = [r["conversion_rate"] for r in ranked]
    known = [x for x in rates if x is not None]
    assert known == sorted(known, reverse=True) and rates[: len(known)] == known  # NULL rates last
    for r in ranked:
        assert r["conversion_rate"] == (None if r["users"] == 0 else r["purchases"] / r["users"])


def test_tail_is_not_rounded_and_holds_at_many_degrees(spark):
    from pyspark.sql import functions as F

    from abtest_spark.functions.mathfn import chi2_sf, chi2_sf_numpy

    cases = [(60.0, 1), (200.0, 4), (2000.0, 2000), (20000.0, 20000), (20300.0, 20000), (19000.0, 20000), (9999.0, 10001)]
    df = spark.createDataFrame(cases, "s double, k int")
    got = [r[0] for r in df.select(chi2_sf(F.col("s"), F.col("k"))).collect()]
    want = chi2_sf_numpy(*zip(*cases, strict=True))
    assert 0 < got[0] < 1e-12
    for g, w in zip(got, want, strict=True):
        assert abs(g - w) <= 1e-9 * max(w, 1e-30) + 1e-12 * (w > 1e-3)


def test_library_keeps_small_p_values(gold_df):
    import datetime as dt

    d = dt.date(2024, 1, 1)
    row = C.chi2_test(gold_df([(d, "e", "1", 1000, 100), (d, "e", "2", 1000, 500)])).first()
    assert 0 < row["p_value"] < 1e-12
