"""Result documents and lookups (FIXTURES F-6, semantics 12-13)."""

import datetime as dt
import json

from abtest_spark.operators import results as R

D = dt.date(2021, 8, 1)


def test_sample_document(gold_df, spark):
    gold = gold_df(
        [
            (D, "shop/tiles", "1", 1500, 1500),
            (D, "shop/tiles", "2", 1200, 1200),
            (D, "shop/tiles", "3", 800, 800),
        ]
    )
    res = R.experiment_results(gold)
    doc = json.loads(R.result_json(res).first()["json"])
    assert doc == {
        "results": {
            "exp_name": "shop|tiles",
            "day": "2021-08-01",
            "number_of_participants": 3500,
            "winner": 1,
            "variants": [
                {"id": 1, "number_of_purchases": 1500},
                {"id": 2, "number_of_purchases": 1200},
                {"id": 3, "number_of_purchases": 800},
            ],
        }
    }
    req = spark.createDataFrame([("shop|tiles", "2021-08-01"), ("shop|tiles", "2024-08-01")], "exp_name string, day string")
    out = {r["day"]: r for r in R.lookup_results(res, req).collect()}
    assert out["2021-08-01"]["found"] and out["2021-08-01"]["winner"] == "1"
    assert out["2024-08-01"]["detail"] == "No data found for experiment 'shop|tiles' on day '2024-08-01'"
    assert out["2021-08-01"]["status"] == 200 and json.loads(out["2021-08-01"]["response"]) == doc
    assert out["2024-08-01"]["status"] == 404
    assert json.loads(out["2024-08-01"]["response"]) == {
        "detail": "No data found for experiment 'shop|tiles' on day '2024-08-01'"
    }


def test_winner_tie_goes_to_smallest_id(gold_df):
    gold = gold_df([(D, "e", "2", 10, 5), (D, "e", "1", 10, 5), (D, "e", "3", 10, 4)])
    (w,) = R.winners(gold).collect()
    assert w["winner"] == "1" and w["winner_purchases"] == 5


def test_ids_by_value_and_as_text(gold_df):
    gold = gold_df(
        [(D, "n", "10", 9, 5), (D, "n", "2", 9, 5), (D, "m", "10", 9, 1), (D, "m", "b", 9, 5), (D, "m", "02", 9, 5)]
    )
    docs = {r["exp_name"]: json.loads(r["json"])["results"] for r in R.result_json(R.experiment_results(gold)).collect()}
    assert docs["n"]["winner"] == 2 and [v["id"] for v in docs["n"]["variants"]] == [2, 10]
    assert docs["m"]["winner"] == "02" and [v["id"] for v in docs["m"]["variants"]] == ["10", "02", "b"]
    assert {w["experiment_name"]: w["winner"] for w in R.winners(gold).collect()} == {"n": "2", "m": "02"}


def test_calendar_requests_include_day_after(gold_df):
    gold = gold_df([(D, "e", "1", 1, 0), (D + dt.timedelta(days=2), "e", "1", 1, 0)])
    days = sorted(r["day"] for r in R.calendar_requests(gold).collect())
    assert days == ["2021-08-01", "2021-08-02", "2021-08-03", "2021-08-04"]
    found = {r["day"]: r["found"] for r in R.lookup_results(R.experiment_results(gold), R.calendar_requests(gold)).collect()}
    assert found == {"2021-08-01": True, "2021-08-02": False, "2021-08-03": True, "2021-08-04": False}


def test_filters_and_partition_pruning(spark, gold_df):
    import contextlib
    import io
    import tempfile

    from abtest_spark.operators import conversion as CV
    from abtest_spark.sources import layers as L

    d2 = D + dt.timedelta(days=1)
    gold = gold_df([(D, "a/b", "1", 5, 1), (D, "a/b", None, 3, 0), (d2, "a/b", "1", 4, 2), (D, "c", "1", 1, 1)])
    root = tempfile.mkdtemp(prefix="abtest-filter-")
    L.write_layer(gold, root, "gold_aggregated", partition_by=["day"])
    layer = L.read_layer(spark, root, "gold_aggregated")
    hit = CV.experiment_day_filter(layer, "a/b", "2021-08-02")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        hit.explain("formatted")
    assert "PartitionFilters: [isnotnull(day" in buf.getvalue()
    assert [(r["variant_id"], r["users"]) for r in hit.collect()] == [("1", 4)]
    assert CV.variant_filter(gold, None).count() == 0
    assert CV.experiment_filter(gold, "c").count() == 1
    assert CV.has_rows(gold) and not CV.has_rows(CV.experiment_filter(gold, "zzz"))


def test_results_random_with_ties(gold_df):
    import random

    rng = random.Random(41)
    rows = []
    for g in range(30):
        day = D + dt.timedelta(days=g % 10)
        exp = f"exp/{g // 10}"
        for v in rng.sample(["1", "2", "3", "10"], rng.randint(1, 4)):
            rows.append((day, exp, v, rng.randint(1, 9), rng.randint(0, 3)))  # many ties
    rows.append((None, "exp/0", "1", 5, 5))
    rows.append((D, "exp/0", None, 5, 5))
    want = {}
    for day, exp, v, users, purchases in rows:
        if day is None or v is None:
            continue
        want.setdefault((exp.replace("/", "|"), day), []).append((v, users, purchases))
    got = {(r["exp_name"], r["day"]): r for r in R.experiment_results(gold_df(rows)).collect()}
    assert set(got) == set(want)
    for key, vs in want.items():
        r = got[key]
        assert r["number_of_participants"] == sum(u for _, u, _ in vs)
        best = min(vs, key=lambda t: (-t[2], int(t[0])))
        assert r["winner"] == best[0]
        assert [(x["id"], x["number_of_purchases"]) for x in r["variants"]] == sorted(((v, p) for v, _, p in vs), key=lambda t: int(t[0]))
