"""Layer round trips, reruns (writing twice must succeed) and the entry
contract."""

import os
import tempfile

from abtest_spark.operators import gold as G
from abtest_spark.operators import quality as Q
from abtest_spark.plans.etl import run_pipeline
from abtest_spark.sources import layers as L
from abtest_spark.sources.raw import load_raw, read_raw

SF = "/root/testdata/sf0.001"


def test_etl_twice_and_matches_direct(spark):
    root = tempfile.mkdtemp(prefix="abtest-pipe-")
    raw = load_raw(spark, SF)
    run_pipeline(spark, raw, root)
    out = run_pipeline(spark, raw, root)  # rerun overwrites
    assert out["bronze"].count() == 1000
    assert out["silver"].count() == 2921
    direct_gold, direct_tunnel = G.gold_from_bronze(Q.deduplicate(raw))
    cols = direct_gold.columns
    assert out["gold_aggregated"].select(*cols).exceptAll(direct_gold).count() == 0
    assert direct_gold.exceptAll(out["gold_aggregated"].select(*cols)).count() == 0
    tcols = direct_tunnel.columns
    assert out["gold_tunnel"].select(*tcols).exceptAll(direct_tunnel).count() == 0
    assert os.path.isdir(os.path.join(root, "gold_aggregated"))


def test_partitioned_overwrite_keeps_other_days(spark, gold_df):
    import datetime as dt

    root = tempfile.mkdtemp(prefix="abtest-part-")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    L.write_layer(gold_df([(d1, "e", "1", 5, 1), (d2, "e", "1", 6, 2)]), root, "g", partition_by=["day"])
    L.write_layer(gold_df([(d2, "e", "1", 7, 3)]), root, "g", partition_by=["day"], dynamic=True)
    got = {r["day"]: r["users"] for r in L.read_layer(spark, root, "g").collect()}
    assert got == {d1: 5, d2: 7}
    L.write_layer(gold_df([(d2, "e", "1", 8, 3)]), root, "g", partition_by=["day"])  # the default replaces the layer
    assert [(r["day"], r["users"]) for r in L.read_layer(spark, root, "g").collect()] == [(d2, 8)]


def test_csv_source_and_export(spark, raw_df):
    root = tempfile.mkdtemp(prefix="abtest-csv-")
    rows = [(1, "2024-01-01 00:00:00", "BUY", 3, "MLA", "{a=1, b=2}"), (2, "not-a-time", "VIEW", None, "MLB", None)]
    L.export_csv(raw_df(rows), f"{root}/raw")
    back = read_raw(spark, f"{root}/raw")
    assert sorted(back.collect(), key=lambda r: r["user_id"]) == sorted(raw_df(rows).collect(), key=lambda r: r["user_id"])


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["day", "experiment_name", "variant_id", "users", "purchases"]
    assert df.count() == 209
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    from abtest_spark.plans.catalog import QUERIES

    assert set(QUERIES) <= set(o)


def test_analytics_job(spark):
    root = tempfile.mkdtemp(prefix="abtest-analytics-")
    run_pipeline(spark, load_raw(spark, SF), root)
    from abtest_spark.plans.etl import run_analytics

    out = run_analytics(spark, root)
    assert out["chi2_test"].count() == 60
    assert out["variant_count"].where("variant_count > 1").count() == 2
    assert out["bayes_report"].count() == 5
    assert out["bayes_comparison"].count() == 3
    assert out["experiment_results"].where("exp_name = 'checkout|button'").count() == 30


def test_etl_clustered_layout_same_content(spark):
    raw = load_raw(spark, SF)
    a = run_pipeline(spark, raw, tempfile.mkdtemp(prefix="abtest-pipe-a-"))
    b = run_pipeline(spark, raw, tempfile.mkdtemp(prefix="abtest-pipe-b-"), cluster=True)
    for name in ("bronze", "silver", "gold_tunnel"):
        x, y = a[name], b[name].select(*a[name].columns)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_sizing_conf():
    from abtest_spark.session import sizing_conf

    small = sizing_conf(10 * 1024**2, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = sizing_conf(100 * 1024**4, total_cores=8000)
    assert big["spark.sql.shuffle.partitions"] == "160000"  # capped at 20 waves
    mid = sizing_conf(1024**4, total_cores=8000)
    assert mid["spark.sql.shuffle.partitions"] == "16000"  # at least two waves


def test_command_line_job(spark, raw_df):
    from abtest_spark.plans.etl import main

    base = tempfile.mkdtemp(prefix="abtest-cli-")
    rows = [
        (1, "2024-01-01 10:00:00", "VIEW", 1, "MLA", "{e=1}"),
        (1, "2024-01-01 11:00:00", "BUY", 2, "MLA", "{e=1}"),
        (2, "2024-01-01 10:00:00", "VIEW", 3, "MLB", "{e=2}"),
        (2, "2024-01-01 10:00:00", "VIEW", 3, "MLB", "{e=2}"),
    ]
    L.export_csv(raw_df(rows), f"{base}/raw")
    main(["--raw", f"{base}/raw/*.csv", "--root", f"{base}/layers", "--analytics"])
    assert L.read_layer(spark, f"{base}/layers", "bronze").count() == 3
    gold = {r["variant_id"]: (r["users"], r["purchases"]) for r in L.read_layer(spark, f"{base}/layers", "gold_aggregated").collect()}
    assert gold == {"1": (1, 1), "2": (1, 0)}
    assert L.read_layer(spark, f"{base}/layers", "chi2_test").count() == 1


def test_readme_usage_snippet(spark):
    """The calls shown in the README, end to end."""
    from abtest_spark.operators import bayes, chi2, results
    from abtest_spark.plans.etl import run_pipeline as run
    from abtest_spark.sources import read_raw

    base = tempfile.mkdtemp(prefix="abtest-readme-")
    L.export_csv(load_raw(spark, SF), f"{base}/clicks")
    layers = run(spark, read_raw(spark, f"{base}/clicks/*.csv"), f"{base}/ab")
    gold = layers["gold_aggregated"]
    assert chi2.chi2_test(gold).count() == 60
    assert bayes.bayes_comparison(bayes.bayes_report(gold)).count() == 3
    requests_df = spark.createDataFrame([("checkout|button", "2024-01-05"), ("checkout|button", "2031-01-01")], "exp_name string, day string")
    answers = {r["day"]: r["status"] for r in results.lookup_results(results.experiment_results(gold), requests_df).collect()}
    assert answers == {"2024-01-05": 200, "2031-01-01": 404}


def test_etl_quality_report_observed_during_bronze_write(spark):
    from abtest_spark.operators import quality as Q

    raw = load_raw(spark, SF)
    out = run_pipeline(spark, raw, tempfile.mkdtemp(prefix="abtest-obs-"))
    got = {r["check"]: r["n"] for r in out["quality_report"].collect()}
    want = {r["check"]: r["n"] for r in Q.quality_report(raw).collect()}
    assert got == want and len(got) == 12
    assert got["bronze_rows"] == out["bronze"].count() == 1000


def test_quality_report_of_a_clustered_bronze(spark):
    from abtest_spark.operators import quality as Q
    from abtest_spark.plans.etl import build_bronze

    raw = load_raw(spark, SF)
    root = tempfile.mkdtemp(prefix="abtest-clu-")
    build_bronze(raw, root, cluster=True)
    got = {r["check"]: r["n"] for r in L.read_layer(spark, root, "quality_report").collect()}
    assert got == {r["check"]: r["n"] for r in Q.quality_report(raw).collect()}


def test_empty_and_undated_input(spark, raw_df):
    none = run_pipeline(spark, raw_df([]), tempfile.mkdtemp(prefix="abtest-none-"))
    assert {k: v.count() for k, v in none.items() if k != "quality_report"} == dict.fromkeys(
        ["bronze", "silver", "gold_aggregated", "gold_tunnel"], 0
    )
    assert all(r["n"] == 0 for r in none["quality_report"].collect())
    rows = [(1, "never", "BUY", 1, "MLA", "{a=1}"), (None, None, "VIEW", 1, "MLA", "{a=1}")]
    undated = run_pipeline(spark, raw_df(rows), tempfile.mkdtemp(prefix="abtest-und-"))
    assert [tuple(r) for r in undated["gold_aggregated"].collect()] == [(None, "a", "1", 1, 1)]
    assert undated["gold_aggregated"].schema["day"].dataType.simpleString() == "date"


def test_csv_is_bound_by_header_names(spark):
    import pathlib

    import pytest

    from abtest_spark.sources.raw import bad_values, read_raw_text

    root = pathlib.Path(tempfile.mkdtemp(prefix="abtest-head-"))
    one = root / "one.csv"
    one.write_text("event_name,item_id,timestamp,extra,site,experiments,user_id\nBUY,7,2021-08-01 10:00:00,z,MLA,\"{a=1, b=2}\",42\nVIEW,x,bad,,MLB,,u-42\n")
    got = [tuple(r) for r in read_raw(spark, str(one)).collect()]
    assert got == [(42, "2021-08-01 10:00:00", "BUY", 7, "MLA", "{a=1, b=2}"), (None, "bad", "VIEW", None, "MLB", None)]
    bad = {r["column"]: r["n"] for r in bad_values(read_raw_text(spark, str(one))).collect()}
    assert {k: n for k, n in bad.items() if n} == {"user_id": 1, "item_id": 1}
    (root / "two.csv").write_text("user_id,timestamp\n1,2\n")
    with pytest.raises(ValueError, match="event_name"):
        read_raw(spark, str(root / "two.csv"))
    both = root / "both"
    both.mkdir()
    (both / "a.csv").write_text(one.read_text())
    (both / "b.csv").write_text("user_id,timestamp,event_name,item_id,site,experiments,extra\n1,t,BUY,1,MLA,,\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(both)).collect()


def test_checkpoint_folder_must_be_set_off_a_local_master(monkeypatch):
    import pytest

    from abtest_spark.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
