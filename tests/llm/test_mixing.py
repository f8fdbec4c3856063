import duckdb
import pytest
from pyspark.sql import functions as F

from abtest_spark.llm.mixing import leaf_budgets, mix

DOCS = "doc_id long, text string, lang string, source string, __tokens string, __row int"


def blend(df, weights, fraction, epochs, seed):
    return mix(df, {"lang": F.col("lang"), "source": F.col("source")}, weights, fraction, epochs, seed)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, k, s, "x", 1) for i, t, k, s in rows], DOCS)


def budgets(spark, leaves, weights, fraction, epochs):
    df = spark.createDataFrame([(*p, t) for p, t in leaves.items()], "a string, b string, tokens long")
    got = leaf_budgets(df, ["a", "b"], weights, fraction, epochs).collect()
    return {(r.a, r.b): r.budget for r in got}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = {("x", "1"): 100, ("x", "2"): 1000, ("y", "1"): 2000}
    # x and y get 1000 each, x1 can give 100 only: x2 takes the rest, y is untouched
    assert budgets(spark, leaves, {}, 2000 / 3100, 1) == {("x", "1"): 100, ("x", "2"): 900, ("y", "1"): 1000}
    # all of x is short by 400: now y takes it
    assert budgets(spark, leaves, {("x",): 3}, 2000 / 3100, 1) == {("x", "1"): 100, ("x", "2"): 1000, ("y", "1"): 900}


def test_weights_epochs_and_zero_weight(spark):
    leaves = {("x", "1"): 100, ("x", "2"): 100, ("y", "1"): 100}
    assert budgets(spark, leaves, {("x", "1"): 3}, 0.8, 2) == {("x", "1"): 90, ("x", "2"): 30, ("y", "1"): 120}
    assert budgets(spark, leaves, {("y",): 0}, 1.0, 1) == {("x", "1"): 100, ("x", "2"): 100, ("y", "1"): 0}
    assert budgets(spark, leaves, {}, 9.0, 2) == {p: 200 for p in leaves}


def test_prefix_is_the_seeded_order(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "s") for i in range(200)]
    total = sum(1 + i % 7 for i in range(200))
    df = frame(spark, rows)
    small, large = (blend(df, {}, f, 1, 5) for f in (0.2, 0.5))
    a, b = ({r.doc_id for r in x.collect()} for x in (small, large))
    assert a < b and 0.2 * total - 7 <= sum(1 + i % 7 for i in a) <= 0.2 * total
    assert {r.doc_id for r in blend(df, {}, 0.2, 1, 6).collect()} != a
    twice = blend(df, {}, 1.5, 2, 5).groupBy("doc_id").count().collect()
    assert len(twice) == 200 and {r["count"] for r in twice} == {1, 2}


def test_nulls_repeats_clashing_columns_and_empty(spark):
    rows = [(1, "a b", "en", None), (1, "a b", "en", None), (None, "c", None, "s"), (2, None, "en", "s"), (3, "", "en", "s")]
    df = frame(spark, rows)
    out = blend(df, {}, 1.0, 1, 1)
    assert out.columns == ["doc_id", "text", "lang", "source", "__row", "__epoch", "__tokens", "__path"]
    got = sorted(((r.doc_id, r.text, r.lang, r.source, r["__epoch"]) for r in out.collect()), key=str)
    assert got == sorted([(*r, 1) for r in rows[:3]], key=str)  # a leaf without tokens has no budget
    assert blend(df.limit(0), {}, 1.0, 1, 1).count() == 0


@pytest.mark.parametrize("d", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, d):
    from abtest_spark.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    got = QUERIES["op5_mixture"](spark, d)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op5_mixture']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
