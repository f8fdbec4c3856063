"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads ``{sf_dir}/events.parquet`` through ``raw_from_events`` and
runs the whole chain on all rows: no sampling, no id subsets, no row caps
(``top_conversion`` is a top-10 report, the limit is its feature).

Oracle SQL restates each query's semantics in plain SQL on the same parquet
(tables pre-registered as views by the checker). Doubles that come out of
different floating-point paths are rounded identically on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abtest_spark import schema as S
from abtest_spark.operators import bayes as B
from abtest_spark.operators import chi2 as C
from abtest_spark.operators import conversion as CV
from abtest_spark.operators import gold as G
from abtest_spark.operators import ordering as O
from abtest_spark.operators import quality as Q
from abtest_spark.operators import results as R
from abtest_spark.operators import sessions as SE
from abtest_spark.operators import silver as SV
from abtest_spark.operators import sketches as K
from abtest_spark.session import checkpoint_dir
from abtest_spark.sources import layers as L
from abtest_spark.functions.columns import parsed_ts
from abtest_spark.sources.raw import load_raw, read_table

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_raw(spark, sf_dir)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.deduplicate(_raw(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Gold ignores exact duplicates, so it reads the raw stream directly.
    return G.gold_aggregated_from_events(_raw(spark, sf_dir))


def _tunnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gold_tunnel_from_events(_raw(spark, sf_dir))


def _gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold materialised once for the analytics built on it.

    In production the analytics read the written gold layer; here the layer
    is stood in for by a reliable checkpoint in the shared checkpoint folder,
    so queries that read gold several times (semi joins, totals, grids) do not
    recompute it from the raw stream, and a lost executor does not either.
    """
    checkpoint_dir(spark)
    return _gold(spark, sf_dir).checkpoint(eager=True)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SV.to_silver(_bronze(spark, sf_dir))


def _scratch_root(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint location."""
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for the write/read queries")
    return f"{base.rstrip('/')}/layers-{uuid.uuid4().hex}"


def q_write_read_bronze(spark, sf_dir):
    """Bronze written sorted by (user, time) (range-clustered, the ordered
    sink) and read back. Reruns overwrite; see tests/test_etl.py."""
    root = _scratch_root(spark)
    L.write_layer(_bronze(spark, sf_dir), root, "bronze", cluster_by=["user_id", "timestamp"], sort_by=["user_id", "timestamp"])
    return L.read_layer(spark, root, "bronze")


def q_write_read_gold(spark, sf_dir):
    root = _scratch_root(spark)
    L.write_layer(_gold(spark, sf_dir), root, "gold_aggregated", partition_by=["day"])
    return L.read_layer(spark, root, "gold_aggregated")


def q_user_journey(spark, sf_dir):
    """Per-user journey summary over silver (every user)."""
    silver = _silver(spark, sf_dir)
    return silver.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("event_name") == S.BUY_EVENT).alias("buy_rows"),
        F.count_if(F.col("flag_purchase")).alias("flagged_rows"),
        F.count_distinct(F.to_date("timestamp")).alias("active_days"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.max(F.when(F.col("event_name") == S.BUY_EVENT, F.col("timestamp"))).alias("last_buy_ts"),
    )


def q_buy_group(spark, sf_dir):
    return SV.buy_groups(_bronze(spark, sf_dir)).select(
        "user_id", "timestamp", "event_name", "item_id", "site", "experiments", "event_rank", "buy_group", "flag_purchase"
    )


def q_chi2_expected(spark, sf_dir):
    return C.chi2_expected(_gold_table(spark, sf_dir)).select(
        "experiment_name",
        "day",
        "variant_id",
        "dof",
        "cell",
        "observed",
        F.round("expected", 9).alias("expected"),
        F.round("contribution", 9).alias("contribution"),
    )


def q_bayes_grid_weights(spark, sf_dir):
    totals = B.variant_totals(_gold_table(spark, sf_dir))
    w = B.posterior_weights(totals)
    return w.select("experiment_name", "grid_id", F.round("weight", 9).alias("weight"))


def _places(df: DataFrame, **places: int) -> DataFrame:
    """Computed doubles at so many decimals, for comparison with SQL."""
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def q_bayes_draws(spark, sf_dir):
    return _places(B.posterior_draws(_gold_table(spark, sf_dir)), theta=6)


def q_bayes_hdi(spark, sf_dir):
    return _places(B.bayes_hdi(_gold_table(spark, sf_dir)), hdi_low=6, hdi_high=6)


def q_bayes_hdi_mass(spark, sf_dir):
    """Probability inside each 95 % interval, by incomplete beta functions instead of the curve the interval came from."""
    gold = _gold_table(spark, sf_dir)
    return _places(B.interval_mass(gold, B.bayes_hdi(gold)), mass=6)


def q_bayes_comparison(spark, sf_dir):
    found = B.bayes_comparison(B.bayes_report(_gold_table(spark, sf_dir)))
    ends = ("control_hdi_low", "control_hdi_high", "test_hdi_low", "test_hdi_high")
    return _places(found, control_mean=9, test_mean=9, **dict.fromkeys(ends, 6))


def q_posterior_histogram(spark, sf_dir):
    return _places(B.posterior_bins(_gold_table(spark, sf_dir)), bin_low=6, bin_high=6, mass=6)


def q_daily_rate_hdi(spark, sf_dir):
    """95 % highest-density interval of each variant's daily conversion rates."""
    return B.hdi(CV.daily_rates(_gold_table(spark, sf_dir)))


def q_daily_rate_comparison(spark, sf_dir):
    """Each variant against its experiment's control (smallest id) on the
    daily-rate intervals; means are the mean daily rates."""
    gold = _gold_table(spark, sf_dir)
    rates = CV.daily_rates(gold)
    means = rates.groupBy("experiment_name", "variant_id").agg(F.round(F.avg("theta"), 9).alias("mean"))
    summary = means.join(B.hdi(rates), ["experiment_name", "variant_id"])
    return B.bayes_comparison(summary)


def q_experiment_result_lookup(spark, sf_dir):
    gold = _gold_table(spark, sf_dir)
    return R.lookup_results(R.experiment_results(gold), R.calendar_requests(gold))


def q_csv_roundtrip(spark, sf_dir):
    """Raw stream exported as headed CSV, then scanned with the declared
    schema (the production source)."""
    from abtest_spark.sources.raw import read_raw

    root = _scratch_root(spark)
    L.export_csv(_raw(spark, sf_dir), f"{root}/raw_csv")
    return read_raw(spark, f"{root}/raw_csv")


def q_layers_tunnel(spark, sf_dir):
    """All four layers written by the ETL job; gold_tunnel read back."""
    from abtest_spark.plans.etl import run_pipeline

    return run_pipeline(spark, _raw(spark, sf_dir), _scratch_root(spark))["gold_tunnel"]


def q_stream_gold(spark, sf_dir):
    """Gold built incrementally by the streaming job: raw rows arrive as two
    file drops (events up to the 15th plus untimed ones, then the rest), each
    processed by an available-now trigger. Late BUYs in the second drop flag
    earlier days."""
    from abtest_spark.streaming.gold_stream import start_gold_stream

    root = _scratch_root(spark)
    raw = _raw(spark, sf_dir)
    late = F.to_date(F.col("timestamp").try_cast("timestamp_ntz")) > F.lit("2024-01-15").cast("date")
    drops = [raw.where(~F.coalesce(late, F.lit(False))), raw.where(F.coalesce(late, F.lit(False)))]
    for i, part in enumerate(drops):
        part.write.mode("overwrite").parquet(f"{root}/src/drop={i}")
        q = start_gold_stream(spark, f"{root}/src/drop=*", f"{root}/out", fmt="parquet")
        q.awaitTermination()
    return L.read_layer(spark, f"{root}/out", "gold_aggregated")


def _gold_uncut_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold under the uncut marker (every purchase a BUY): most users
    convert, so many experiment-days have a zero non-conversion total and
    cannot be tested."""
    checkpoint_dir(spark)
    return G.gold_aggregated_from_events(load_raw(spark, sf_dir, buy_min_value=0.0)).checkpoint(eager=True)


def q_quality_report(spark, sf_dir):
    return Q.quality_report(_raw(spark, sf_dir))


def _rounded(test: DataFrame) -> DataFrame:
    """The chi-square test at nine decimals, for comparison with SQL."""
    return test.withColumns({c: F.round(c, 9) for c in ("chi2_statistic", "p_value")})


def _summary_rounded(summary: DataFrame) -> DataFrame:
    return summary.withColumns({"mean": F.round("mean", 9), "sd": F.round("sd", 7)})


def q_bayes_many(spark, sf_dir):
    """Summary of an experiment with a hundred variants: every event is in
    variant user_id % 100, a purchase event converts."""
    e = read_table(spark, sf_dir, "events")
    gold = e.groupBy((F.col("user_id") % 100).cast("string").alias("variant_id")).agg(
        F.count(F.lit(1)).alias("users"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )
    gold = gold.withColumn("day", F.lit(None).cast("date")).withColumn("experiment_name", F.lit("hundred"))
    return _summary_rounded(B.bayes_summary(gold))


def q_bayes_draws_check(spark, sf_dir):
    """Number, mean and sd of the draws, and how many are inside the exact interval."""
    gold = _gold_table(spark, sf_dir)
    key = ["experiment_name", "variant_id"]
    inside = F.col("theta").between(F.col("hdi_low"), F.col("hdi_high"))
    found = B.posterior_draws(gold).join(B.bayes_hdi(gold), key).groupBy(*key).agg(
        F.count(F.lit(1)).alias("draws"),
        F.avg("theta").alias("mean"),
        F.stddev("theta").alias("sd"),
        F.count_if(inside).alias("inside"),
    )
    return _places(found, mean=6, sd=6)


def q_bayes_comparison_means(spark, sf_dir):
    """The comparison's pairs and exact means, with a given control in one experiment."""
    none = F.lit(None).cast("double")
    summary = B.bayes_summary(_gold_table(spark, sf_dir)).withColumns({"hdi_low": none, "hdi_high": none})
    pairs = B.bayes_comparison(summary, {"search/ranking": "2", "no/such": "1"})
    return pairs.select(
        "experiment_name",
        "variant",
        "control",
        F.round("control_mean", 9).alias("control_mean"),
        F.round("test_mean", 9).alias("test_mean"),
        "control_found",
    )


def q_csv_reordered(spark, sf_dir):
    """Raw stream exported with other columns around and in another order, then
    scanned: columns are bound by the header's names."""
    from abtest_spark.sources.raw import read_raw

    path = f"{_scratch_root(spark)}/csv"
    out = _raw(spark, sf_dir).withColumn("note", F.lit("x, y"))
    L.export_csv(out.select("event_name", "note", "item_id", "experiments", "timestamp", "site", "user_id"), path)
    return read_raw(spark, path)


def q_csv_bad_values(spark, sf_dir):
    """Values that do not fit the declared types: every 7th user id is written as text."""
    from abtest_spark.sources.raw import bad_values, read_raw_text

    path = f"{_scratch_root(spark)}/csv"
    raw = _raw(spark, sf_dir)
    user = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("u-"), F.col("user_id"))).otherwise(F.col("user_id").cast("string"))
    L.export_csv(raw.withColumn("user_id", user), path)
    return bad_values(read_raw_text(spark, path))


def q_rerun_gold(spark, sf_dir):
    """The gold layer written for all days and then again, to the same root, from
    the events before the 15th: the second write replaces the first."""
    root = _scratch_root(spark)
    raw = _raw(spark, sf_dir)
    early = raw.where(parsed_ts("timestamp") < F.lit("2024-01-15").cast("timestamp_ntz"))
    for part in (raw, early):
        L.write_layer(G.gold_aggregated_from_events(part), root, "gold_aggregated", partition_by=["day"])
    return L.read_layer(spark, root, "gold_aggregated")


def q_offset_timestamps(spark, sf_dir):
    """Per day (UTC) of timestamps with offsets: events, flagged events; invalid ones have no day.

    Every 3rd event's text gets -05:00, every other 5th +09:30, every other 7th
    keeps only its time of day.
    """
    e = read_table(spark, sf_dir, "events")
    i, text = F.col("event_id"), F.col("ts").cast("string")
    ts = (
        F.when(i % 3 == 0, F.concat(text, F.lit("-05:00")))
        .when(i % 5 == 0, F.concat(text, F.lit("+09:30")))
        .when(i % 7 == 0, F.date_format("ts", "HH:mm:ss"))
        .otherwise(text)
    )
    event = F.when((F.col("event_type") == "purchase") & (F.col("value") > 80), F.lit("BUY")).otherwise(F.upper("event_type"))
    rows = e.select(
        "user_id", ts.alias("timestamp"), event.alias("event_name"), i.alias("item_id"), F.lit("s").alias("site"), F.lit("{}").alias("experiments")
    )
    flagged = SV.flag_purchases(rows)
    return flagged.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if("flag_purchase").alias("flagged")
    )


def q_quality_layer(spark, sf_dir):
    """The quality report that the ETL job stores beside a clustered bronze layer."""
    from abtest_spark.plans.etl import build_bronze

    root = _scratch_root(spark)
    build_bronze(_raw(spark, sf_dir), root, cluster=True)
    return L.read_layer(spark, root, "quality_report")


def q_journey(spark, sf_dir):
    """Every user's events in time order, with purchase group and flag."""
    return SV.journeys(_bronze(spark, sf_dir))


def q_emptiness(spark, sf_dir):
    """Which lookups have rows: each experiment's share of the funnel, and an experiment that does not exist."""
    tunnel = _tunnel(spark, sf_dir)
    return CV.presence(tunnel, ["checkout/button", "search/ranking", "no/such"])


def q_users_rollup(spark, sf_dir):
    """Distinct users and buyers of each variant over all days, from the stored daily sketches."""
    return K.rollup_users(_sketch_layer(spark, sf_dir))


def _sketch_layer(spark, sf_dir):
    root = _scratch_root(spark)
    L.write_layer(K.gold_sketches(_silver(spark, sf_dir)), root, "gold_sketches", partition_by=["day"])
    return L.read_layer(spark, root, "gold_sketches")


def q_silver_bucketed(spark, sf_dir):
    """Silver from a bronze table bucketed by user: the events meet their users' statistics without a shuffle."""
    root, buckets = _scratch_root(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bronze_{uuid.uuid4().hex}"
    table = L.write_bucketed(_bronze(spark, sf_dir), root, "bronze", name, buckets, sort_by=["user_id", "timestamp"])
    flagged = SV.flag_purchases_bucketed(table, L.read_layer(spark, root, "bronze"), buckets)
    return SV.explode_experiments(flagged).select(*S.SILVER_COLUMNS)


def q_quality_batches(spark, sf_dir):
    """The quality report of three drops, the last of which delivers every fifth user's rows again, from the stored
    states of the drops: neither raw rows nor bronze are read again."""
    root = _scratch_root(spark)
    raw = _raw(spark, sf_dir)
    drops = [raw.where("item_id < 250"), raw.where("item_id >= 250"), raw.where("user_id % 5 = 0")]
    for i, drop in enumerate(drops):
        state = L.read_layer(spark, root, "quality_state") if i else None
        L.write_layer(Q.quality_state(drop, state), root, "quality_state", mode="append")
    return Q.state_report(Q.merge_states(L.read_layer(spark, root, "quality_state")))


def q_order_chi2(spark, sf_dir):
    tests = C.chi2_test(_gold_table(spark, sf_dir)).select("day", "experiment_name", "dof")
    return O.with_position(tests, ["day", "experiment_name"])


def q_order_bronze(spark, sf_dir):
    """Bronze by user and time, as the ordered sink lays it out."""
    rows = _bronze(spark, sf_dir).withColumn("_ts", parsed_ts("timestamp"))
    return O.with_position(rows, ["user_id", "_ts", "event_name", "item_id", "site", "experiments", "timestamp"]).drop("_ts")


def q_order_conversion(spark, sf_dir):
    rates = CV.with_conversion_rate(CV.multi_variant(_gold_table(spark, sf_dir)))
    order = [F.desc_nulls_last("conversion_rate"), *[F.asc_nulls_last(c) for c in ("experiment_name", "variant_id", "day")]]
    return O.with_position(rates.select("experiment_name", "variant_id", "day", "conversion_rate"), order)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources / sinks
    "raw_events": _raw,
    "write_read_bronze": q_write_read_bronze,
    "write_read_gold": q_write_read_gold,
    "stream_gold_aggregated": q_stream_gold,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_reordered": q_csv_reordered,
    "csv_bad_values": q_csv_bad_values,
    "rerun_gold": q_rerun_gold,
    "offset_timestamps": q_offset_timestamps,
    "quality_layer_clustered": q_quality_layer,
    "layers_gold_tunnel": q_layers_tunnel,
    # bronze quality
    "null_profile": lambda s, d: Q.null_profile(_raw(s, d)),
    "invalid_timestamps": lambda s, d: Q.invalid_timestamps(_raw(s, d)),
    "duplicate_groups": lambda s, d: Q.duplicate_groups(_raw(s, d)),
    "bronze": _bronze,
    "residual_duplicates": lambda s, d: Q.residual_duplicates(_bronze(s, d)),
    "malformed_experiments": lambda s, d: Q.malformed_experiments(_bronze(s, d)),
    "quality_report": q_quality_report,
    # silver
    "is_buy": lambda s, d: SV.with_is_buy(_bronze(s, d)),
    "flag_purchase": lambda s, d: SV.flag_purchases(_bronze(s, d)),
    "exploded_experiments": lambda s, d: SV.explode_experiments(_bronze(s, d)),
    "silver": _silver,
    "event_rank": lambda s, d: SV.event_rank(_bronze(s, d)),
    "buy_group": q_buy_group,
    "user_journey": q_journey,
    "user_summary": q_user_journey,
    # gold
    "gold_aggregated": _gold,
    "gold_tunnel": _tunnel,
    # Distinct users per variant need neither flags nor deduplication.
    "users_per_variant": lambda s, d: G.users_per_variant(SV.explode_experiments(_raw(s, d))),
    "users_rollup": q_users_rollup,
    "users_rollup_weeks": lambda s, d: K.rollup_weeks(_sketch_layer(s, d)),
    "silver_bucketed": q_silver_bucketed,
    # sessions
    "user_sessions": lambda s, d: SE.user_sessions(_bronze(s, d)),
    "session_summary": lambda s, d: SE.session_summary(SE.user_sessions(_bronze(s, d), "12 hours")),
    # batches
    "quality_report_batches": q_quality_batches,
    # orders, as positions
    "order_bronze": q_order_bronze,
    "order_gold": lambda s, d: O.with_position(_gold(s, d).select(*S.GOLD_KEY), S.GOLD_KEY),
    "order_tunnel": lambda s, d: O.with_position(_tunnel(s, d).select(*S.TUNNEL_KEY), S.TUNNEL_KEY),
    "order_variant_count": lambda s, d: O.with_position(
        CV.variant_count(_gold_table(s, d)), [F.desc("variant_count"), "experiment_name"]
    ),
    "order_conversion": q_order_conversion,
    "order_funnel": lambda s, d: O.with_position(
        CV.funnel(_tunnel(s, d)), ["experiment_name", "variant_id", "users", "day", "event_name"]
    ),
    "order_chi2": q_order_chi2,
    # conversion
    "distinct_experiments": lambda s, d: CV.distinct_experiments(_gold(s, d)),
    "experiment_days": lambda s, d: CV.experiment_days(_gold(s, d)),
    "variant_count": lambda s, d: CV.variant_count(_gold_table(s, d), ordered=True),
    "single_variant_experiments": lambda s, d: CV.single_variant_experiments(_gold_table(s, d)),
    "multi_variant_experiments": lambda s, d: CV.multi_variant(_gold_table(s, d)),
    "conversion_rate": lambda s, d: CV.with_conversion_rate(_gold(s, d)),
    "conversion_ranking": lambda s, d: CV.conversion_ranking(_gold_table(s, d)),
    "top_conversion": lambda s, d: CV.conversion_ranking(_gold_table(s, d), n=10),
    "conversion_trend": lambda s, d: CV.conversion_trend(_gold_table(s, d)),
    "funnel": lambda s, d: CV.funnel(_tunnel(s, d)),
    "experiment_filter": lambda s, d: CV.experiment_filter(_gold(s, d), "search/ranking"),
    "variant_filter": lambda s, d: CV.variant_filter(CV.experiment_filter(_gold(s, d), "search/ranking"), "2"),
    "emptiness": q_emptiness,
    "gold_ordered": lambda s, d: G.gold_ordered(_gold(s, d)),
    "tunnel_ordered": lambda s, d: G.tunnel_ordered(_tunnel(s, d)),
    # chi-square
    "contingency": lambda s, d: C.contingency(_gold_table(s, d)),
    "chi2_expected": q_chi2_expected,
    "chi2_test": lambda s, d: _rounded(C.chi2_test(_gold_table(s, d))),
    "chi2_skipped": lambda s, d: C.chi2_skipped(_gold_table(s, d)),
    "chi2_test_uncut": lambda s, d: _rounded(C.chi2_test(_gold_uncut_table(s, d))),
    "chi2_skipped_uncut": lambda s, d: C.chi2_skipped(_gold_uncut_table(s, d)),
    # bayes
    "variant_totals": lambda s, d: B.variant_totals(_gold_table(s, d)),
    "variant_code": lambda s, d: B.variant_code(_gold(s, d)),
    "bayes_grid_weights": q_bayes_grid_weights,
    "bayes_summary": lambda s, d: _summary_rounded(B.bayes_summary(_gold_table(s, d))),
    "bayes_summary_many_variants": q_bayes_many,
    "bayes_draws": q_bayes_draws,
    "bayes_hdi": q_bayes_hdi,
    "bayes_hdi_mass": q_bayes_hdi_mass,
    "bayes_draws_check": q_bayes_draws_check,
    "bayes_comparison_means": q_bayes_comparison_means,
    "bayes_comparison": q_bayes_comparison,
    "posterior_histogram": q_posterior_histogram,
    "daily_rate_hdi": q_daily_rate_hdi,
    "daily_rate_comparison": q_daily_rate_comparison,
    # results
    "experiment_slug": lambda s, d: CV.distinct_experiments(_gold_table(s, d)).select(
        "experiment_name", R.experiment_slug("experiment_name").alias("exp_name")
    ),
    "experiment_result": lambda s, d: R.experiment_results_flat(_gold(s, d)),
    "experiment_result_variants": lambda s, d: R.experiment_result_variants(_gold(s, d)),
    "experiment_result_json": lambda s, d: R.result_json(R.experiment_results(_gold(s, d))),
    "winner": lambda s, d: R.winners(_gold(s, d)),
    "experiment_result_lookup": q_experiment_result_lookup,
}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

_RAW = """
ev0 AS (
  SELECT event_id, user_id,
    CASE WHEN event_id % 101 = 0 THEN 'not-a-time'
         WHEN event_id % 103 = 0 THEN NULL
         ELSE CAST(ts AS VARCHAR) END AS "timestamp",
    CASE WHEN event_type = 'purchase' AND value > 80 THEN 'BUY' ELSE upper(event_type) END AS event_name,
    event_id % 500 AS item_id,
    CASE WHEN user_id % 2 = 0 THEN 'MLA' ELSE 'MLB' END AS site,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN event_id % 89 = 0 THEN '{}'
         WHEN event_id % 83 = 0 THEN '{malformed}'
         ELSE '{checkout/button=' || CAST(user_id % 2 + 1 AS VARCHAR) || ', search/ranking='
              || CAST(user_id % 3 + 1 AS VARCHAR) || ', legacy/solo=1}' END AS experiments
  FROM events),
raw AS (
  SELECT user_id, "timestamp", event_name, item_id, site, experiments FROM ev0
  UNION ALL
  SELECT user_id, "timestamp", event_name, item_id, site, experiments FROM ev0 WHERE event_id % 50 = 0)"""

_BRONZE = _RAW + """,
bronze AS (SELECT DISTINCT user_id, "timestamp", event_name, item_id, site, experiments FROM raw),
ev AS (SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS ts FROM bronze),
stats AS (
  SELECT user_id,
         max(CASE WHEN event_name = 'BUY' THEN ts END) AS last_buy_ts,
         bool_or(coalesce(event_name = 'BUY', false)) AS any_buy
  FROM ev GROUP BY user_id),
flagged AS (
  SELECT ev.*,
         CASE WHEN ev.ts IS NULL THEN coalesce(st.any_buy, false)
              ELSE coalesce(ev.ts <= st.last_buy_ts, false) END AS flag_purchase
  FROM ev LEFT JOIN stats st ON ev.user_id IS NOT DISTINCT FROM st.user_id)"""

_EXPLODE = """
  SELECT x.*, string_split(x._e, '=')[1] AS experiment_name, string_split(x._e, '=')[2] AS variant_id
  FROM (SELECT {src}.*, unnest(string_split(regexp_replace(experiments, '[{{}}]', '', 'g'), ', ')) AS _e FROM {src}) x"""

_GOLD = _BRONZE + """,
silver AS (
  SELECT user_id, ts AS "timestamp", event_name, item_id, site, experiment_name, variant_id, flag_purchase
  FROM (""" + _EXPLODE.format(src="flagged") + """)),
gold AS (
  SELECT CAST("timestamp" AS DATE) AS day, experiment_name, variant_id,
         count(DISTINCT user_id) AS users,
         count(DISTINCT CASE WHEN flag_purchase THEN user_id END) AS purchases
  FROM silver GROUP BY 1, 2, 3),
tunnel AS (
  SELECT CAST("timestamp" AS DATE) AS day, event_name, experiment_name, variant_id,
         count(DISTINCT user_id) AS users,
         count(DISTINCT CASE WHEN flag_purchase THEN user_id END) AS purchases
  FROM silver GROUP BY 1, 2, 3, 4),
vc AS (
  SELECT experiment_name, count(DISTINCT variant_id) AS variant_count
  FROM gold WHERE experiment_name IS NOT NULL GROUP BY 1),
multi AS (
  SELECT * FROM gold WHERE experiment_name IN (SELECT experiment_name FROM vc WHERE variant_count > 1))"""

_CHI2 = _GOLD + """,
cont AS (
  SELECT experiment_name, day, variant_id, purchases AS conversions, users - purchases AS non_conversions,
         users AS row_total,
         sum(purchases) OVER g AS conversions_total,
         sum(users - purchases) OVER g AS non_conversions_total,
         count(*) OVER g AS n_variants,
         bool_or(users = 0 OR variant_id IS NULL) OVER g AS zero_row
  FROM multi WHERE day IS NOT NULL
  WINDOW g AS (PARTITION BY experiment_name, day)),
cont2 AS (
  SELECT experiment_name, day, variant_id, conversions, non_conversions, row_total,
         CAST(conversions_total AS BIGINT) AS conversions_total,
         CAST(non_conversions_total AS BIGINT) AS non_conversions_total,
         n_variants,
         (NOT zero_row AND conversions_total > 0 AND non_conversions_total > 0) AS testable,
         zero_row
  FROM cont),
cells AS (
  SELECT experiment_name, day, variant_id, n_variants - 1 AS dof, 'purchases' AS cell,
         CAST(conversions AS DOUBLE) AS observed,
         row_total * conversions_total / (conversions_total + non_conversions_total) AS expected
  FROM cont2 WHERE testable
  UNION ALL
  SELECT experiment_name, day, variant_id, n_variants - 1 AS dof, 'non_purchases' AS cell,
         CAST(non_conversions AS DOUBLE) AS observed,
         row_total * non_conversions_total / (conversions_total + non_conversions_total) AS expected
  FROM cont2 WHERE testable),
contrib AS (
  SELECT *,
         pow(CASE WHEN dof = 1 THEN abs(observed - expected) - least(0.5, abs(observed - expected))
                  ELSE abs(observed - expected) END, 2) / expected AS contribution
  FROM cells),
stat AS (
  SELECT experiment_name, day,
         sum(CASE WHEN dof > 0 THEN contribution ELSE 0.0 END) AS chi2_statistic,
         CAST(min(dof) AS INTEGER) AS dof
  FROM contrib GROUP BY 1, 2),
pv AS (
  SELECT *,
         CASE WHEN dof = 0 OR chi2_statistic <= 0 THEN 1.0
              ELSE greatest(0.0, 1.0 - list_sum([exp((dof / 2.0 + n) * ln(chi2_statistic / 2.0)
                                                     - chi2_statistic / 2.0 - lgamma(dof / 2.0 + n + 1))
                                                 for n in range(0, 400)])) END AS p_value
  FROM stat)"""


_CHI2_UNCUT = _CHI2.replace("event_type = 'purchase' AND value > 80", "event_type = 'purchase' AND value > 0")
assert _CHI2_UNCUT != _CHI2


_SQL_ROUNDS = 4  # grids in SQL; a resolved experiment keeps its own


def _grid_sql() -> str:
    """The grid of operators.bayes in SQL: a first one and refinements where it is too wide."""
    p = B.GRID_POINTS
    u0, u1 = f"lo - 2 - {B.FALL_OFF} / (n_some + 1)", f"hi + 2 + {B.FALL_OFF} / (n_rest + 1)"
    v0, v1 = f"-3.0 - {B.FALL_OFF} / (n_both + 2)", f"ln((k + 1) * {B.SUM_PER_VARIANT})"
    out = [
        f"""
totals AS (
  SELECT experiment_name, variant_id, CAST(sum(purchases) AS BIGINT) AS purchases, CAST(sum(users) AS BIGINT) AS users
  FROM multi WHERE variant_id IS NOT NULL GROUP BY 1, 2),
box0 AS (
  SELECT experiment_name, {u0} AS u0, ({u1} - ({u0})) / {p - 1} AS du, {v0} AS v0, ({v1} - ({v0})) / {p - 1} AS dv
  FROM (SELECT experiment_name, min(ln((purchases + 0.5) / (users - purchases + 0.5))) AS lo,
               max(ln((purchases + 0.5) / (users - purchases + 0.5))) AS hi, count(*) AS k, count_if(purchases > 0) AS n_some,
               count_if(purchases < users) AS n_rest, count_if(purchases > 0 AND purchases < users) AS n_both
        FROM totals GROUP BY 1))"""
    ]
    for r in range(_SQL_ROUNDS):
        out.append(
            f"""
w{r} AS (
  SELECT *, e / sum(e) OVER (PARTITION BY experiment_name) AS weight
  FROM (SELECT *, exp(lw - max(lw) OVER (PARTITION BY experiment_name)) AS e
        FROM (SELECT experiment_name, grid_id, min(u) AS u, min(v) AS v, min(du) AS du, min(dv) AS dv, min(a) AS a, min(b) AS b,
                     sum(lgamma(a + purchases) + lgamma(b + users - purchases) - lgamma(a + b + users))
                     - count(*) * (lgamma(min(a)) + lgamma(min(b)) - lgamma(min(a) + min(b)))
                     - {S.PRIOR_RATE!r} * (min(a) + min(b)) + ln(min(a)) + ln(min(b)) AS lw
              FROM (SELECT *, exp(v) * exp(u) / (exp(u) + 1) AS a, exp(v) / (exp(u) + 1) AS b
                    FROM (SELECT *, u0 + (grid_id // {p}) * du AS u, v0 + (grid_id % {p}) * dv AS v
                          FROM (SELECT t.*, x.u0, x.du, x.v0, x.dv, unnest(range(0, {p * p})) AS grid_id
                                FROM totals t JOIN box{r} x USING (experiment_name))))
              GROUP BY 1, 2)))"""
        )
        if r < _SQL_ROUNDS - 1:
            half = {x: f"{B.GRID_SPAN!r} * greatest(sd{x}, d{x} / 4)" for x in "uv"}
            ends = ", ".join(
                f"CASE WHEN done THEN {x}0 ELSE m{x} - {half[x]} END AS {x}0, "
                f"CASE WHEN done THEN d{x} ELSE 2 * {half[x]} / {p - 1} END AS d{x}"
                for x in "uv"
            )
            sds = ", ".join(f"sqrt(greatest(sum(weight * {x} * {x}) - sum(weight * {x}) * sum(weight * {x}), 0.0)) AS sd{x}" for x in "uv")
            out.append(
                f"""
box{r + 1} AS (
  SELECT experiment_name, {ends}
  FROM (SELECT *, du <= {B.GRID_STEP} * sdu AND dv <= {B.GRID_STEP} * sdv AS done
        FROM (SELECT experiment_name, min(u) AS u0, min(v) AS v0, min(du) AS du, min(dv) AS dv,
                     sum(weight * u) AS mu, sum(weight * v) AS mv, {sds}
              FROM w{r} GROUP BY 1)))"""
            )
    out.append(
        f"""
cells AS (
  SELECT t.experiment_name, t.variant_id, CAST(purchases AS DOUBLE) AS s, CAST(users - purchases AS DOUBLE) AS r, weight,
         w.a + purchases AS a, w.b + users - purchases AS b
  FROM totals t JOIN w{_SQL_ROUNDS - 1} w USING (experiment_name) WHERE weight >= {B.LEAST_WEIGHT!r}),
mom AS (
  SELECT experiment_name, variant_id, sum(weight * a / (a + b)) / sum(weight) AS e1,
         sum(weight * a * (a + 1) / ((a + b) * (a + b + 1))) / sum(weight) AS e2
  FROM cells GROUP BY 1, 2),
summ AS (
  SELECT experiment_name, variant_id, e1 AS mean, sqrt(greatest(e2 - e1 * e1, 0.0)) AS sd, '{S.POSTERIOR_CLASS}' AS class FROM mom)"""
    )
    return ",".join(out)


def _curve_sql() -> str:
    """The posterior curves of operators.bayes: one row per node, and the panels between nodes."""
    n = B.CURVE
    return f"""
ends AS (
  SELECT *, greatest(c - greatest({B.CURVE_SPAN} * sd, 32.0 / (s + 0.5)), -{B.CURVE_END}) AS x0,
         (least(c + greatest({B.CURVE_SPAN} * sd, 32.0 / (r + 0.5)), {B.CURVE_END})
          - greatest(c - greatest({B.CURVE_SPAN} * sd, 32.0 / (s + 0.5)), -{B.CURVE_END})) / {n} AS h
  FROM (SELECT *, ln(ea / eb) AS c, sqrt(1 / ea + 1 / eb) AS sd
        FROM (SELECT experiment_name, variant_id, min(s) AS s, min(r) AS r, sum(weight * a) / sum(weight) AS ea,
                     sum(weight * b) / sum(weight) AS eb FROM cells GROUP BY 1, 2))),
density AS (
  SELECT experiment_name, variant_id, node, min(x0) AS x0, min(h) AS h, sum(f) AS f,
         sum(f * (a - (a + b) / (1 + exp(-x)))) AS d, sum(CASE WHEN node = 0 THEN f / a ELSE 0 END) AS tail
  FROM (SELECT *, exp(ln(weight) - lnb + a * (-greatest(-x, 0.0) - ln(1 + exp(-abs(x))))
                      + b * (-greatest(x, 0.0) - ln(1 + exp(-abs(x))))) AS f
        FROM (SELECT *, x0 + node * h AS x
              FROM (SELECT c.*, e.x0, e.h, lgamma(c.a) + lgamma(c.b) - lgamma(c.a + c.b) AS lnb, unnest(range(0, {n + 1})) AS node
                    FROM cells c JOIN ends e USING (experiment_name, variant_id))))
  GROUP BY 1, 2, 3),
curve AS (
  SELECT *, sum(panel) OVER (PARTITION BY experiment_name, variant_id ORDER BY node) AS p
  FROM (SELECT *, CASE WHEN node = 0 THEN tail ELSE greatest(h / 2 * (lag(f) OVER n + f) - h * h / 12 * (d - lag(d) OVER n), 0.0) END AS panel
        FROM density WINDOW n AS (PARTITION BY experiment_name, variant_id ORDER BY node))),
panels AS (
  SELECT *, CASE WHEN node = 0 THEN -1.0 ELSE y0 END AS above
  FROM (SELECT experiment_name, variant_id, node, x0, h, p AS y0, lead(p) OVER n AS y1, h * f AS m0, h * lead(f) OVER n AS m1
        FROM curve WINDOW n AS (PARTITION BY experiment_name, variant_id ORDER BY node))
  WHERE node < {n})"""


def _quantile_sql(name: str, requests: str) -> str:
    """``name``: the rows of ``requests`` (experiment_name, variant_id, q, others) with place and theta where the curve reaches q."""
    y, m = "y0 + t * (m0 + t * (c2 + t * c3))", "m0 + t * (2 * c2 + 3 * t * c3)"
    rows = f"""
    SELECT *, 3 * (y1 - y0) - 2 * m0 - m1 AS c2, 2 * (y0 - y1) + m0 + m1 AS c3,
           greatest(0.0, least(1.0, CASE WHEN y1 > y0 THEN (q - y0) / (y1 - y0) ELSE 0.5 END)) AS t
    FROM (SELECT r.*, p.node AS j, p.x0, p.h, p.y0, p.y1, p.m0, p.m1
          FROM {requests} r ASOF JOIN panels p
            ON r.experiment_name = p.experiment_name AND r.variant_id = p.variant_id AND r.q >= p.above)"""
    for _ in range(B.NEWTON_STEPS):
        rows = f"SELECT * REPLACE (greatest(0.0, least(1.0, t - ({y} - q) / greatest({m}, 1e-300))) AS t) FROM ({rows})"
    return f"""
{name} AS (
  SELECT * EXCLUDE (j, x0, h, y0, y1, m0, m1, c2, c3, t), j + t AS to_place, 1 / (1 + exp(-(x0 + (j + t) * h))) AS to_theta
  FROM ({rows}))"""


def _cumulative_sql(name: str, requests: str) -> str:
    """``name``: the rows of ``requests`` (experiment_name, variant_id, place, others) with the cumulative probability ``f`` and theta there."""
    t = "(place - node)"
    return f"""
{name} AS (
  SELECT r.*, 1 / (1 + exp(-(x0 + place * h))) AS theta,
         CASE WHEN place <= 0 THEN 0.0 WHEN place >= {B.CURVE} THEN 1.0
              ELSE y0 + {t} * (m0 + {t} * (3 * (y1 - y0) - 2 * m0 - m1 + {t} * (2 * (y0 - y1) + m0 + m1))) END AS f
  FROM {requests} r JOIN panels p
    ON r.experiment_name = p.experiment_name AND r.variant_id = p.variant_id
   AND p.node = greatest(0, least(CAST(floor(place) AS BIGINT), {B.CURVE - 1})))"""


def _hdi_sql() -> str:
    """``hdi``: the shortest intervals, found as operators.bayes finds them."""
    prob, n, fine = S.HDI_PROB, B.CURVE, B.FINE
    k = f"least(greatest(k, 1), {2 * fine - 1})"
    return ",".join(
        [
            f"""
tried AS (SELECT experiment_name, variant_id, CAST(node AS DOUBLE) AS place FROM panels WHERE node BETWEEN 1 AND {n - 1})""",
            _cumulative_sql("tried_f", "tried"),
            f"""
tried_q AS (SELECT *, f + {prob} AS q FROM tried_f)""",
            _quantile_sql("tried_w", "tried_q"),
            f"""
coarse AS (
  SELECT experiment_name, variant_id, arg_min(place, (width, place)) AS i
  FROM (SELECT *, CASE WHEN q >= 1 THEN 2.0 ELSE to_theta - theta END AS width FROM tried_w) GROUP BY 1, 2),
near AS (
  SELECT experiment_name, variant_id, k, i - 1 + k / {float(fine)} AS place
  FROM (SELECT *, unnest(range(0, {2 * fine + 1})) AS k FROM coarse))""",
            _cumulative_sql("near_f", "near"),
            f"""
near_q AS (SELECT *, f + {prob} AS q FROM near_f)""",
            _quantile_sql("near_to", "near_q"),
            f"""
near_w AS (SELECT *, CASE WHEN q >= 1 THEN 2.0 ELSE to_theta - theta END AS width FROM near_to),
centre AS (
  SELECT experiment_name, variant_id, {k} AS k
  FROM (SELECT experiment_name, variant_id, arg_min(k, (width, k)) AS k FROM near_w GROUP BY 1, 2)),
three AS (
  SELECT c.experiment_name, c.variant_id, min(CASE WHEN w.k = c.k THEN place END) AS middle, min(CASE WHEN w.k = c.k - 1 THEN width END) AS l,
         min(CASE WHEN w.k = c.k THEN width END) AS m, min(CASE WHEN w.k = c.k + 1 THEN width END) AS r
  FROM near_w w JOIN centre c USING (experiment_name, variant_id) GROUP BY 1, 2),
least_at AS (
  SELECT experiment_name, variant_id,
         middle + CASE WHEN l - 2 * m + r > 0 AND l < 2 AND r < 2
                   THEN greatest(-1.0, least(1.0, (l - r) / (2 * (l - 2 * m + r)))) ELSE 0.0 END / {float(fine)} AS place
  FROM three)""",
            _cumulative_sql("least_f", "least_at"),
            f"""
three_q AS (
  SELECT experiment_name, variant_id, 'inner' AS kind, theta, f + {prob} AS q FROM least_f
  UNION ALL SELECT experiment_name, variant_id, 'bottom', 0.0, {prob} FROM totals
  UNION ALL SELECT experiment_name, variant_id, 'top', 1.0, 1 - {prob} FROM totals)""",
            _quantile_sql("three_to", "three_q"),
            """
hdi AS (
  SELECT experiment_name, variant_id, arg_min(low, (width, low)) AS hdi_low, arg_min(high, (width, low)) AS hdi_high
  FROM (SELECT *, CASE WHEN kind = 'inner' AND q >= 1 THEN 2.0 ELSE high - low END AS width
        FROM (SELECT *, CASE WHEN kind = 'top' THEN to_theta ELSE theta END AS low,
                     CASE WHEN kind = 'top' THEN 1.0 ELSE to_theta END AS high FROM three_to))
  GROUP BY 1, 2)""",
        ]
    )


_BAYES = _GOLD + "," + _grid_sql()
_CURVES = _BAYES + "," + _curve_sql()
_HDI = _CURVES + "," + _hdi_sql()
_DRAWS = (
    f"""
counters AS (
  SELECT experiment_name, variant_id, draw,
         (CAST('0x' || substr(md5('0' || chr(9) || experiment_name || chr(9) || variant_id || chr(9) || draw), 1, 13) AS BIGINT) + 0.5)
         / {1 << 52} AS q
  FROM (SELECT experiment_name, variant_id, unnest(range(0, {S.POSTERIOR_SAMPLES})) AS draw FROM totals)),"""
    + _quantile_sql("draws", "counters")
)

_DAILY_HDI = _GOLD + """,
rates AS (
  SELECT experiment_name, variant_id, CAST(purchases AS DOUBLE) / CAST(users AS DOUBLE) AS theta
  FROM multi WHERE day IS NOT NULL AND variant_id IS NOT NULL AND users > 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY experiment_name, variant_id ORDER BY theta) - 1 AS i,
         count(*) OVER (PARTITION BY experiment_name, variant_id) AS n
  FROM rates),
pairs AS (
  SELECT a.experiment_name, a.variant_id, a.i, a.theta AS lo, b.theta AS hi
  FROM ranked a JOIN ranked b
    ON a.experiment_name = b.experiment_name AND a.variant_id = b.variant_id
   AND b.i = a.i + CAST(floor(a.n * 0.95) AS BIGINT)),
hdi AS (
  SELECT experiment_name, variant_id, arg_min(lo, (hi - lo, i)) AS hdi_low, arg_min(hi, (hi - lo, i)) AS hdi_high
  FROM pairs GROUP BY 1, 2)"""

_RANKED = _BRONZE + """,
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_name ASC NULLS FIRST,
               item_id ASC NULLS FIRST, site ASC NULLS FIRST, experiments ASC NULLS FIRST,
               "timestamp" ASC NULLS FIRST) AS rn FROM ev),
      bg AS (
        SELECT *, max(CASE WHEN event_name = 'BUY' THEN rn END) OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS buy_group FROM ranked)"""

ORACLE_SQL: dict[str, str] = {
    "csv_reordered": "WITH " + _RAW + " SELECT * FROM raw",
    "csv_bad_values": "WITH " + _RAW + """
      SELECT 'user_id' AS "column", CAST(count_if(user_id % 7 = 0) AS BIGINT) AS n FROM raw
      UNION ALL SELECT unnest(['timestamp', 'event_name', 'item_id', 'site', 'experiments']), 0""",
    "rerun_gold": "WITH " + _GOLD.replace(
        "FROM bronze),", "FROM bronze WHERE TRY_CAST(\"timestamp\" AS TIMESTAMP) < TIMESTAMP '2024-01-15'),", 1
    ) + " SELECT * FROM gold",
    "offset_timestamps": """
      WITH e AS (
        SELECT user_id, event_type = 'purchase' AND value > 80 AS buy,
               CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 5 HOUR
                    WHEN event_id % 5 = 0 THEN ts - INTERVAL '9 hours 30 minutes'
                    WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS t
        FROM events),
      s AS (SELECT user_id, max(t) FILTER (buy) AS last, bool_or(buy) AS bought FROM e GROUP BY 1)
      SELECT CAST(t AS DATE) AS day, count(*) AS events,
             CAST(count_if(CASE WHEN t IS NULL THEN coalesce(bought, false) ELSE coalesce(t <= last, false) END) AS BIGINT) AS flagged
      FROM e JOIN s ON e.user_id IS NOT DISTINCT FROM s.user_id GROUP BY 1""",
    "user_journey": "WITH " + _RANKED + """
      SELECT user_id, ts AS "timestamp", event_name, item_id, site, experiments, buy_group,
             buy_group IS NOT NULL AS flag_purchase FROM bg""",
    "experiment_filter": "WITH " + _GOLD + " SELECT * FROM gold WHERE experiment_name = 'search/ranking'",
    "variant_filter": "WITH " + _GOLD + " SELECT * FROM gold WHERE experiment_name = 'search/ranking' AND variant_id = '2'",
    "emptiness": "WITH " + _GOLD + """
      SELECT e AS experiment_name, EXISTS (SELECT 1 FROM tunnel WHERE experiment_name = e) AS present
      FROM (SELECT unnest(['checkout/button', 'search/ranking', 'no/such']) AS e)""",
    "gold_ordered": "WITH " + _GOLD + " SELECT * FROM gold ORDER BY day, experiment_name, variant_id",
    "tunnel_ordered": "WITH " + _GOLD + " SELECT * FROM tunnel ORDER BY day, event_name, experiment_name, variant_id",
    "raw_events": "WITH " + _RAW + " SELECT * FROM raw",
    "write_read_bronze": "WITH " + _BRONZE + " SELECT * FROM bronze",
    "write_read_gold": "WITH " + _GOLD + " SELECT * FROM gold",
    "stream_gold_aggregated": "WITH " + _GOLD + " SELECT * FROM gold",
    "csv_roundtrip": "WITH " + _RAW + " SELECT * FROM raw",
    "layers_gold_tunnel": "WITH " + _GOLD + " SELECT * FROM tunnel",
    "null_profile": "WITH " + _RAW + """
      SELECT CAST(count_if(user_id IS NULL) AS BIGINT) AS user_id, CAST(count_if(event_name IS NULL) AS BIGINT) AS event_name,
             CAST(count_if("timestamp" IS NULL) AS BIGINT) AS "timestamp", CAST(count_if(experiments IS NULL) AS BIGINT) AS experiments FROM raw""",
    "invalid_timestamps": "WITH " + _RAW + """ SELECT * FROM raw WHERE TRY_CAST("timestamp" AS TIMESTAMP) IS NULL""",
    "duplicate_groups": "WITH " + _RAW + """
      SELECT user_id, "timestamp", event_name, item_id, site, experiments, count(*) AS "count"
      FROM raw GROUP BY ALL HAVING count(*) > 1""",
    "bronze": "WITH " + _BRONZE + " SELECT * FROM bronze",
    "residual_duplicates": "WITH " + _BRONZE + """
      SELECT count(*) AS residual_duplicate_groups FROM (
        SELECT 1 FROM bronze GROUP BY user_id, "timestamp", event_name, item_id, site, experiments HAVING count(*) > 1)""",
    "malformed_experiments": "WITH " + _BRONZE + """
      SELECT * FROM bronze WHERE regexp_extract(experiments, '(\\w+=\\w+)', 0) = ''""",
    "quality_report": "WITH " + _BRONZE + """,
      grouped AS (SELECT user_id, "timestamp", event_name, item_id, site, experiments, count(*) AS n FROM raw GROUP BY ALL)
      SELECT 'raw_rows' AS "check", count(*) AS n FROM raw
      UNION ALL SELECT 'null_user_id', CAST(count_if(user_id IS NULL) AS BIGINT) FROM raw
      UNION ALL SELECT 'null_event_name', CAST(count_if(event_name IS NULL) AS BIGINT) FROM raw
      UNION ALL SELECT 'null_timestamp', CAST(count_if("timestamp" IS NULL) AS BIGINT) FROM raw
      UNION ALL SELECT 'null_experiments', CAST(count_if(experiments IS NULL) AS BIGINT) FROM raw
      UNION ALL SELECT 'invalid_timestamps', CAST(count_if(TRY_CAST("timestamp" AS TIMESTAMP) IS NULL) AS BIGINT) FROM raw
      UNION ALL SELECT 'duplicate_groups', CAST(count_if(n > 1) AS BIGINT) FROM grouped
      UNION ALL SELECT 'duplicate_rows_removed', CAST(sum(n - 1) AS BIGINT) FROM grouped
      UNION ALL SELECT 'bronze_rows', count(*) FROM grouped
      UNION ALL SELECT 'malformed_experiments', CAST(count_if(regexp_extract(experiments, '(\\w+=\\w+)', 0) = '') AS BIGINT) FROM grouped
      UNION ALL SELECT 'residual_duplicate_groups', count(*) FROM (
        SELECT 1 FROM bronze GROUP BY user_id, "timestamp", event_name, item_id, site, experiments HAVING count(*) > 1)
      UNION ALL SELECT 'residual_duplicate_rows', CAST(coalesce(sum(c), 0) AS BIGINT) FROM (
        SELECT count(*) AS c FROM bronze GROUP BY user_id, "timestamp", event_name, item_id, site, experiments HAVING count(*) > 1)""",
    "is_buy": "WITH " + _BRONZE + """
      SELECT *, CASE WHEN event_name = 'BUY' THEN 1 ELSE 0 END AS is_buy FROM bronze""",
    "flag_purchase": "WITH " + _BRONZE + """
      SELECT user_id, ts AS "timestamp", event_name, item_id, site, experiments, flag_purchase FROM flagged""",
    "exploded_experiments": "WITH " + _BRONZE + ", ex AS (" + _EXPLODE.format(src="bronze") + """)
      SELECT user_id, "timestamp", event_name, item_id, site, experiments, experiment_name, variant_id FROM ex""",
    "silver": "WITH " + _GOLD + " SELECT * FROM silver",
    "event_rank": "WITH " + _BRONZE + """
      SELECT user_id, "timestamp", event_name, item_id, site, experiments,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_name ASC NULLS FIRST,
               item_id ASC NULLS FIRST, site ASC NULLS FIRST, experiments ASC NULLS FIRST,
               "timestamp" ASC NULLS FIRST) AS BIGINT) AS event_rank
      FROM ev""",
    "buy_group": "WITH " + _BRONZE + """,
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_name ASC NULLS FIRST,
               item_id ASC NULLS FIRST, site ASC NULLS FIRST, experiments ASC NULLS FIRST,
               "timestamp" ASC NULLS FIRST) AS rn FROM ev),
      bg AS (
        SELECT *, max(CASE WHEN event_name = 'BUY' THEN rn END) OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS buy_group FROM ranked)
      SELECT user_id, ts AS "timestamp", event_name, item_id, site, experiments, CAST(rn AS BIGINT) AS event_rank,
             CAST(buy_group AS BIGINT) AS buy_group, buy_group IS NOT NULL AS flag_purchase FROM bg""",
    "user_summary": "WITH " + _GOLD + """
      SELECT user_id, count(*) AS "rows", CAST(count_if(event_name = 'BUY') AS BIGINT) AS buy_rows,
             CAST(count_if(flag_purchase) AS BIGINT) AS flagged_rows,
             count(DISTINCT CAST("timestamp" AS DATE)) AS active_days,
             min("timestamp") AS first_ts, max("timestamp") AS last_ts,
             max(CASE WHEN event_name = 'BUY' THEN "timestamp" END) AS last_buy_ts
      FROM silver GROUP BY user_id""",
    "gold_aggregated": "WITH " + _GOLD + " SELECT * FROM gold",
    "gold_tunnel": "WITH " + _GOLD + " SELECT * FROM tunnel",
    "users_per_variant": "WITH " + _GOLD + """
      SELECT experiment_name, variant_id, count(DISTINCT user_id) AS users FROM silver GROUP BY 1, 2""",
    "distinct_experiments": "WITH " + _GOLD + " SELECT DISTINCT experiment_name FROM gold",
    "experiment_days": "WITH " + _GOLD + " SELECT DISTINCT experiment_name, day FROM gold WHERE day IS NOT NULL",
    "variant_count": "WITH " + _GOLD + " SELECT * FROM vc",
    "single_variant_experiments": "WITH " + _GOLD + " SELECT * FROM vc WHERE variant_count = 1",
    "multi_variant_experiments": "WITH " + _GOLD + " SELECT * FROM multi",
    "conversion_rate": "WITH " + _GOLD + """
      SELECT *, CASE WHEN users = 0 THEN NULL ELSE CAST(purchases AS DOUBLE) / CAST(users AS DOUBLE) END AS conversion_rate
      FROM gold""",
    "conversion_ranking": "WITH " + _GOLD + """
      SELECT *, CASE WHEN users = 0 THEN NULL ELSE CAST(purchases AS DOUBLE) / CAST(users AS DOUBLE) END AS conversion_rate
      FROM multi""",
    "top_conversion": "WITH " + _GOLD + """
      SELECT *, CASE WHEN users = 0 THEN NULL ELSE CAST(purchases AS DOUBLE) / CAST(users AS DOUBLE) END AS conversion_rate
      FROM multi
      ORDER BY conversion_rate DESC NULLS LAST, experiment_name ASC NULLS LAST, variant_id ASC NULLS LAST, day ASC NULLS LAST
      LIMIT 10""",
    "conversion_trend": "WITH " + _GOLD + """,
      r AS (SELECT experiment_name, variant_id, day, users, purchases,
                   CASE WHEN users = 0 THEN NULL ELSE CAST(purchases AS DOUBLE) / CAST(users AS DOUBLE) END AS conversion_rate
            FROM multi WHERE day IS NOT NULL AND variant_id IS NOT NULL)
      SELECT *, round(conversion_rate, 2) AS rate_label FROM r""",
    "funnel": "WITH " + _GOLD + """
      SELECT experiment_name, variant_id, day, event_name, CAST(sum(users) AS BIGINT) AS users
      FROM tunnel WHERE variant_id IS NOT NULL AND day IS NOT NULL AND event_name IS NOT NULL
      GROUP BY 1, 2, 3, 4""",
    "contingency": "WITH " + _CHI2 + """
      SELECT experiment_name, day, variant_id, conversions, non_conversions, row_total, conversions_total,
             non_conversions_total, n_variants, testable FROM cont2""",
    "chi2_expected": "WITH " + _CHI2 + """
      SELECT experiment_name, day, variant_id, dof, cell, observed, round(expected, 9) AS expected,
             round(contribution, 9) AS contribution FROM contrib""",
    "chi2_test": "WITH " + _CHI2 + f"""
      SELECT day, experiment_name, round(chi2_statistic, 9) AS chi2_statistic, dof, round(p_value, 9) AS p_value,
             p_value < {S.SIGNIFICANCE_LEVEL!r} AS reject_h0,
             CASE WHEN p_value >= {S.SIGNIFICANCE_LEVEL!r} THEN '{S.CHI2_ACCEPT_CONCLUSION}' ELSE '{S.CHI2_REJECT_CONCLUSION}' END AS conclusion,
             CASE WHEN p_value >= {S.SIGNIFICANCE_LEVEL!r} THEN '{S.CHI2_ACCEPT_DESCRIPTION}' ELSE '{S.CHI2_REJECT_DESCRIPTION}' END AS description
      FROM pv""",
    "chi2_skipped": "WITH " + _CHI2 + """
      SELECT day, experiment_name,
             CASE WHEN bool_or(variant_id IS NULL) THEN 'null variant'
                  WHEN bool_or(row_total = 0) THEN 'zero row total'
                  ELSE 'zero column total' END AS reason
      FROM cont2 WHERE NOT testable GROUP BY 1, 2""",
    "chi2_skipped_uncut": "WITH " + _CHI2_UNCUT + """
      SELECT day, experiment_name,
             CASE WHEN bool_or(variant_id IS NULL) THEN 'null variant'
                  WHEN bool_or(row_total = 0) THEN 'zero row total'
                  ELSE 'zero column total' END AS reason
      FROM cont2 WHERE NOT testable GROUP BY 1, 2""",
    "chi2_test_uncut": "WITH " + _CHI2_UNCUT + f"""
      SELECT day, experiment_name, round(chi2_statistic, 9) AS chi2_statistic, dof, round(p_value, 9) AS p_value,
             p_value < {S.SIGNIFICANCE_LEVEL!r} AS reject_h0,
             CASE WHEN p_value >= {S.SIGNIFICANCE_LEVEL!r} THEN '{S.CHI2_ACCEPT_CONCLUSION}' ELSE '{S.CHI2_REJECT_CONCLUSION}' END AS conclusion,
             CASE WHEN p_value >= {S.SIGNIFICANCE_LEVEL!r} THEN '{S.CHI2_ACCEPT_DESCRIPTION}' ELSE '{S.CHI2_REJECT_DESCRIPTION}' END AS description
      FROM pv""",
    "variant_totals": "WITH " + _BAYES + " SELECT * FROM totals",
    "variant_code": "WITH " + _GOLD + """
      SELECT experiment_name, variant_id,
             CAST(dense_rank() OVER (PARTITION BY experiment_name ORDER BY variant_id) - 1 AS INTEGER) AS variant_code
      FROM (SELECT DISTINCT experiment_name, variant_id FROM gold WHERE variant_id IS NOT NULL)""",
    "bayes_grid_weights": "WITH " + _BAYES + """
      SELECT experiment_name, CAST(grid_id AS INTEGER) AS grid_id, round(weight, 9) AS weight FROM w""" + str(_SQL_ROUNDS - 1),
    "bayes_summary": "WITH " + _BAYES + """
      SELECT experiment_name, variant_id, round(mean, 9) AS mean, round(sd, 7) AS sd, class FROM summ""",
    "bayes_hdi": "WITH " + _HDI + """
      SELECT experiment_name, variant_id, round(hdi_low, 6) AS hdi_low, round(hdi_high, 6) AS hdi_high FROM hdi""",
    "bayes_hdi_mass": "WITH " + _BAYES + f"""
      SELECT experiment_name, variant_id, CAST({S.HDI_PROB} AS DOUBLE) AS mass FROM totals""",
    "bayes_draws": "WITH " + _CURVES + "," + _DRAWS + """
      SELECT experiment_name, variant_id, draw, round(to_theta, 6) AS theta FROM draws""",
    "bayes_draws_check": "WITH " + _HDI + "," + _DRAWS + """
      SELECT experiment_name, variant_id, count(*) AS draws, round(avg(to_theta), 6) AS mean, round(stddev_samp(to_theta), 6) AS sd,
             CAST(count_if(to_theta BETWEEN hdi_low AND hdi_high) AS BIGINT) AS inside
      FROM draws JOIN hdi USING (experiment_name, variant_id) GROUP BY 1, 2""",
    "bayes_comparison": "WITH " + _HDI + """,
      c AS (SELECT *, min(variant_id) OVER (PARTITION BY experiment_name) AS control FROM summ JOIN hdi USING (experiment_name, variant_id)),
      pair AS (
        SELECT t.experiment_name, t.variant_id AS variant, t.control, k.mean AS control_mean, k.hdi_low AS control_hdi_low,
               k.hdi_high AS control_hdi_high, t.mean AS test_mean, t.hdi_low AS test_hdi_low, t.hdi_high AS test_hdi_high,
               true AS control_found, NOT (k.hdi_high >= t.hdi_low AND k.hdi_low <= t.hdi_high) AS significant
        FROM c t JOIN c k ON t.experiment_name = k.experiment_name AND k.variant_id = t.control WHERE t.variant_id <> t.control)
      SELECT experiment_name, variant, control, round(control_mean, 9) AS control_mean, round(control_hdi_low, 6) AS control_hdi_low,
             round(control_hdi_high, 6) AS control_hdi_high, round(test_mean, 9) AS test_mean, round(test_hdi_low, 6) AS test_hdi_low,
             round(test_hdi_high, 6) AS test_hdi_high, control_found, significant,
             CASE WHEN significant THEN replace('""" + S.COMPARISON_SIGNIFICANT + """', '%s', variant)
                  ELSE replace('""" + S.COMPARISON_NOT_SIGNIFICANT + """', '%s', variant) END AS conclusion
      FROM pair""",
    "posterior_histogram": "WITH " + _CURVES + """,
      spans AS (SELECT experiment_name, variant_id, 1e-4 AS q, 'lo' AS side FROM totals
                UNION ALL SELECT experiment_name, variant_id, 1.0 - 1e-4, 'hi' FROM totals),""" + _quantile_sql("span_ends", "spans") + """,
      edges AS (
        SELECT experiment_name, variant_id, lo, hi, unnest(range(0, 31)) AS e
        FROM (SELECT experiment_name, variant_id, min(CASE WHEN side = 'lo' THEN to_theta END) AS lo,
                     min(CASE WHEN side = 'hi' THEN to_theta END) AS hi FROM span_ends GROUP BY 1, 2)),
      placed AS (
        SELECT g.experiment_name, g.variant_id, e, edge, (ln(edge / (1 - edge)) - n.x0) / n.h AS place
        FROM (SELECT *, lo + e * ((hi - lo) / 30) AS edge FROM edges) g JOIN ends n USING (experiment_name, variant_id)),"""
        + _cumulative_sql("edge_f", "placed") + """,
      bounded AS (
        SELECT experiment_name, variant_id, e, edge, CASE WHEN e = 0 THEN 0.0 WHEN e = 30 THEN 1.0 ELSE f END AS f FROM edge_f)
      SELECT a.experiment_name, a.variant_id, CAST(b.e AS INTEGER) AS bin, round(a.edge, 6) AS bin_low, round(b.edge, 6) AS bin_high,
             round(b.f - a.f, 6) AS mass
      FROM bounded a JOIN bounded b ON a.experiment_name = b.experiment_name AND a.variant_id = b.variant_id AND b.e = a.e + 1""",
    "daily_rate_hdi": "WITH " + _DAILY_HDI + " SELECT * FROM hdi",
    "daily_rate_comparison": "WITH " + _DAILY_HDI + """,
      summ AS (
        SELECT h.*, m.mean, min(h.variant_id) OVER (PARTITION BY h.experiment_name) AS control
        FROM hdi h JOIN (SELECT experiment_name, variant_id, round(avg(theta), 9) AS mean FROM rates GROUP BY 1, 2) m
          ON h.experiment_name = m.experiment_name AND h.variant_id = m.variant_id),
      ctl AS (SELECT experiment_name, mean AS control_mean, hdi_low AS control_hdi_low, hdi_high AS control_hdi_high
              FROM summ WHERE variant_id = control)
      SELECT t.experiment_name, t.variant_id AS variant, t.control, c.control_mean, c.control_hdi_low, c.control_hdi_high,
             t.mean AS test_mean, t.hdi_low AS test_hdi_low, t.hdi_high AS test_hdi_high, true AS control_found,
             NOT (c.control_hdi_high >= t.hdi_low AND c.control_hdi_low <= t.hdi_high) AS significant,
             CASE WHEN NOT (c.control_hdi_high >= t.hdi_low AND c.control_hdi_low <= t.hdi_high)
                  THEN replace('""" + S.COMPARISON_SIGNIFICANT + """', '%s', t.variant_id)
                  ELSE replace('""" + S.COMPARISON_NOT_SIGNIFICANT + """', '%s', t.variant_id) END AS conclusion
      FROM summ t JOIN ctl c ON t.experiment_name = c.experiment_name
      WHERE t.variant_id <> t.control""",
    "experiment_slug": "WITH " + _GOLD + """
      SELECT experiment_name, replace(experiment_name, '/', '|') AS exp_name FROM (SELECT DISTINCT experiment_name FROM gold)""",
    "experiment_result": "WITH " + _GOLD + """
      SELECT replace(experiment_name, '/', '|') AS exp_name, day, CAST(sum(users) AS BIGINT) AS number_of_participants,
             arg_min(variant_id, (-purchases, variant_id)) AS winner, count(*) AS n_variants
      FROM gold WHERE day IS NOT NULL AND variant_id IS NOT NULL GROUP BY experiment_name, day""",
    "experiment_result_variants": "WITH " + _GOLD + """
      SELECT replace(experiment_name, '/', '|') AS exp_name, day, variant_id AS id, purchases AS number_of_purchases
      FROM gold WHERE day IS NOT NULL AND variant_id IS NOT NULL""",
    "experiment_result_json": "WITH " + _GOLD + """,
      res AS (
        SELECT replace(experiment_name, '/', '|') AS exp_name, day, CAST(sum(users) AS BIGINT) AS number_of_participants,
               CAST(arg_min(variant_id, (-purchases, variant_id)) AS BIGINT) AS winner,
               list_sort(list({'id': CAST(variant_id AS BIGINT), 'number_of_purchases': purchases})) AS variants
        FROM gold WHERE day IS NOT NULL AND variant_id IS NOT NULL GROUP BY experiment_name, day)
      SELECT exp_name, day,
             CAST(to_json({'results': {'exp_name': exp_name, 'day': strftime(day, '%Y-%m-%d'),
                  'number_of_participants': number_of_participants, 'winner': winner, 'variants': variants}}) AS VARCHAR) AS json
      FROM res""",
    "winner": "WITH " + _GOLD + """
      SELECT experiment_name, day, arg_min(variant_id, (-purchases, variant_id)) AS winner,
             max(purchases) AS winner_purchases
      FROM gold WHERE day IS NOT NULL AND variant_id IS NOT NULL GROUP BY 1, 2""",
    "experiment_result_lookup": "WITH " + _GOLD + """,
      res AS (
        SELECT replace(experiment_name, '/', '|') AS exp_name, strftime(day, '%Y-%m-%d') AS day,
               CAST(sum(users) AS BIGINT) AS number_of_participants,
               CAST(arg_min(variant_id, (-purchases, variant_id)) AS BIGINT) AS winner,
               list_sort(list({'id': CAST(variant_id AS BIGINT), 'number_of_purchases': purchases})) AS variants
        FROM gold WHERE day IS NOT NULL AND variant_id IS NOT NULL GROUP BY experiment_name, day),
      span AS (
        SELECT replace(experiment_name, '/', '|') AS exp_name, min(day) AS d0, max(day) AS d1
        FROM gold WHERE day IS NOT NULL AND variant_id IS NOT NULL GROUP BY experiment_name),
      req AS (
        SELECT exp_name, strftime(CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 + 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE), '%Y-%m-%d') AS day
        FROM span),
      ans AS (
        SELECT req.exp_name, req.day, res.day IS NOT NULL AS found, res.number_of_participants, res.winner,
               res.variants,
               CASE WHEN res.day IS NULL THEN 'No data found for experiment ''' || req.exp_name || ''' on day ''' || req.day || '''' END AS detail
        FROM req LEFT JOIN res ON req.exp_name = res.exp_name AND req.day = res.day)
      SELECT exp_name, day, found, number_of_participants, CAST(winner AS VARCHAR) AS winner, detail,
             CAST(CASE WHEN found THEN 200 ELSE 404 END AS INTEGER) AS status,
             CASE WHEN found
                  THEN CAST(to_json({'results': {'exp_name': exp_name, 'day': day,
                        'number_of_participants': number_of_participants, 'winner': winner, 'variants': variants}}) AS VARCHAR)
                  ELSE CAST(to_json({'detail': detail}) AS VARCHAR) END AS response
      FROM ans""",
}

ORACLE_SQL["silver_bucketed"] = ORACLE_SQL["silver"]
ORACLE_SQL["quality_report_batches"] = ORACLE_SQL["quality_report"].replace(
    """  SELECT user_id, "timestamp", event_name, item_id, site, experiments FROM ev0 WHERE event_id % 50 = 0)""",
    """  SELECT user_id, "timestamp", event_name, item_id, site, experiments FROM ev0 WHERE event_id % 50 = 0
  UNION ALL
  SELECT user_id, "timestamp", event_name, item_id, site, experiments FROM ev0 WHERE user_id % 5 = 0
  UNION ALL
  SELECT user_id, "timestamp", event_name, item_id, site, experiments FROM ev0 WHERE event_id % 50 = 0 AND user_id % 5 = 0)""",
)
_SESSIONS = _BRONZE + """,
      marked AS (
        SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '{gap}' THEN 0 ELSE 1 END AS starts
        FROM ev WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
      numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked),
      sessions AS (
        SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS events, count(DISTINCT event_name) AS steps,
               CAST(count_if(event_name = 'BUY') AS BIGINT) AS buys, max(CASE WHEN event_name = 'BUY' THEN ts END) AS last_buy,
               coalesce(bool_or(event_name = 'BUY'), false) AS converted
        FROM (SELECT user_id, session, ts, event_name FROM numbered
              UNION ALL SELECT user_id, NULL, ts, event_name FROM ev WHERE ts IS NULL)
        GROUP BY user_id, session)"""
ORACLE_SQL["user_sessions"] = "WITH " + _SESSIONS.replace("{gap}", "30 minutes") + " SELECT * REPLACE (CASE WHEN last_event IS NULL THEN NULL ELSE last_buy END AS last_buy) FROM sessions"
ORACLE_SQL["session_summary"] = "WITH " + _SESSIONS.replace("{gap}", "12 hours") + """
      SELECT user_id, count(*) AS sessions, CAST(count_if(converted) AS BIGINT) AS converting_sessions, CAST(sum(events) AS BIGINT) AS events,
             CAST(coalesce(sum(CASE WHEN NOT converted THEN events END), 0) AS BIGINT) AS events_without_purchase,
             max(CAST(floor(epoch(last_event - session_start)) AS BIGINT)) AS longest_seconds
      FROM sessions GROUP BY 1"""
_USERS = """count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN flag_purchase THEN user_id END) AS purchases"""
ORACLE_SQL["users_rollup"] = "WITH " + _GOLD + f" SELECT experiment_name, variant_id, {_USERS} FROM silver GROUP BY 1, 2"
ORACLE_SQL["users_rollup_weeks"] = "WITH " + _GOLD + f"""
      SELECT CAST(date_trunc('week', CAST("timestamp" AS DATE)) AS DATE) AS week, experiment_name, variant_id, {_USERS}
      FROM silver GROUP BY 1, 2, 3"""


def _position_sql(rows: str, *order: str) -> str:
    """``rows`` plus the position in ``order`` (nulls first unless said otherwise)."""
    by = ", ".join(o if " " in o else f"{o} ASC NULLS FIRST" for o in order)
    return f"SELECT *, row_number() OVER (ORDER BY {by}) AS position FROM ({rows})"


ORACLE_SQL["order_bronze"] = "WITH " + _BRONZE + " SELECT * EXCLUDE (ts) FROM (" + _position_sql(
    "SELECT * FROM ev", "user_id", "ts", "event_name", "item_id", "site", "experiments", '"timestamp"'
) + ")"
ORACLE_SQL["order_gold"] = "WITH " + _GOLD + " " + _position_sql(f" SELECT {', '.join(S.GOLD_KEY)} FROM gold", *S.GOLD_KEY)
ORACLE_SQL["order_tunnel"] = "WITH " + _GOLD + " " + _position_sql(f" SELECT {', '.join(S.TUNNEL_KEY)} FROM tunnel", *S.TUNNEL_KEY)
ORACLE_SQL["order_variant_count"] = "WITH " + _GOLD + " " + _position_sql(" SELECT * FROM vc", "variant_count DESC", "experiment_name")
ORACLE_SQL["order_conversion"] = "WITH " + _GOLD + " " + _position_sql(
    "SELECT experiment_name, variant_id, day, conversion_rate FROM ("
    + ORACLE_SQL["conversion_ranking"][len("WITH " + _GOLD) :] + ")",
    "conversion_rate DESC NULLS LAST", *[f"{c} ASC NULLS LAST" for c in ("experiment_name", "variant_id", "day")],
)
ORACLE_SQL["order_funnel"] = "WITH " + _GOLD + " " + _position_sql(
    ORACLE_SQL["funnel"][len("WITH " + _GOLD) :], "experiment_name", "variant_id", "users", "day", "event_name"
)
ORACLE_SQL["order_chi2"] = "WITH " + _CHI2 + " " + _position_sql(" SELECT day, experiment_name, dof FROM pv", "day", "experiment_name")
ORACLE_SQL["quality_layer_clustered"] = ORACLE_SQL["quality_report"]
ORACLE_SQL["bayes_summary_many_variants"] = (
    """WITH multi AS (
  SELECT 'hundred' AS experiment_name, CAST(user_id % 100 AS VARCHAR) AS variant_id,
         count(*) AS users, count_if(event_type = 'purchase') AS purchases
  FROM events GROUP BY 2),"""
    + ORACLE_SQL["bayes_summary"][len("WITH " + _GOLD + ",") :]
)
ORACLE_SQL["bayes_comparison_means"] = (
    "WITH summary AS ("
    + ORACLE_SQL["bayes_summary"]
    + """),
      c AS (SELECT *, CASE WHEN experiment_name = 'search/ranking' THEN '2' ELSE min(variant_id) OVER (PARTITION BY experiment_name) END AS control
            FROM summary)
      SELECT t.experiment_name, t.variant_id AS variant, t.control, k.mean AS control_mean, t.mean AS test_mean, true AS control_found
      FROM c t JOIN c k ON t.experiment_name = k.experiment_name AND k.variant_id = t.control WHERE t.variant_id <> t.control"""
)
