"""Raw -> bronze -> silver -> gold, each layer written once.

Each layer is written and then read back, so every later step starts from
storage: lineage stays short (a lost executor recomputes from the last layer,
never from the raw input) and nothing is re-derived for a second consumer.

Physical layout choices:
* bronze and silver are sorted by (user_id, timestamp) within each file, so
  row-group statistics prune per-user reads. No extra shuffle is spent on it
  by default: silver leaves the purchase attach already grouped by user (and
  salt), the largest table is not shuffled again just to be written.
  ``cluster=True`` adds a range shuffle on (user_id, timestamp) for
  lookup-heavy use (the time in the range key splits a hot user over files).
* gold tables are written partitioned by ``day``: a per-day lookup reads one
  folder. A rerun replaces the whole table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from abtest_spark import schema as S
from abtest_spark.operators import gold as G
from abtest_spark.operators import quality as Q
from abtest_spark.operators import silver as SV
from abtest_spark.sources.layers import read_layer, write_layer

USER_ORDER = ["user_id", "timestamp"]
# The other columns part a user's (or the anonymous user's) untimed rows.
CLUSTER_ORDER = [*USER_ORDER, "event_name", "item_id", "site", "experiments"]
SILVER_ORDER = [*USER_ORDER, "event_name", "item_id", "site", "experiment_name", "variant_id"]


def build_bronze(raw: DataFrame, root: str, fmt: str = "parquet", cluster: bool = False) -> DataFrame:
    """Deduplicate and write bronze; the quality checks are observed during
    that same write (the dedupe is the grouped aggregate they need), so they
    cost no extra scan or shuffle, and are stored as a small
    ``quality_report`` layer of (check, n) rows."""
    spark = raw.sparkSession
    observation = Observation("bronze_quality")
    grouped = Q.grouped_by_key(raw)
    if cluster:
        # Observed above the range shuffle: its sampling runs what is below once more.
        grouped = grouped.repartitionByRange(*CLUSTER_ORDER)
    bronze = grouped.observe(observation, *Q.quality_metrics()).select(*S.EVENT_KEY)
    write_layer(bronze, root, "bronze", fmt=fmt, sort_by=USER_ORDER)
    metrics = dict(observation.get)  # one row of counts, gathered by the write job
    # The self-check reads what was written.
    metrics |= Q.residual_counts(read_layer(spark, root, "bronze", fmt)).first().asDict()
    report = spark.createDataFrame(
        [(name, int(value)) for name, value in metrics.items()], "check string, n long"
    )
    write_layer(report, root, "quality_report", fmt=fmt)
    return read_layer(spark, root, "bronze", fmt)


def build_silver(bronze: DataFrame, root: str, fmt: str = "parquet", cluster: bool = False) -> DataFrame:
    silver = SV.to_silver(bronze)
    write_layer(silver, root, "silver", fmt=fmt, cluster_by=SILVER_ORDER if cluster else (), sort_by=USER_ORDER)
    return read_layer(bronze.sparkSession, root, "silver", fmt)


def build_gold(silver: DataFrame, root: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Both gold tables from one per-(day, event, experiment, variant, user)
    reduction of silver, kept (memory, spilling to disk) for its two
    consumers."""
    base = (
        silver.withColumn("day", F.to_date("timestamp"))
        .groupBy(*S.TUNNEL_KEY, "user_id")
        .agg(F.max("flag_purchase").alias("flag_purchase"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        write_layer(G.gold_tunnel_from_base(base), root, "gold_tunnel", fmt=fmt, partition_by=["day"])
        write_layer(G.gold_aggregated_from_base(base), root, "gold_aggregated", fmt=fmt, partition_by=["day"])
    finally:
        base.unpersist()
    spark = silver.sparkSession
    return read_layer(spark, root, "gold_aggregated", fmt), read_layer(spark, root, "gold_tunnel", fmt)


def run_pipeline(
    spark: SparkSession, raw: DataFrame, root: str, fmt: str = "parquet", cluster: bool = False
) -> dict[str, DataFrame]:
    """Write all four layers under ``root``; return them read back."""
    bronze = build_bronze(raw, root, fmt, cluster)
    silver = build_silver(bronze, root, fmt, cluster)
    gold, tunnel = build_gold(silver, root, fmt)
    return {
        "bronze": bronze,
        "silver": silver,
        "gold_aggregated": gold,
        "gold_tunnel": tunnel,
        "quality_report": read_layer(spark, root, "quality_report", fmt),
    }


def run_analytics(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Materialise the analyses of the gold layer under ``root``.

    Reads ``gold_aggregated`` once from storage; writes the variant counts,
    the chi-square tests and skipped groups, the Bayesian report (exact means
    and intervals) and comparison, and the per-day result documents
    (partitioned by day, so a lookup reads one folder).
    """
    from abtest_spark.operators import bayes as B
    from abtest_spark.operators import chi2 as C
    from abtest_spark.operators import conversion as CV
    from abtest_spark.operators import results as R

    gold = read_layer(spark, root, "gold_aggregated", fmt)
    report = B.bayes_report(gold)
    outputs = {
        "variant_count": (CV.variant_count(gold), ()),
        "chi2_test": (C.chi2_test(gold), ()),
        "chi2_skipped": (C.chi2_skipped(gold), ()),
        "bayes_report": (report, ()),
        "experiment_results": (R.experiment_results(gold), ("day",)),
    }
    for name, (df, parts) in outputs.items():
        write_layer(df, root, name, fmt=fmt, partition_by=parts)
    # The comparison reads the written report, so the grid is not fitted again.
    write_layer(B.bayes_comparison(read_layer(spark, root, "bayes_report", fmt)), root, "bayes_comparison", fmt=fmt)
    names = [*outputs, "bayes_comparison"]
    return {n: read_layer(spark, root, n, fmt) for n in names}


def main(argv: list[str] | None = None) -> None:
    """``python -m abtest_spark.plans.etl --raw <csv glob> --root <dir> [--analytics]``

    (or the same module through spark-submit with the package on
    ``--py-files``; the master and resources come from the submit command).
    """
    import argparse

    from abtest_spark.session import get_spark
    from abtest_spark.sources.raw import read_raw

    ap = argparse.ArgumentParser(description="raw CSV -> bronze/silver/gold layers (+ analyses)")
    ap.add_argument("--raw", required=True, help="headed CSV file(s) of the raw clickstream")
    ap.add_argument("--root", required=True, help="shared folder for the layers")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--analytics", action="store_true", help="also materialise the analyses of gold")
    ap.add_argument("--cluster", action="store_true", help="range-cluster bronze and silver on (user, time)")
    args = ap.parse_args(argv)
    spark = get_spark(app="abtest_etl")
    run_pipeline(spark, read_raw(spark, args.raw), args.root, args.format, args.cluster)
    if args.analytics:
        run_analytics(spark, args.root, args.format)


if __name__ == "__main__":
    main()
