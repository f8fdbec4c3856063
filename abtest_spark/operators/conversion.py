"""Variant counts, conversion rates, rankings, trends and funnels on gold.

All experiments are handled at once as grouped plans; the original
per-experiment pandas loops become group keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def variant_count(gold: DataFrame, ordered: bool = False) -> DataFrame:
    """Distinct non-null variants per experiment (``ordered``: most variants
    first, then by name, for display).

    An experiment whose variants are all NULL gets 0: it is neither a
    single-variant nor a multi-variant experiment.
    """
    counts = (
        gold.where(F.col("experiment_name").isNotNull())
        .groupBy("experiment_name")
        .agg(F.count_distinct("variant_id").alias("variant_count"))
    )
    return counts.orderBy(F.col("variant_count").desc(), "experiment_name") if ordered else counts


def single_variant_experiments(gold: DataFrame) -> DataFrame:
    """Experiments with exactly one variant: not valid A/B tests."""
    return variant_count(gold).where(F.col("variant_count") == 1)


def multi_variant_experiments(gold: DataFrame) -> DataFrame:
    return variant_count(gold).where(F.col("variant_count") > 1).select("experiment_name")


def multi_variant(gold: DataFrame) -> DataFrame:
    """Gold rows of experiments with more than one variant (left-semi join).

    The experiment list is tiny, but no broadcast is forced: AQE sees its
    real size at runtime and broadcasts it when under the threshold.
    """
    return gold.join(multi_variant_experiments(gold), "experiment_name", "left_semi")


def with_conversion_rate(gold: DataFrame) -> DataFrame:
    """``purchases / users``; NULL where there are no users (ANSI-safe)."""
    return gold.withColumn(
        "conversion_rate", F.try_divide(F.col("purchases").cast("double"), F.col("users").cast("double"))
    )


def conversion_ranking(gold: DataFrame, n: int | None = None) -> DataFrame:
    """Multi-variant gold rows by conversion rate, best first, NULL rates last.

    With ``n`` it is a top-n report (Spark plans TakeOrderedAndProject: each
    task keeps its n best rows, no global sort).
    """
    ranked = with_conversion_rate(multi_variant(gold)).orderBy(
        F.col("conversion_rate").desc_nulls_last(),
        F.col("experiment_name").asc_nulls_last(),
        F.col("variant_id").asc_nulls_last(),
        F.col("day").asc_nulls_last(),
    )
    return ranked.limit(n) if n else ranked


def conversion_trend(gold: DataFrame) -> DataFrame:
    """Daily conversion series per (experiment, variant), in day order,
    with the two-decimal label shown on the bars."""
    return (
        with_conversion_rate(multi_variant(gold))
        .where(F.col("day").isNotNull() & F.col("variant_id").isNotNull())
        .withColumn("rate_label", F.round("conversion_rate", 2))
        .select("experiment_name", "variant_id", "day", "users", "purchases", "conversion_rate", "rate_label")
        .orderBy("experiment_name", "variant_id", "day")
    )


def funnel(tunnel: DataFrame) -> DataFrame:
    """Users per (experiment, variant, day, event), smallest step first.

    Rows with a NULL variant, day or event cannot be selected in the
    per-variant view and are left out.
    """
    return (
        tunnel.where(
            F.col("variant_id").isNotNull() & F.col("day").isNotNull() & F.col("event_name").isNotNull()
        )
        .groupBy("experiment_name", "variant_id", "day", "event_name")
        .agg(F.sum("users").cast("long").alias("users"))
        .orderBy("experiment_name", "variant_id", "users", "day", "event_name")
    )


def distinct_experiments(gold: DataFrame) -> DataFrame:
    return gold.select("experiment_name").distinct()


def experiment_days(gold: DataFrame) -> DataFrame:
    """Distinct (experiment, day) pairs with data (the day choices per experiment)."""
    return gold.where(F.col("day").isNotNull()).select("experiment_name", "day").distinct()


def experiment_filter(df: DataFrame, experiment: str) -> DataFrame:
    """Rows of one experiment."""
    return df.where(F.col("experiment_name") == F.lit(experiment))


def variant_filter(df: DataFrame, variant) -> DataFrame:
    """Rows of one variant; a NULL variant never matches (equality)."""
    return df.where(F.col("variant_id") == F.lit(variant))


def experiment_day_filter(df: DataFrame, experiment: str, day) -> DataFrame:
    """Rows of one experiment on one day. On a gold layer partitioned by day
    the day predicate prunes folders; on timestamp_ntz sources Catalyst turns
    it into a pushed range."""
    return experiment_filter(df, experiment).where(F.col("day") == F.lit(day).cast("date"))


def has_rows(df: DataFrame) -> bool:
    """Emptiness guard: reads at most one row."""
    return not df.isEmpty()


def presence(df: DataFrame, experiments: list[str]) -> DataFrame:
    """(experiment_name, present): the emptiness guard of many lookups at once."""
    asked = df.sparkSession.createDataFrame([(e,) for e in experiments], "experiment_name string")
    there = distinct_experiments(df).withColumn("present", F.lit(True))
    return asked.join(there, "experiment_name", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def daily_rates(gold: DataFrame) -> DataFrame:
    """Daily conversion rates of multi-variant experiments as a sample per
    (experiment, variant): ``theta`` = purchases / users of each dated day
    with users. The same shape as posterior draws, so the interval and
    comparison operators apply to it."""
    return (
        with_conversion_rate(multi_variant(gold))
        .where(F.col("day").isNotNull() & F.col("variant_id").isNotNull() & F.col("conversion_rate").isNotNull())
        .select("experiment_name", "variant_id", F.col("conversion_rate").alias("theta"))
    )
