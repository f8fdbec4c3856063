"""Distinct users as mergeable sketches, rolled up over days without the events.

Distinct counts do not add up over days, so a weekly or whole-experiment number
of users needs the users again. A theta sketch of the users of one (day,
experiment, variant) has a fixed size and sketches merge, so a roll-up to any
span of days reads the small sketch layer alone. Below ``2^log_size`` distinct
users a sketch holds them all and the count is exact; above, its relative
standard error is about ``1 / sqrt(2^log_size)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtest_spark import schema as S

LOG_SIZE = 14  # 16,384 entries: exact below, 0.8 % above


def relative_error(log_size: int = LOG_SIZE) -> float:
    """Relative standard error of a count above 2^log_size users."""
    return 2.0 ** (-log_size / 2)


def gold_sketches(silver: DataFrame, key: Sequence[str] = S.GOLD_KEY, log_size: int = LOG_SIZE) -> DataFrame:
    """(day, experiment, variant) -> sketches of its users and of its converting users.

    One pass: the aggregation is partial on the map side, so a group of any
    size ships one sketch of bounded size per task; users are never shuffled.
    Groups without converting users have a NULL ``buyers`` sketch.
    """
    user = F.col("user_id")
    return (
        silver.withColumn("day", F.to_date("timestamp"))
        .groupBy(*key)
        .agg(
            F.theta_sketch_agg(user, log_size).alias("users_sketch"),
            F.theta_sketch_agg(F.when(F.col("flag_purchase"), user), log_size).alias("purchases_sketch"),
        )
    )


def merge_sketches(sketches: DataFrame, key: Sequence[str], log_size: int = LOG_SIZE) -> DataFrame:
    """Sketches of coarser groups (whole experiments, weeks): still mergeable and storable."""
    return sketches.groupBy(*key).agg(
        *[F.theta_union_agg(c, log_size).alias(c) for c in ("users_sketch", "purchases_sketch")]
    )


def estimates(sketches: DataFrame) -> DataFrame:
    """The same rows with ``users`` and ``purchases`` in place of the sketches."""
    keep = [c for c in sketches.columns if not c.endswith("_sketch")]
    return sketches.select(
        *keep,
        *[F.coalesce(F.theta_sketch_estimate(f"{c}_sketch"), F.lit(0)).cast("long").alias(c) for c in ("users", "purchases")],
    )


def rollup_users(sketches: DataFrame, key: Sequence[str] = ("experiment_name", "variant_id"), log_size: int = LOG_SIZE) -> DataFrame:
    """Distinct users and distinct converting users over all days of ``sketches``, by ``key``."""
    return estimates(merge_sketches(sketches, key, log_size))


def rollup_weeks(sketches: DataFrame, log_size: int = LOG_SIZE) -> DataFrame:
    """The same per week (its Monday); undated rows have a NULL week."""
    weekly = sketches.withColumn("week", F.date_trunc("week", "day").cast("date"))
    return rollup_users(weekly, ["week", "experiment_name", "variant_id"], log_size)
