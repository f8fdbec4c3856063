"""Gold layer: daily distinct and converting users per variant (and per step).

``users`` = distinct non-null users in the group; ``purchases`` = distinct
users with at least one flagged row in the group.

Two distinct counts in one aggregate make Spark expand every row twice and
shuffle twice. Instead both tables are two-level aggregates: first one row per
(group, user), then plain counts. Those per-(group, user) rows are also the
place where a hot user stops being a problem: partial aggregation collapses a
user's events map-side, so later stages see at most one row per user and
group.

Two entry points:
* ``gold_aggregated(silver)`` / ``gold_tunnel(silver)``: layer to layer, from
  per-row flags (how the pipeline runs after silver is written).
* ``gold_aggregated_from_events`` / ``gold_tunnel_from_events``: never
  materialise per-row flags. Events are reduced to one row per (group, user)
  keeping the earliest time; each user's newest BUY is a grouped maximum over
  the BUY rows, joined on the user; a user converts in a group when the
  group's earliest time is at or before that BUY (undated groups: when the
  user has any BUY).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtest_spark import schema as S
from abtest_spark.functions.columns import experiment_name, experiment_parts, parsed_ts, variant_id


def _counts(per_user: DataFrame, key: list[str]) -> DataFrame:
    return per_user.groupBy(*key).agg(
        F.count("user_id").alias("users"),
        F.count_if(F.col("flag_purchase") & F.col("user_id").isNotNull()).alias("purchases"),
    )


def _per_user(silver: DataFrame, key: list[str]) -> DataFrame:
    return (
        silver.withColumn("day", F.to_date("timestamp"))
        .groupBy(*key, "user_id")
        .agg(F.max("flag_purchase").alias("flag_purchase"))
    )


def gold_aggregated(silver: DataFrame) -> DataFrame:
    """(day, experiment_name, variant_id) -> users, purchases."""
    return _counts(_per_user(silver, S.GOLD_KEY), S.GOLD_KEY)


def gold_tunnel(silver: DataFrame) -> DataFrame:
    """(day, event_name, experiment_name, variant_id) -> users, purchases."""
    return _counts(_per_user(silver, S.TUNNEL_KEY), S.TUNNEL_KEY)


def users_per_variant(silver: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct users per (experiment, variant) over all days, from silver
    or from any exploded event rows (flags and duplicates do not matter).

    ``approx=True`` uses HyperLogLog++ (fixed-size sketches, no per-user
    shuffle) for very large inputs.
    """
    agg = F.approx_count_distinct("user_id", rsd) if approx else F.count_distinct("user_id")
    return silver.groupBy("experiment_name", "variant_id").agg(agg.alias("users"))


def _flag() -> F.Column:
    return F.when(F.col("day").isNull(), F.coalesce(F.col("any_buy"), F.lit(False))).otherwise(
        F.coalesce(F.col("_first_ts") <= F.col("last_buy_ts"), F.lit(False))
    )


def _reduced_flags(
    events: DataFrame, key: list[str], buy_event: str = S.BUY_EVENT, stats: DataFrame | None = None
) -> DataFrame:
    """One row per (key, user) with the group's purchase flag.

    Every aggregate here (earliest time, newest BUY, any BUY) ignores exact
    duplicate rows, so ``events`` may be raw or deduplicated bronze with the
    same result; passing raw saves the widest shuffle of the chain.

    Events are exploded and reduced to one row per (key, user) with the
    earliest time. Each user's newest BUY is a grouped maximum over the BUY rows
    alone (a scan of three columns, filtered at the source, map-side combined);
    it is joined on the user, and adaptive skew handling can split a user with
    many groups. No window and no task ever holds all rows of a user.

    ``stats`` (user_id, last_buy_ts, any_buy) is given when ``events`` is only
    part of each user's history (incremental recomputation of some days).
    """
    ev = events.withColumn("_ts", parsed_ts("timestamp"))
    exploded = (
        ev.select("user_id", "_ts", "event_name", F.explode_outer(experiment_parts("experiments")).alias("_e"))
        .select(
            "user_id",
            "_ts",
            "event_name",
            experiment_name("_e").alias("experiment_name"),
            variant_id("_e").alias("variant_id"),
            F.to_date("_ts").alias("day"),
        )
    )
    if stats is None:
        # Only BUY rows of known users: filtered at the scan, a few columns.
        bought = ev.where((F.col("event_name") == F.lit(buy_event)) & F.col("user_id").isNotNull())
        stats = bought.groupBy("user_id").agg(F.max("_ts").alias("last_buy_ts"), F.lit(True).alias("any_buy"))
    reduced = exploded.where(F.col("experiment_name").isNotNull()).groupBy(*key, "user_id").agg(
        F.min("_ts").alias("_first_ts")
    )
    # The anonymous (NULL) user is never counted, its groups only have to exist:
    # its rows match no statistics and are spread by their group.
    salt = F.when(F.col("user_id").isNull(), F.pmod(F.xxhash64(*key), F.lit(1 << 20)) + 1).otherwise(F.lit(0).cast("long"))
    known = stats.where(F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("_u"), F.lit(0).cast("long").alias("_s"), "last_buy_ts", "any_buy"
    )
    joined = reduced.withColumn("_salt", salt).join(
        known, (F.col("user_id") == F.col("_u")) & (F.col("_salt") == F.col("_s")), "left"
    )
    return joined.select(*key, "user_id", _flag().alias("flag_purchase"))


def gold_base(events: DataFrame, buy_event: str = S.BUY_EVENT) -> DataFrame:
    """One row per (day, event_name, experiment, variant, user) with the flag."""
    return _reduced_flags(events, S.TUNNEL_KEY, buy_event)


def gold_tunnel_from_base(base: DataFrame) -> DataFrame:
    return _counts(base, S.TUNNEL_KEY)


def gold_aggregated_from_base(base: DataFrame) -> DataFrame:
    per_user = base.groupBy(*S.GOLD_KEY, "user_id").agg(F.max("flag_purchase").alias("flag_purchase"))
    return _counts(per_user, S.GOLD_KEY)


def gold_aggregated_from_events(
    events: DataFrame, buy_event: str = S.BUY_EVENT, stats: DataFrame | None = None
) -> DataFrame:
    """gold_aggregated straight from raw or bronze events (no silver)."""
    return _counts(_reduced_flags(events, S.GOLD_KEY, buy_event, stats), S.GOLD_KEY)


def gold_tunnel_from_events(
    events: DataFrame, buy_event: str = S.BUY_EVENT, stats: DataFrame | None = None
) -> DataFrame:
    """gold_tunnel straight from raw or bronze events (no silver)."""
    return _counts(_reduced_flags(events, S.TUNNEL_KEY, buy_event, stats), S.TUNNEL_KEY)


def gold_from_bronze(bronze: DataFrame, buy_event: str = S.BUY_EVENT) -> tuple[DataFrame, DataFrame]:
    """(gold_aggregated, gold_tunnel) from raw or bronze events."""
    return gold_aggregated_from_events(bronze, buy_event), gold_tunnel_from_events(bronze, buy_event)


def gold_ordered(gold: DataFrame) -> DataFrame:
    """gold_aggregated by day and experiment (undated rows first); ties by variant."""
    return gold.orderBy(*S.GOLD_KEY)


def tunnel_ordered(tunnel: DataFrame) -> DataFrame:
    """gold_tunnel by day, event and experiment (undated rows first); ties by variant."""
    return tunnel.orderBy(*S.TUNNEL_KEY)
