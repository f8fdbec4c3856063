"""User sessions: runs of events of one user without a long pause.

The attribution of the silver layer is per user; the session view tells which
visit led to a purchase. Sessions are Spark's ``session_window``: events of a
task are merged into session rows before the shuffle, so a hot user ships its
sessions and not its events, and merged again by user and start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abtest_spark import schema as S
from abtest_spark.functions.columns import is_buy, parsed_ts

GAP = "30 minutes"


def user_sessions(bronze: DataFrame, gap: str = GAP, buy_event: str = S.BUY_EVENT) -> DataFrame:
    """(user, session) -> start, last event, events, distinct steps, buys, and whether it converted.

    An event within ``gap`` of the one before it (exactly ``gap`` included)
    belongs to the same session; events of one time are together. Events
    without a valid time form one session per user with NULL times; the NULL
    user's events are sessions of one anonymous user.
    ``last_buy`` is the time of the session's last BUY (NULL in untimed ones).
    """
    buy = is_buy("event_name", buy_event)
    events = bronze.withColumn("_ts", parsed_ts("timestamp")).withColumn("_buy", buy).drop("timestamp")
    # One row per (user, time) first: equal times need no session merge, and each carries its own counts.
    moments = events.groupBy("user_id", "_ts").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("_buy").alias("_buys"),
        F.collect_set("event_name").alias("_steps"),
    )
    timed = (
        moments.where("_ts is not null")
        .groupBy("user_id", F.session_window("_ts", gap).alias("_w"))
        .agg(
            F.min("_ts").alias("session_start"),
            F.max("_ts").alias("last_event"),
            F.sum("_n").alias("events"),
            F.sum("_buys").alias("buys"),
            F.array_distinct(F.flatten(F.collect_set("_steps"))).alias("_steps"),
            F.max(F.when(F.col("_buys") > 0, F.col("_ts"))).alias("last_buy"),
        )
        .drop("_w")
    )
    none = F.lit(None).cast("timestamp_ntz")
    untimed = moments.where("_ts is null").select(
        "user_id",
        none.alias("session_start"),
        none.alias("last_event"),
        F.col("_n").alias("events"),
        F.col("_buys").alias("buys"),
        "_steps",
        none.alias("last_buy"),
    )
    return timed.unionByName(untimed).select(
        "user_id",
        "session_start",
        "last_event",
        "events",
        F.size("_steps").cast("long").alias("steps"),
        "buys",
        "last_buy",
        (F.col("buys") > 0).alias("converted"),
    )


def session_summary(sessions: DataFrame) -> DataFrame:
    """Per user: sessions, converting sessions, events, events outside converting sessions, longest session in seconds."""
    return sessions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("converted").alias("converting_sessions"),
        F.sum("events").alias("events"),
        F.coalesce(F.sum(F.when(~F.col("converted"), F.col("events"))), F.lit(0)).alias("events_without_purchase"),
        F.max(F.timestamp_diff("SECOND", F.col("session_start"), F.col("last_event"))).alias("longest_seconds"),
    )
