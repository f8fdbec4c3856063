"""Silver layer: purchase attribution and experiment explode.

Attribution rule (per user, not per session): an event is flagged when its
user has a BUY at or after the event's time, ties included. Events with no
valid time sort after every timed event in the newest-first order, so they
are flagged when the user has any BUY at all; a BUY without a valid time only
flags other untimed events.

Production form: one per-user aggregate ``(last_buy_ts, any_buy, n_rows)``,
partially aggregated map-side, then a skew-aware attach to the events
(``joins.attach_per_key``) and a comparison. No per-user sort is needed.

Window form (the newest-first ``row_number`` and the propagated BUY rank):
``event_rank`` and ``buy_groups``. A window partitioned by user alone would put
all events of a hot user into one task. Instead the events are range
partitioned on (user, newest-first order), so a hot user spans many
partitions (pieces). A range shuffle on (piece, user) then lays the rows out
balanced by count, which already satisfies every window keyed by (piece,
user): those need no further exchange. What crosses piece boundaries (rank
offsets, BUY ranks of newer rows, equal-time peers) concerns fewer than P
users and at most 2P equal-time runs, so those corrections are broadcast and
the event rows are never shuffled by user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abtest_spark import schema as S
from abtest_spark.functions.columns import (
    experiment_name,
    experiment_parts,
    is_buy,
    parsed_ts,
    variant_id,
)
from abtest_spark.operators.joins import attach_per_key
from abtest_spark.session import checkpoint_dir


def with_is_buy(df: DataFrame, buy_event: str = S.BUY_EVENT) -> DataFrame:
    """Integer buy marker: 1 for the buy event, else 0 (NULL name -> 0)."""
    return df.withColumn("is_buy", F.when(F.col("event_name") == buy_event, F.lit(1)).otherwise(F.lit(0)))


def user_purchase_stats(events: DataFrame, buy_event: str = S.BUY_EVENT) -> DataFrame:
    """Per user (NULL user is one group): newest timed BUY, any BUY, row count.

    ``events`` must carry the parsed ``_ts``.
    """
    buy = is_buy("event_name", buy_event)
    return events.groupBy("user_id").agg(
        F.max(F.when(buy, F.col("_ts"))).alias("last_buy_ts"),
        F.max(buy).alias("any_buy"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _flag(ts: str = "_ts") -> F.Column:
    return F.when(F.col(ts).isNull(), F.coalesce(F.col("any_buy"), F.lit(False))).otherwise(
        F.coalesce(F.col(ts) <= F.col("last_buy_ts"), F.lit(False))
    )


def flag_purchases(bronze: DataFrame, buy_event: str = S.BUY_EVENT, target_partitions: int | None = None) -> DataFrame:
    """Bronze rows with ``timestamp`` parsed to timestamp_ntz and ``flag_purchase``."""
    ev = bronze.withColumn("_ts", parsed_ts("timestamp"))
    stats = user_purchase_stats(ev, buy_event)
    salt_cols = [c for c in ev.columns if c != "user_id"]
    joined = attach_per_key(ev, stats, "user_id", "n_rows", salt_cols, target_partitions)
    return (
        joined.withColumn("flag_purchase", _flag())
        .withColumn("timestamp", F.col("_ts"))
        .drop("_ts", "last_buy_ts", "any_buy", "n_rows")
    )


def explode_experiments(df: DataFrame) -> DataFrame:
    """One row per experiment in the ``experiments`` text.

    Braces anywhere are removed, parts split on comma+space, each part split
    on ``=``: name = field 0, variant = field 1 (NULL when absent). NULL
    experiments produce no row; ``{}`` or empty text gives ``('', NULL)``.
    """
    return (
        df.withColumn("_experiment", F.explode(experiment_parts("experiments")))
        .withColumn("experiment_name", experiment_name("_experiment"))
        .withColumn("variant_id", variant_id("_experiment"))
        .drop("_experiment")
    )


def to_silver(bronze: DataFrame, buy_event: str = S.BUY_EVENT, target_partitions: int | None = None) -> DataFrame:
    """Bronze -> silver: attribution first (smaller input), then explode."""
    flagged = flag_purchases(bronze, buy_event, target_partitions)
    return explode_experiments(flagged).select(*S.SILVER_COLUMNS)


def flag_purchases_bucketed(table: DataFrame, files: DataFrame, buckets: int, buy_event: str = S.BUY_EVENT) -> DataFrame:
    """``flag_purchases`` of a bronze table in ``buckets`` buckets by user: no event is shuffled.

    ``table`` is the bucketed table, ``files`` the same rows read as plain
    files. The per-user statistics are partly aggregated in the tasks and
    dealt to the buckets; the events meet them where they are. A hot user (as
    in ``joins``: more rows than an average bucket) would make one bucket's
    task long, and the NULL user has no bucket join; their events are read from
    the plain files, split by size, and get their statistics by a broadcast of
    fewer than ``buckets + 1`` rows.
    """
    spark = table.sparkSession
    checkpoint_dir(spark)
    stats = user_purchase_stats(files.withColumn("_ts", parsed_ts("timestamp")), buy_event).checkpoint()
    total = stats.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    hot = (F.col("n_rows") * buckets > total) | F.col("user_id").isNull()
    special = stats.where(hot)
    few = F.broadcast(special)
    events = table.withColumn("_ts", parsed_ts("timestamp"))
    plain = events.join(F.broadcast(special.select("user_id").where("user_id is not null")), "user_id", "left_anti")
    plain = plain.where("user_id is not null").join(stats.where(~hot).hint("merge"), "user_id", "left")
    rest = files.withColumn("_ts", parsed_ts("timestamp")).alias("e")
    rest = rest.join(few.alias("s"), F.col("e.user_id").eqNullSafe(F.col("s.user_id")))
    rest = rest.select("e.*", "s.last_buy_ts", "s.any_buy", "s.n_rows")
    return (
        plain.unionByName(rest)
        .withColumn("flag_purchase", _flag())
        .withColumn("timestamp", F.col("_ts"))
        .drop("_ts", "last_buy_ts", "any_buy", "n_rows")
    )


# ---------------------------------------------------------------------------
# Window form, with every window bounded.
# ---------------------------------------------------------------------------

# Newest first; then fixed tie-breakers so the rank is deterministic.
_RANK_ORDER = [
    ("_ts", "desc_nulls_last"),
    ("event_name", "asc_nulls_first"),
    ("item_id", "asc_nulls_first"),
    ("site", "asc_nulls_first"),
    ("experiments", "asc_nulls_first"),
    ("_raw_ts", "asc_nulls_first"),
]


def _order_cols():
    return [getattr(F.col(c), how)() for c, how in _RANK_ORDER]


def _ordered(
    bronze: DataFrame, target_partitions: int | None = None, checkpoint: bool = True
) -> tuple[DataFrame, int]:
    """Events in one global (user, newest-first) order, cut into pieces.

    Range partitioning on the full order spreads a hot user over as many
    partitions (pieces) as its size needs; each piece is sorted and every row
    gets ``_row`` (its position, increasing along the order within a piece)
    and ``_pid`` (its piece).

    With ``checkpoint`` the result is written to the shared checkpoint folder
    so every consumer and every retry sees the same ids. That is needed when
    ``bronze`` comes straight out of a shuffle, whose row order (and so the
    sampled range bounds) can differ between recomputations. When ``bronze``
    is read from storage its order is reproducible and the full order breaks
    every tie, so ``checkpoint=False`` recomputes identical ids and saves
    writing a copy of the events.
    """
    spark = bronze.sparkSession
    p = target_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ev = bronze.withColumn("_raw_ts", F.col("timestamp")).withColumn("_ts", parsed_ts("timestamp"))
    order = [F.col("user_id").asc_nulls_first(), *_order_cols()]
    ids = (
        ev.repartitionByRange(p, *order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_pid", F.spark_partition_id())
    )
    if checkpoint:
        checkpoint_dir(spark)
        ids = ids.checkpoint(eager=True)
    return ids, p


def _by_piece(ids: DataFrame, p: int) -> DataFrame:
    """Lay rows out by (piece, user) with a range shuffle: balanced by row
    count, so the pieces of one user go to different tasks, and it already
    satisfies every window and aggregate keyed by (piece, user[, time]) below,
    which then need no further exchange."""
    return ids.repartitionByRange(p, "_pid", F.col("user_id").asc_nulls_first())


def _eq(left: DataFrame, right: DataFrame, cols) -> F.Column:
    cond = None
    for c in cols:
        term = left[c].eqNullSafe(right[c])
        cond = term if cond is None else cond & term
    return cond


def _attach(big: DataFrame, small: DataFrame, keys) -> DataFrame:
    """Broadcast-attach a correction table with a proven size bound (see the
    callers); unmatched rows get NULLs."""
    renamed = small.select(*[F.col(k).alias(f"_c{k}") for k in keys], *[c for c in small.columns if c not in keys])
    cond = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"_c{k}"))
        cond = term if cond is None else cond & term
    return big.join(F.broadcast(renamed), cond, "left").drop(*[f"_c{k}" for k in keys])


def _ranked(bronze: DataFrame, target_partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """``event_rank`` = row number within (piece, user) + rows of the user in
    earlier pieces.

    The offset is non-zero only for users that continue from an earlier
    piece. The data is in one global order, so each user occupies a
    contiguous run of pieces and each piece boundary is crossed by at most one
    user: fewer than P (piece, user) pairs need an offset. That correction
    table is broadcast; the event rows are never shuffled by user.
    """
    ids, p = _ordered(bronze, target_partitions, checkpoint)
    laid = _by_piece(ids, p)
    local = laid.withColumn(
        "_local_rank", F.row_number().over(Window.partitionBy("_pid", "user_id").orderBy("_row"))
    )
    per_piece = laid.groupBy("_pid", "user_id").agg(F.count(F.lit(1)).alias("_cnt"))
    earlier = Window.partitionBy("user_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        per_piece.withColumn("_offset", F.sum("_cnt").over(earlier))
        .where(F.col("_offset") > 0)
        .select("_pid", "user_id", "_offset")
    )
    return _attach(local, offsets, ["_pid", "user_id"]).withColumn(
        "event_rank", (F.col("_local_rank") + F.coalesce(F.col("_offset"), F.lit(0))).cast("long")
    )


def event_rank(bronze: DataFrame, target_partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Bronze rows with ``event_rank``: 1 = the user's newest event (ties
    broken by the other columns). ``checkpoint=False``: see ``_ordered``."""
    return _ranked(bronze, target_partitions, checkpoint).select(*bronze.columns, "event_rank")


def buy_groups(
    bronze: DataFrame, buy_event: str = S.BUY_EVENT, target_partitions: int | None = None, checkpoint: bool = True
) -> DataFrame:
    """Window twin of the attribution: ``buy_group`` and ``flag_purchase``.

    ``buy_group`` = the newest-first rank of the nearest BUY at or after the
    event, equal times included (the RANGE frame of the newest-first order);
    NULL when there is none; ``flag_purchase`` is its non-nullness. Ranks grow
    along the order, so it is the largest BUY rank in the frame, assembled
    from four parts:
      * rows up to this one in its (piece, user) window,
      * rows with the same time in the same piece (a window per piece, user
        and time, which may reach past this row),
      * rows of the user in earlier pieces (non-empty for fewer than P
        (piece, user) pairs, broadcast),
      * rows with the same time in other pieces: a run of equal times can
        only continue across pieces at a piece's first or last row, so at
        most 2P (user, time) runs qualify (broadcast).
    """
    ranked = _ranked(bronze, target_partitions, checkpoint)
    buy_rank = F.when(F.col("event_name") == buy_event, F.col("event_rank"))
    running = Window.partitionBy("_pid", "user_id").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    local = ranked.withColumn("_run_max", F.max(buy_rank).over(running)).withColumn(
        "_peer_max", F.max(buy_rank).over(Window.partitionBy("_pid", "user_id", "_ts"))
    )

    per_piece = ranked.groupBy("_pid", "user_id").agg(F.max(buy_rank).alias("_piece_max"))
    earlier = Window.partitionBy("user_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        per_piece.withColumn("_prev_max", F.max("_piece_max").over(earlier))
        .where(F.col("_prev_max").isNotNull())
        .select("_pid", "user_id", "_prev_max")
    )

    ends = ranked.groupBy("_pid").agg(F.min("_row").alias("_first"), F.max("_row").alias("_last"))
    end_rows = ends.select(F.explode(F.array("_first", "_last")).alias("_row"))
    edge_runs = ranked.join(F.broadcast(end_rows), "_row", "left_semi").select("user_id", "_ts").distinct()
    run_rows = ranked.join(F.broadcast(edge_runs), _eq(ranked, edge_runs, ["user_id", "_ts"]), "left_semi")
    across = run_rows.groupBy("user_id", "_ts").agg(F.max(buy_rank).alias("_run_max_all"))

    joined = _attach(_attach(local, carried, ["_pid", "user_id"]), across, ["user_id", "_ts"])
    bg = F.greatest(F.col("_run_max"), F.col("_peer_max"), F.col("_prev_max"), F.col("_run_max_all"))
    return (
        joined.withColumn("buy_group", bg.cast("long"))
        .withColumn("flag_purchase", F.col("buy_group").isNotNull())
        .withColumn("timestamp", F.col("_ts"))
        .select(*bronze.columns, "event_rank", "buy_group", "flag_purchase")
    )


def user_journey(df: DataFrame, user_id) -> DataFrame:
    """Rows of one user, oldest first (the spot check of the attribution)."""
    return df.where(F.col("user_id") == F.lit(user_id)).orderBy(F.col("timestamp").asc_nulls_last())


def journeys(bronze: DataFrame) -> DataFrame:
    """Every user's events, oldest first (untimed last), with ``buy_group`` and ``flag_purchase``."""
    columns = [c for c in bronze.columns if c != "event_rank"]
    return (
        buy_groups(bronze)
        .orderBy("user_id", F.col("timestamp").asc_nulls_last(), F.desc("event_rank"))
        .select(*columns, "buy_group", "flag_purchase")
    )
