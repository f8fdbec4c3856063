"""Incremental bronze -> gold over a stream of raw event files.

Purchase attribution is retroactive: a new BUY flags the same user's earlier
events, on any earlier day. A stateful streaming aggregate cannot express
that (exact distinct counts and per-user windows are refused on streams), so
each micro-batch is processed with ``foreachBatch`` as a small batch job:

1. Deduplicate the batch and append to the bronze layer only rows not already
   there. A duplicate has the same timestamp text, so the anti-join reads
   only the bronze partitions of the batch's days; it makes a retried batch a
   no-op. A small (user, day) presence layer is appended as well.
2. Merge the batch's per-user purchase statistics (newest BUY time, any BUY;
   both idempotent) into a new version of the user-statistics table
   (``epoch=N``), so a retry rewrites the same version from the same inputs.
3. Affected days = the batch's own days, plus, only for users whose BUY
   statistics changed, the days whose flags can flip (between the previous
   and the new newest-BUY date, from the small presence layer) and the
   undated day on a first BUY. A batch without purchases rewrites only its
   own days. Gold is
   recomputed for those days only, from the bronze rows of those days (the
   day-partitioned bronze is read only in those folders) and the
   merged statistics, and written with dynamic partition overwrite, so other
   days are untouched.

Gold for a day depends only on that day's rows and each user's overall
statistics, so the result equals the batch computation over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from abtest_spark import schema as S
from abtest_spark.functions.columns import parsed_ts
from abtest_spark.operators import gold as G
from abtest_spark.operators import quality as Q
from abtest_spark.operators.silver import user_purchase_stats
from abtest_spark.sources.raw import read_raw_stream
from abtest_spark.sources.layers import layer_path, read_layer, write_layer

BRONZE = "bronze_stream"
STATS = "user_stats"
USER_DAYS = "user_days"
# Files (and write tasks) per day folder and micro-batch: bounds the file
# count per batch while keeping one busy day off a single task.
FILES_PER_DAY = 64


def _try_read(spark: SparkSession, root: str, layer: str) -> DataFrame | None:
    try:
        return read_layer(spark, root, layer)
    except AnalysisException:
        return None


def _null_safe_on(left: DataFrame, right: DataFrame, cols) -> F.Column:
    cond = None
    for c in cols:
        term = left[c].eqNullSafe(right[c])
        cond = term if cond is None else cond & term
    return cond


def _day_list(days: DataFrame) -> list:
    """Distinct days, at most one per day partition (bounded by the
    calendar, not by the data volume)."""
    return sorted({r[0] for r in days.distinct().collect()}, key=lambda d: (d is None, d))


def _on_days(layer: DataFrame, values: list) -> DataFrame:
    """Rows of the day-partitioned ``layer`` whose day is in ``values``, as a
    static partition filter: only those folders are listed and read."""
    dated = [d for d in values if d is not None]
    cond = F.col("_day").isin(dated) if dated else F.lit(False)
    if any(d is None for d in values):
        cond = cond | F.col("_day").isNull()
    return layer.where(cond)


def process_batch(batch: DataFrame, epoch_id: int, root: str, buy_event: str = S.BUY_EVENT) -> list:
    """One micro-batch; returns the gold days it rewrote."""
    spark = batch.sparkSession
    batch = batch.select(*S.RAW_COLUMNS).persist()  # read for rows and for statistics
    try:
        return _process(spark, batch, epoch_id, root, buy_event)
    finally:
        batch.unpersist()


def _process(spark: SparkSession, batch: DataFrame, epoch_id: int, root: str, buy_event: str) -> list:
    new = Q.deduplicate(batch).withColumn("_day", F.to_date(parsed_ts("timestamp")))
    batch_users = batch.select("user_id").distinct()
    batch_days = _day_list(new.select("_day"))

    # 1. Bronze: append rows not stored yet. A duplicate has the same
    #    timestamp text, hence the same day: only the batch's days are read.
    existing = _try_read(spark, root, BRONZE)
    if existing is not None:
        mine = _on_days(existing, batch_days)
        new = new.join(mine, _null_safe_on(new, mine, S.RAW_COLUMNS), "left_anti")
    spread = min(FILES_PER_DAY, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write_layer(new, root, BRONZE, partition_by=["_day"], mode="append", files_per_partition=spread)
    # (user, day) presence, appended for the whole batch so a retry after a
    # partial failure still records it; readers take it distinct.
    presence = batch.select("user_id", F.to_date(parsed_ts("timestamp")).alias("_day")).distinct()
    write_layer(presence, root, USER_DAYS, mode="append")

    # 2. Versioned statistics: epoch N = epoch N-1 merged with this batch.
    batch_stats = user_purchase_stats(batch.withColumn("_ts", parsed_ts("timestamp")), buy_event).drop("n_rows")
    prev = _try_read(spark, root, STATS)
    old = None
    if prev is not None:
        last = prev.where(F.col("epoch") < epoch_id).agg(F.max("epoch")).first()[0]
        if last is not None:
            old = prev.where(F.col("epoch") == last).drop("epoch")
    both = batch_stats.unionByName(old) if old is not None else batch_stats
    merged = both.groupBy("user_id").agg(F.max("last_buy_ts").alias("last_buy_ts"), F.max("any_buy").alias("any_buy"))
    write_layer(merged.withColumn("epoch", F.lit(epoch_id).cast("long")), root, STATS, partition_by=["epoch"], dynamic=True)
    stats = read_layer(spark, root, STATS).where(F.col("epoch") == epoch_id).drop("epoch")

    # 3. Affected gold days: the batch's own days, plus, for users whose
    #    purchase statistics changed, the days whose flags can flip: events
    #    after the previous newest BUY up to the new one (all earlier days for
    #    a first timed BUY), and the undated day when a first BUY appears.
    cur = stats.join(batch_users, stats["user_id"].eqNullSafe(batch_users["user_id"]), "left_semi")
    if old is not None:
        before = old.select(F.col("user_id").alias("_ou"), F.col("last_buy_ts").alias("_old_last"), F.col("any_buy").alias("_old_any"))
        diff = cur.join(before, F.col("user_id").eqNullSafe(F.col("_ou")), "left").drop("_ou")
    else:
        diff = cur.withColumn("_old_last", F.lit(None).cast("timestamp_ntz")).withColumn("_old_any", F.lit(None).cast("boolean"))
    old_any = F.coalesce(F.col("_old_any"), F.lit(False))
    changed = diff.where(~F.col("last_buy_ts").eqNullSafe(F.col("_old_last")) | (F.col("any_buy") & ~old_any))
    seen = read_layer(spark, root, USER_DAYS)
    flips = seen.join(
        changed.withColumnRenamed("user_id", "_cu"), seen["user_id"].eqNullSafe(F.col("_cu")), "inner"
    )
    timed = flips.where(
        F.col("_day").isNotNull()
        & F.col("last_buy_ts").isNotNull()
        & (F.col("_day") <= F.to_date("last_buy_ts"))
        & (F.col("_old_last").isNull() | (F.col("_day") >= F.to_date("_old_last")))
    ).select("_day")
    undated = changed.where(F.col("any_buy") & ~old_any).select(F.lit(None).cast("date").alias("_day"))
    days = sorted(set(batch_days) | set(_day_list(timed.unionByName(undated))), key=lambda d: (d is None, d))

    bronze = read_layer(spark, root, BRONZE)
    rows = _on_days(bronze, days).drop("_day")
    write_layer(G.gold_aggregated_from_events(rows, buy_event, stats), root, "gold_aggregated", partition_by=["day"], dynamic=True)
    write_layer(G.gold_tunnel_from_events(rows, buy_event, stats), root, "gold_tunnel", partition_by=["day"], dynamic=True)
    return days


def start_gold_stream(
    spark: SparkSession,
    source_dir: str,
    root: str,
    checkpoint_location: str | None = None,
    fmt: str = "csv",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start the incremental job over files arriving in ``source_dir``.

    ``checkpoint_location`` defaults to ``{root}/_stream_checkpoint`` (same
    shared storage as the layers). ``max_files_per_trigger`` bounds the size
    of a micro-batch.
    """
    options = {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}
    if fmt == "csv":
        stream = read_raw_stream(spark, source_dir, **options)
    else:
        stream = spark.readStream.schema(S.RAW_SCHEMA).format(fmt).options(**options).load(source_dir)
    writer = (
        stream.writeStream.foreachBatch(lambda df, eid: process_batch(df, eid, root))
        .option("checkpointLocation", checkpoint_location or layer_path(root, "_stream_checkpoint"))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
