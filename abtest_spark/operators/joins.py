"""Skew-aware attach of per-key attributes to a large table.

Attaching one row per key (e.g. per-user purchase statistics) to every event
is an equi-join on the key. A plain shuffle join sends all rows of one key to
one task, so a user holding a third of all events would make one task read a
third of the data. Here such *hot* keys are split:

1. ``per_key`` carries ``rows_col`` = number of big-side rows of the key (it is
   an aggregate of the big side, computed with map-side partial aggregation).
2. A key is hot when it holds more rows than an average shuffle partition:
   ``rows * P > total``. Fewer than ``P`` keys can satisfy that, so the hot
   table has a proven bound of ``P`` rows and is broadcast.
3. A hot key with ``rows`` rows gets ``ceil(k * rows * P / total)`` salt
   values (k = 8 pieces per average partition, so hash collisions of pieces
   stay cheap). Big-side rows pick a salt from a deterministic hash of their
   own columns (retries recompute the same salt); the per-key row is
   replicated once per salt value. Replication in total is below
   ``(k + 1) P`` rows.
4. Shuffle join on (key, salt): a hot key reaches the join as many small
   pieces spread over the tasks, never as one group (measured in
   ``tools/skew_check.py``).

``per_key`` feeds the total, the hot table and the join side, so it is
checkpointed once (reliable, shared checkpoint folder) instead of being
re-derived from the big side three times.

Cold keys get salt 0 and join as usual. Keys are matched null-safely, so a NULL
key is one group like any other (and can be hot too).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Pieces per average partition for a hot key (see ``with_splits``).
OVERSPLIT = 8


def _partitions(df: DataFrame, target_partitions: int | None) -> int:
    if target_partitions:
        return int(target_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_splits(
    per_key: DataFrame, rows_col: str, target_partitions: int | None = None, oversplit: int = OVERSPLIT
) -> DataFrame:
    """Add ``_splits``: 1 for cold keys; for keys holding more than
    ``total / P`` rows, ``ceil(oversplit * rows * P / total)`` pieces of about
    ``1 / oversplit`` of an average partition each. Small pieces matter
    because (key, salt) pairs are hashed onto partitions: several pieces of
    one key can share a partition, and smaller pieces keep that collision
    cheap. The total is a scalar subquery."""
    p = _partitions(per_key, target_partitions)
    total = per_key.agg(F.sum(rows_col).alias("_total")).scalar()
    rows = F.col(rows_col).cast("double")
    return per_key.withColumn(
        "_splits",
        F.when(rows * F.lit(p) > total, F.ceil(rows * F.lit(p * oversplit) / total)).otherwise(F.lit(1)).cast("int"),
    )


def hot_keys(per_key: DataFrame, key: str, rows_col: str, target_partitions: int | None = None) -> DataFrame:
    """Keys holding more than ``total / P`` rows, with their split count.

    Fewer than ``P`` rows by construction (see module doc).
    """
    return (
        with_splits(per_key, rows_col, target_partitions)
        .where(F.col("_splits") > 1)
        .select(F.col(key).alias("_hot_key"), "_splits")
    )


def attach_per_key(
    big: DataFrame,
    per_key: DataFrame,
    key: str,
    rows_col: str,
    salt_cols: Sequence[str],
    target_partitions: int | None = None,
) -> DataFrame:
    """``big`` LEFT JOIN ``per_key`` USING (key), null-safe, hot keys salted.

    ``salt_cols`` should distinguish big-side rows of one key (for a
    deduplicated event table: its non-key columns). ``per_key`` is read three
    times (total, hot keys, join side), so it is checkpointed once to the
    shared checkpoint folder: it is an aggregate, far smaller than ``big``,
    and the checkpoint also cuts its lineage for retries.
    """
    from abtest_spark.session import checkpoint_dir

    checkpoint_dir(per_key.sparkSession)
    per_key = with_splits(per_key.checkpoint(eager=True), rows_col, target_partitions)
    hot = F.broadcast(
        per_key.where(F.col("_splits") > 1).select(F.col(key).alias("_hot_key"), F.col("_splits").alias("_hot_splits"))
    )

    big_tagged = big.join(hot, big[key].eqNullSafe(hot["_hot_key"]), "left")
    salt = F.when(F.col("_hot_splits").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.col("_hot_splits").cast("long")).cast("int")
    )
    big_salted = big_tagged.withColumn("_salt", salt).drop("_hot_key", "_hot_splits")

    pk_salted = (
        per_key.withColumnRenamed(key, "_pk_key")
        .withColumn("_pk_salt", F.explode(F.sequence(F.lit(0), F.col("_splits") - F.lit(1))))
        .drop("_splits")
    )
    joined = big_salted.join(
        pk_salted,
        big_salted[key].eqNullSafe(pk_salted["_pk_key"]) & (big_salted["_salt"] == pk_salted["_pk_salt"]),
        "left",
    )
    return joined.drop("_salt", "_pk_salt", "_pk_key")
